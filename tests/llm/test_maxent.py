"""Operator 7: exact base scores, a proper law, and better than the base on held-out text."""

import copy
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import maxent

from . import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """Per row: held_out, n_tokens, n_known, train_tokens, base score."""
    tokens = [cases.words((t or "").translate(LOWER)) + [None] for _, t in rows]
    held = [cases.crc(k) % 10 == 0 for k, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held) for w in ws if not h)
    n, v = sum(counts.values()), len(counts)
    return [(h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
            for ws, h in zip(tokens, held)]


def check(found, rows):
    want = sorted(((k is None, k or 0), *p) for (k, _), p in zip(rows, plain(rows)))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("common", [200, 100_000])
def test_edge_documents(spark, common):
    found = maxent.score(cases.edge(spark), common=common, steps=2).collect()
    check(found, cases.edge_texts())
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found)
    again = {(r["doc_id"], r["n_tokens"]): r["score"] for r in maxent.score(cases.edge(spark), common=127, steps=2).collect()}
    assert all(math.isclose(again[r["doc_id"], r["n_tokens"]], r["score"], rel_tol=1e-6) for r in found)


def test_history_helps_on_held_out_text(spark):
    rng = random.Random(2)
    after = {f"w{i}": [f"w{rng.randrange(40)}" for _ in range(3)] for i in range(40)}
    rows = []
    for i in range(300):
        words = ["W1"]
        for _ in range(60):
            words.append(rng.choice(after[words[-1].lower()]))
        rows.append((i, " ".join(words)))
    found = maxent.score(cases.frame(spark, rows).repartition(3)).collect()
    check(found, rows)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.6 * sum(r["base_score"] for r in held)


def name(word):
    return int(maxent.tokens_of(pa.array([word]))[0][0])


def sentences(n, rng):
    """Texts in which each of 60 words is followed by one of three."""
    after = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(60)}"]
        for _ in range(rng.randrange(1, 40)):
            words.append(rng.choice(after[words[-1]]) if words[-1] in after and rng.random() < 0.9 else rng.choice([f"w{rng.randrange(60)}", f"rare{rng.randrange(400)}"]))
        rows.append((i, " ".join(words)))
    return rows


class Plain:
    """The whole law written out, from all rows of the model's tables."""

    def __init__(self, counts, vocabulary, trained):
        self.counts = {r["token"]: r["n"] for r in counts.collect()}
        self.vocabulary, self.classes = vocabulary, trained.classes.single()
        self.weights = {r["key"]: r["value"] for r in trained.weights.collect()}
        self.of = {}
        self.thetas = {r["a"]: dict(zip(r["classes"], r["theta"])) for r in trained.thetas.collect()}

    def class_of(self, token):
        if token not in self.of:
            self.of[token] = maxent.CLASSES if token == maxent.START else int(self.vocabulary.classes(np.array([token]))[0])
        return self.of[token]

    def context(self, token):
        return (self.class_of(token) << 28) | int(maxent.mix(np.array([token], np.int64).view(np.uint64))[0] & np.uint64((1 << 28) - 1))

    def cell(self, token):
        return (token >> 32) & 0xFFFFFF if self.class_of(token) >= maxent.SINGLES else 0

    def pair(self, one, token):
        return int(maxent.pair_names(np.array([self.context(one)]), np.array([self.class_of(token)]), np.array([self.cell(token)]))[0])

    def start(self, token):
        return self.counts.get(token, 0) + 0.1

    def law(self, two, one, unseen):
        """{token: probability} of every known token and of the ``unseen`` ones."""
        history = np.array([self.class_of(two) * (maxent.CLASSES + 1) + self.class_of(one)])
        logits = self.classes.logits(history)[0]
        for c, w in self.thetas.get(self.context(one), {}).items():
            logits[c] += w
        of_class = np.exp(logits - logits.max())
        of_class /= of_class.sum()
        members = {}
        tokens = [*self.counts, *unseen]
        pairs = maxent.pair_names(np.full(len(tokens), self.context(one)), np.array([self.class_of(t) for t in tokens]), np.array(
            [self.cell(t) for t in tokens])).tolist()
        for token, pair in zip(tokens, pairs):
            c = self.class_of(token)
            members.setdefault(c, {})[token] = self.start(token) * math.exp(self.weights.get(pair, 0) if c >= maxent.SINGLES else 0)
        return {t: of_class[c] * x / sum(m.values()) for c, m in members.items() for t, x in m.items()}


@pytest.fixture(scope="module")
def small(spark):
    rows = sentences(400, random.Random(5))
    docs = cases.frame(spark, rows).repartition(3)
    held = [i for i, _ in rows if cases.crc(i) % 10 == 0]
    training = docs.where(~docs.doc_id.isin(held))
    counts = maxent.count_tokens(training).groupBy("token").agg(F.sum("n").alias("n")).cache()
    every = counts.collect()
    shared = Counter()
    for r in every:
        shared[r["token"] % maxent.SHARED] += r["n"] + 0.1
    vocabulary = maxent.Vocabulary(every, sum(r["n"] for r in every), len(every), shared)
    trained = maxent.train(training, counts, spark.sparkContext.broadcast(vocabulary), steps=6)
    return rows, docs, Plain(counts, vocabulary, trained)


def unseen_words(plain):
    """One unknown word of each shared class, and their number."""
    found = {}
    for token in maxent.tokens_of(pa.array([" ".join(f"unseen{i}" for i in range(2000))]))[0][:-1].tolist():
        found.setdefault(plain.class_of(token), token)
    assert len(found) == maxent.SHARED
    return list(found.values())


def test_probabilities_of_every_history_sum_to_one(small):
    """Also that the normalisers, kept as corrections by block, are those of the written-out law."""
    _, _, plain = small
    unseen = unseen_words(plain)
    known = list(plain.counts)
    rng = random.Random(3)
    for _ in range(20):
        two, one = (rng.choice([*known, int(maxent.START), unseen[0]]) for _ in range(2))
        law = plain.law(two, one, unseen)
        assert math.isclose(sum(law.values()), 1, rel_tol=1e-9)
        for c in range(maxent.SINGLES, maxent.CLASSES):
            block = int(maxent.block_names(np.array([(c << 34) | plain.context(one)]))[0])
            members = [t for t in [*known, *unseen] if plain.class_of(t) == c]
            full = sum(plain.start(t) * math.exp(plain.weights.get(plain.pair(one, t), 0)) for t in members)
            assert math.isclose(math.log(full / plain.vocabulary.masses[c]), -plain.weights.get(block, 0), rel_tol=1e-4, abs_tol=1e-5)


@pytest.mark.parametrize("bounds", [{}, {"words": 3, "pairs": 5}, {"words": 0, "pairs": 0}])
def test_scores_are_those_of_the_written_out_law(small, bounds):
    rows, docs, plain = small
    found = {r["doc_id"]: r["score"] for r in maxent.score(docs, steps=6, common=24 if bounds else 1000, **bounds).collect()}
    assert len(found) == len(rows)
    unseen = {plain.class_of(t): t for t in unseen_words(plain)}
    for i, text in rows[:25]:
        tokens = [name(w) for w in text.split()] + [int(maxent.END)]
        want, two, one = 0.0, int(maxent.START), int(maxent.START)
        for token in tokens:
            missing = dict(unseen)
            if token not in plain.counts:
                missing[plain.class_of(token)] = token
            want += math.log10(plain.law(two, one, list(missing.values()))[token])
            two, one = one, token
        assert math.isclose(found[i], want, rel_tol=1e-5), (i, found[i], want)


def test_pairs_are_shuffled_packed(spark, small, monkeypatch):
    """Once a task and part instead of one row a pair, none lost; equal for any number of parts."""
    rows, docs, plain = small
    vocabulary = copy.copy(plain.vocabulary)
    vocabulary.parts = parts = 4
    held = spark.sparkContext.broadcast(vocabulary)
    training = docs.where(F.col("doc_id").isin([i for i, _ in rows if cases.crc(i) % 10 != 0]))
    found = maxent.count_contexts(training, held).collect()
    assert len(found) <= 3 * parts and {r["part"] for r in found} == set(range(parts))
    got = Counter()
    for r in found:
        for key, n in zip(maxent.unpacked_names(r["names"]).tolist(), maxent.unpacked(r["counts"]).tolist()):
            got[key] += n
    want = Counter()
    for i, text in rows:
        if cases.crc(i) % 10 != 0:
            tokens = [int(maxent.START), *(name(w) for w in text.split()), int(maxent.END)]
            want.update(plain.pair(a, b) for a, b in zip(tokens, tokens[1:]))
    classes = {key: n for key, n in got.items() if (key >> 58) % 64 == maxent.HISTORY}
    assert {key: n for key, n in got.items() if key not in classes} == want and sum(classes.values()) == sum(want.values())
    one = {r["doc_id"]: r["score"] for r in maxent.score(docs, steps=6, common=24, words=3, pairs=5).collect()}
    monkeypatch.setattr(maxent, "PART", 2000)
    many = {r["doc_id"]: r["score"] for r in maxent.score(docs, steps=6, common=24, words=3, pairs=5).collect()}
    assert one.keys() == many.keys() and all(math.isclose(one[k], many[k], rel_tol=1e-6) for k in one)


def test_most_used_rows_are_at_most_so_many(spark):
    table = spark.createDataFrame([(i, 1 + i % 3) for i in range(300)], "key long, n long")
    for limit in (0, 3, 100, 150, 299, 300, 1000):
        found = [r["n"] for r in table.where(maxent.most_used(table, "key", limit)).collect()]
        assert min(limit, 300) - 5 <= len(found) <= limit and sum(n == 3 for n in found) == min(len(found), 100)


def test_model_grows_with_the_corpus(spark):
    sizes = []
    for n in (100, 400):
        docs = cases.frame(spark, sentences(n, random.Random(5)))
        counts = maxent.count_tokens(docs).groupBy("token").agg(F.sum("n").alias("n"))
        every = counts.collect()
        vocabulary = maxent.Vocabulary(every, sum(r["n"] for r in every), len(every), {})
        trained = maxent.train(docs, counts, spark.sparkContext.broadcast(vocabulary), steps=1)
        sizes.append(trained.weights.count())
    assert sizes[1] > 1.2 * sizes[0]


def test_blocks_are_trained_to_their_optimum():
    rng = np.random.default_rng(4)
    block = np.repeat([0, 1], [5, 3])
    n, m = rng.integers(2, 30, 8).astype(float), rng.random(8) * 20 + 0.1
    mass = np.array([100.0, 60.0]) + np.bincount(block, weights=m)
    total = np.bincount(block, weights=n) + [7, 0]
    weight, shift = maxent.train_blocks(block, n, m, total, mass, 0.15, 800)
    norm = mass * np.exp(shift)
    assert np.allclose(norm, mass + np.bincount(block, weights=m * np.expm1(weight)))
    slope = n - total[block] * m * np.exp(weight) / norm[block] - 0.15 * weight
    assert np.abs(slope).max() < 1e-3


def test_blocks_over_several_batches(spark):
    """A block of many pairs, cut over Arrow batches, is trained as one."""
    vocabulary = maxent.Vocabulary([], 0, 0, {s: 5000.0 for s in range(maxent.SHARED)})
    held = spark.sparkContext.broadcast(vocabulary)
    rows = [((maxent.SINGLES << 58) | (a << 24) | w, 2, 3000, 3.1) for a in (7, 8) for w in range(500)]
    blocks = spark.createDataFrame(rows, "key long, n long, total long, m double")
    whole = {r["key"]: r["value"] for r in maxent.fit_members(blocks, held, 0.15, 10).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        cut = {r["key"]: r["value"] for r in maxent.fit_members(blocks, held, 0.15, 10).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert cut == whole and len(whole) == 1002


def test_gradient_is_that_of_the_log_likelihood():
    rows = [{"token": t, "n": 10 + t} for t in range(80)]
    model = maxent.Maxent(maxent.Vocabulary(rows, 5000, 80, {s: 150.0 for s in range(maxent.SHARED)}), 64)
    rng = np.random.default_rng(4)
    history = rng.integers(0, (maxent.CLASSES + 1) ** 2, 5)
    counts = np.zeros((5, maxent.CLASSES))
    counts[np.arange(5), rng.integers(0, 40, 5)] = 3

    def likelihood():
        a = maxent.log_softmax(model.logits(history))
        i, j = np.nonzero(counts)
        return (counts[i, j] * a[i, j]).sum()

    gradient, _ = model.gradient(history, counts)
    row = maxent.features(history, 64)[0, 1]
    for column in (1, 3):
        model.weights[row, column] += 1e-5
        up = likelihood()
        model.weights[row, column] -= 2e-5
        assert math.isclose((up - likelihood()) / 2e-5, gradient[row, column], rel_tol=1e-3, abs_tol=1e-6)
        model.weights[row, column] += 1e-5


def test_tokens_of_texts():
    tokens, first = maxent.tokens_of(pa.array(["A b\tA", None, "", "É é"]))
    assert first.tolist() == [0, 4, 5, 6, 9]
    assert tokens[0] == tokens[2] != tokens[1] and [t for t in tokens[[3, 4, 5, 8]]] == [maxent.END] * 4
    assert tokens[6] != tokens[7]  # only A-Z is lower-cased


def test_empty_table(spark):
    assert maxent.score(cases.empty(spark)).collect() == []
