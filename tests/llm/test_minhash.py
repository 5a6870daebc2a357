"""Operator 8 against brute force over all pairs, and its estimator."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import components, minhash

from . import cases


def runs(text):
    w = cases.words(text)
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(x, y):
    union = x.keys() | y.keys()
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in union) for i in x.keys() & y.keys())


def plain(rows, threshold=0.8):
    """(key, class) of each row, in order."""
    sets = [runs(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] == rows[j][1] and sets[i]
            if same or sets[i] and sets[j] and sets[i].keys() & sets[j].keys() and jaccard(sets[i], sets[j]) >= threshold:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in groups.items()}
    return [(rows[i][0], least[find(i)], len(groups[find(i)])) for i in range(len(rows))]


def check(docs, rows):
    found = minhash.near_duplicates(docs).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = [(r["doc_id"], r["class_id"], r["class_size"]) for r in found]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    classes = len({(r["class_id"], r["class_size"] if r["class_size"] > 1 else i) for i, r in enumerate(found)})
    assert sum(r["kept"] for r in found) == classes
    stand = minhash.representatives(docs)
    assert stand.columns == docs.columns and stand.count() == classes


def test_edge_documents(spark):
    check(cases.edge(spark), cases.edge_texts())


def test_chains_groups_and_borderline_pairs(spark):
    rng = random.Random(6)
    rows = []
    for g in range(12):  # chains: each text changes a word or two of the one before
        w = cases.sentence(rng, 150).split()
        for i in range(10):
            rows.append((len(rows), " ".join(w)))
            for _ in range(g % 4):
                w[rng.randrange(len(w))] = f"n{rng.random():.6f}"
    shared = cases.sentence(rng, 70)  # a passage in many texts does not make them alike
    rows += [(len(rows) + i, f"{cases.sentence(rng, 60)} {shared} {cases.sentence(rng, 20)}") for i in range(120)]
    check(cases.frame(spark, rows).repartition(4), rows)


def test_large_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(8)
    base = cases.sentence(rng, 100).split()
    rows = []
    for i in range(40):
        w = list(base)
        for at in rng.sample(range(100), 1 + i % 9):
            w[at] = f"z{i}x{at}"
        rows.append((i, " ".join(w)))
    check(cases.frame(spark, rows).repartition(3), rows)


def test_signatures_estimate_probability_jaccard_of_weighted_sets():
    rng = random.Random(7)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    texts = [" | ".join(rng.choices(pool, k=40)) for _ in range(6)]
    owner, names, weights = minhash.weighted_runs(pa.array(texts), 5)
    sig = minhash.signatures(owner, names, weights, len(texts), 4000)
    for i in range(len(texts)):
        for j in range(i):
            want = jaccard(runs(texts[i]), runs(texts[j]))
            assert abs((sig[i] == sig[j]).mean() - want) < 0.04
            sets = [minhash._weighted_set(texts[x], 5) for x in (i, j)]
            assert abs(minhash.probability_jaccard(*sets) - want) < 1e-9


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: root[x] for x in linked}


def test_empty_table(spark):
    assert minhash.near_duplicates(cases.empty(spark)).collect() == []
    assert minhash.representatives(cases.empty(spark)).collect() == []
