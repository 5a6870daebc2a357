"""Operator 13: divergence of sources, against a dense plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestar.llm import divergence

from .cases import edge, empty

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, part int"


def plain(rows, least, add=5, scale=10 ** 9, ranks=50):
    """{(lang, source, part, rank): (item, value)} over dense columns."""
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        docs[lang or ""].update(set(found))
        groups[lang or "", source or ""].update(found)
    out = {}
    for lang, seen in docs.items():
        kept = sorted(t for t, d in seen.items() if d >= least)
        mine = {s: c for (x, s), c in groups.items() if x == lang}

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + scale * (count[t] + add) // (total + add * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in mine.items()}, shares(sum(mine.values(), Counter()))
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                for rank, (value, _, item) in enumerate(found, 1):
                    out[lang, s, part, rank] = (item, -value)
    return out


def check(frame, rows, least, **kw):
    got = {(r["lang"], r["source"], r["part"], r["rank"]): (r["item"], r["value"])
           for r in divergence.audit(frame, least=least, **kw).collect()}
    assert got == plain(rows, least, **kw)
    return got


def corpus(sources=7, docs=160):
    rng = random.Random(4)
    words = [f"{'é' if i % 9 == 0 else ''}W{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for _ in range(docs):
        s = 0 if rng.random() < 0.35 else rng.randrange(sources)
        pool = words[:40 + 10 * (s % 5)]
        text = " ".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["aa", "bb", None]), f"s{s}"))
    return [*rows, (None, "aa", "silent"), ("1 2 3", "cc", "x"), ("Ab1aB_ABÉé", "cc", "y"), ("", "aa", None)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "t", 1, 2) for i, (t, lang, s) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [1, 5, 30])
def test_audit_equals_the_dense_version(spark, least):
    rows = corpus()
    got = check(table(spark, rows), rows, least)
    assert any(k[2] == "pair" for k in got) and (least == 30 or any(k[2] == "term" for k in got))


def test_many_blocks_and_tiles(spark, monkeypatch):
    """Many blocks, and more columns than one tile holds, give the same rows."""
    monkeypatch.setattr(divergence, "BLOCK", 8)
    rows = corpus(sources=40, docs=400)
    check(table(spark, rows), rows, 3)


def test_ranks_and_ties(spark):
    rows = [("b a c", "x", "one")] * 2 + [("d e f", "x", "two")] * 2 + [("", "x", "three")]
    got = check(table(spark, rows), rows, 1, ranks=2)
    assert [got["x", "one", "term", r][0] for r in (1, 2)] == ["a", "b"]
    assert ("x", "one", "term", 3) not in got


def test_edge_documents_and_empty_table(spark):
    docs = edge(spark)
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    check(docs, rows, 2)
    assert divergence.audit(empty(spark)).count() == 0


def test_run_length_distance():
    rng = np.random.default_rng(1)
    for _ in range(50):
        size = int(rng.integers(1, 60))
        columns = []
        for _ in range(2):
            at = np.flatnonzero(rng.random(size) < 0.4)
            columns.append((at, rng.integers(1, 4, len(at))))
        dense = [np.full(size, 2) for _ in columns]
        for d, (at, values) in zip(dense, columns, strict=True):
            d[at] = values
        x, y = (divergence.runs(size, 2, at, values) for at, values in columns)
        assert divergence.distance(x, y) == int(np.abs(dense[0] - dense[1]).sum())
        assert len(x[0]) == 1 + int((dense[0][1:] != dense[0][:-1]).sum())


def test_equal_counts_lie_together(spark):
    """The reordered vocabulary has fewer runs than the alphabetical one."""
    rows = [(t, lang or "", s or "") for t, lang, s in corpus(docs=400)]
    _, counted = divergence.count(table(spark, rows))
    placed = divergence.vocabulary(counted, 2)
    cells = {(r["source"], r["term"]): r["n"] for r in counted.where("lang = 'aa'").collect()}
    order = [r["term"] for r in placed.where("lang = 'aa'").orderBy("part", "position").collect()]

    def number(terms):
        return sum(sum(cells.get((s, a), 0) != cells.get((s, b), 0) for a, b in zip(terms, terms[1:], strict=False))
                   for s in {s for s, _ in cells})

    assert number(order) < number(sorted(order))


def test_terms_of_long_texts_are_split_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    text = "abc defghijkl m 1x Über-AB"
    assert [t.decode() for some in divergence.terms(text.encode()) for t in some] == TERM.findall(text.translate(LOWER))


def test_counts_beyond_64_bits_stay_exact(spark):
    from pyspark.sql import functions as F
    n, total, size = 9_000_000_000_000, 20_000_000_000_000, 77
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(size), 5, 10 ** 9).alias("p")).collect()[0]
    assert row["p"] == 1 + 10 ** 9 * (n + 5) // (total + 5 * size)
