"""Operator 10 against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import search

SCHEMA = "vec_id long, embedding array<float>, label int, uid int, id string, dims int, score double"


def table(n, dims, seed, levels=None):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims)) * 0.3
    if levels:
        v = np.round(v * levels) / levels  # many ties
    rows = [(i, [*map(float, x.astype(np.float32))], 1, 2, "i", 3, 0.5) for i, x in enumerate(v)]
    nan, inf = float("nan"), float("inf")
    rows += [(5000 + i, bad, 1, 2, "i", 3, 0.5) for i, bad in enumerate([None, [nan] * dims, [inf] * dims, [None] * dims])]
    rows += [(key, [], 1, 2, "i", 3, 0.5) for key in (6000, 6001)]  # empty vectors: 0 with one another
    rows += [(0, rows[1][1], 1, 2, "i", 3, 0.5), (None, rows[2][1], 1, 2, "i", 3, 0.5), (-50, rows[3][1], 1, 2, "i", 3, 0.5)]
    return rows


def plain(rows, k):
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(256 * x) for x in r[1]] for r in good]
    out = []
    for i, q in enumerate(good):
        if q[0] is None or q[0] % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(ints[i], ints[j])), r[0] is None, r[0] or 0) for j, r in enumerate(good) if j != i and len(ints[j]) == len(ints[i]))
        out += [(q[0], n + 1, None if none else key, -score) for n, (score, none, key) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize(("n", "dims", "levels", "block"), [(260, 12, None, 64), (200, 4, 3, 50), (120, 8, None, 1000), (3, 5, None, 10)])
def test_best_rows_with_ties(spark, n, dims, levels, block):
    rows = table(n, dims, n, levels)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = search.top_k(docs, F.col("id") % 50 == 0, k=5, block=block, chunk=3).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(plain(rows, 5), key=key)


def test_bounds_hold_and_processing_stops_early():
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(3000, 16)) * 0.2).astype(np.int64)
    vectors[7] = vectors[11] * 3
    index = search.ImpactIndex(vectors)
    for i in range(40):
        rows, scores = index.top(vectors[i], 5, own=i)
        exact = vectors @ vectors[i]
        exact[i] = np.iinfo(np.int64).min
        assert sorted(scores)[-5:] == sorted(exact)[-5:] and len(rows) < 300


@pytest.mark.parametrize("dtype", [np.int64, object])
def test_each_dimension_is_one_span_a_round(dtype):
    """In descending order of impact, every posting that adds anything once, and few spans for many segments."""
    rng = np.random.default_rng(6)
    vectors = rng.integers(-300, 300, (2000, 12))
    vectors[:, 3], vectors[:, 4] = 7, rng.integers(0, 2, 2000)
    index = search.ImpactIndex(vectors.astype(dtype))
    for query in rng.integers(-300, 300, (20, 12)) * (rng.random((20, 12)) < 0.8):
        query = query.astype(dtype)
        floor = np.minimum(query * index.least, query * index.most)
        gained, spans, before = np.zeros(2000, dtype), 0, None
        for some, unseen, last in index.rounds(query, floor):
            new = np.zeros(2000, dtype)
            for d, first, end in some:
                new[index.order[d, first:end]] += query[d] * index.ranked[d, first:end] - floor[d]
                spans += 1
            gained += new
            exact = vectors.astype(dtype) @ query - floor.sum()
            assert (gained <= exact).all() and (exact <= gained + unseen).all()
            assert before is None or unseen <= before
            assert last == (unseen == 0)
            before = unseen
        assert (gained == exact).all() and spans < len(index.dim) / 2


def test_components_of_any_size(spark):
    rng = np.random.default_rng(8)
    sizes = [1e-300, 0.25, 1.0, 1e7, 1e15, 1e150, 1e300, 1.7e308]
    rows = [(i, [float(x) for x in rng.choice([-1, 1], 3) * rng.choice(sizes, 3)], 1, 2, "i", 3, 0.5) for i in range(150)]
    rows += [(200 + i, [1e300, 1e15, -1.0], 1, 2, "i", 3, 0.5) for i in range(3)]  # ties beyond the longs
    docs = spark.createDataFrame(rows, SCHEMA.replace("float", "double", 1)).repartition(3)
    exact = [[math.floor(256 * x) if math.isfinite(256 * x) else int(x) * 256 for x in r[1]] for r in rows]
    want = []
    for i, q in enumerate(rows):
        if q[0] % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(exact[i], exact[j])), r[0]) for j, r in enumerate(rows) if j != i)
            want += [(q[0], n + 1, key, -s if abs(s) < 2 ** 63 - 1 else None) for n, (s, key) in enumerate(scores[:5])]
    found = search.top_k(docs, F.col("id") % 50 == 0, k=5, block=40, chunk=2).collect()
    assert sorted(map(tuple, found)) == sorted(want) and any(r["score"] is None for r in found)


def test_empty_table_and_no_queries(spark):
    assert search.top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).collect() == []
    assert search.top_k(spark.createDataFrame([(7, [1.0, 2.0], 1, 2, "i", 3, 0.5)], SCHEMA), F.col("id") % 50 == 0).collect() == []
