"""Operator 4: placement law, slots and awkward rows."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from lodestar.llm import sharding

from . import cases


def placed(spark, docs, **options):
    return sharding.shard(docs, **options).collect()


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_rows_sizes_and_slots(spark):
    rows = placed(spark, cases.edge(spark))
    check_slots(rows)
    want = sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in cases.edge_texts())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    by_key = defaultdict(set)
    for r in rows:
        by_key[r["doc_id"]].add((r["shard"], r["grown_shard"], r["law"]))
    assert all(len(v) == 1 for v in by_key.values())  # the key and the shard count decide


def test_growth_moves_rows_into_the_new_shard_only_and_weights_hold(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = placed(spark, keys, weights=(1.0, 2.0, 1.0, 4.0), new_weight=2.0)
    check_slots(rows)
    assert all(r["grown_shard"] in (r["shard"], 4) for r in rows)
    share = [sum(r["shard"] == s for r in rows) / 20_000 for s in range(4)]
    assert all(abs(a - b) < 0.02 for a, b in zip(share, (0.125, 0.25, 0.125, 0.5)))
    assert abs(sum(r["grown_shard"] == 4 for r in rows) / 20_000 - 0.2) < 0.02
    smaller = {r["doc_id"]: r["shard"] for r in placed(spark, keys, weights=(1.0, 2.0, 1.0, 4.0, 2.0))}
    assert all(smaller[r["doc_id"]] == r["grown_shard"] for r in rows)


def test_empty_table(spark):
    assert placed(spark, cases.empty(spark)) == []
