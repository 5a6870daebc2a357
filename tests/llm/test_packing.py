"""Operator 2: exact pieces, valid sequences, and few of them."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import packing

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_and_sequences(spark):
    tokenizer, capacity = Tokenizer.from_file(PATH), 256
    rows = packing.pack(cases.edge(spark), PATH, capacity=capacity, keep_ids=True).collect()
    want = []
    for key, text in cases.edge_texts():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((key is None, key or 0, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in rows]
    assert sorted(got) == sorted(want)
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows, capacity) <= -(-total // capacity) + 1


def test_cells_dealt_anew_lose_no_item_and_stay_near_the_bound(spark):
    rng = np.random.default_rng(4)
    lengths = np.concatenate([rng.integers(1, 60, 1500), rng.integers(30, 101, 1500), np.full(50, 100)])
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "uid long, length long")
    rows = packing.place(items, 100, cell=300, islands=2, turns=3).join(items, "uid").collect()
    assert sorted(r["uid"] for r in rows) == list(range(len(lengths)))
    plain = packing.best_fit(packing.Packing([], []), sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths.tolist(), 100)
    assert check_sequences(rows, 100) <= 1.01 * len(plain.bins) + 1


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 100, 200).tolist()
    order = lambda: rng.permutation(200).tolist()
    a, b = (packing.best_fit(packing.Packing([], []), order(), lengths, 100) for _ in range(2))
    for _ in range(20):
        child = packing.crossover(a, b, lengths, 100, rng)
        assert sorted(i for items in child.bins for i in items) == list(range(200))
        assert [sum(lengths[i] for i in items) for items in child.bins] == child.fill and max(child.fill) <= 100
        a, b = b, child


def test_islands_improve_on_best_fit_decreasing():
    lengths = [44] * 6 + [24] * 6 + [32] * 6  # 100 = 44 + 24 + 32, which best-fit-decreasing misses
    plain = packing.best_fit(packing.Packing([], []), list(range(18)), sorted(lengths, reverse=True), 100)
    best = packing.evolve(lengths, 100, [], np.random.default_rng(1), population=8, generations=60)
    assert len(best.bins) < len(plain.bins)


def test_same_result_when_run_again(spark):
    items = spark.range(500).select(F.col("id").alias("uid"), (F.col("id") * 37 % 90 + 5).alias("length"))
    first, second = ({(r["uid"], r["sequence_id"], r["offset"]) for r in packing.place(items, 100, cell=100).collect()} for _ in range(2))
    assert first == second


@pytest.mark.parametrize("capacity", [2048])
def test_empty_table(spark, capacity):
    assert packing.pack(cases.empty(spark), PATH, capacity=capacity).collect() == []
