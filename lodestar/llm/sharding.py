"""Operator 4: weighted rendezvous sharding with gapless slots.

Every shard draws a score for a record from a hash of (record key, shard):
``-ln(u) / weight`` with u uniform in (0, 1).  The smallest score wins, so a
shard gets records in proportion to its weight, and adding a shard moves a
record only if the new shard's score beats the old winner's: rows move into
the new shard and nowhere else.  The law kept is therefore ``key``.

All of it is DataFrame expressions.  Slots number the rows of a shard without
gaps: rows are numbered within (staged file, shard), a group no larger than
one staged file, and the files' counts are added up into offsets.

Defined cases: a null key is a key of its own (all such rows share a shard);
a null text has size 1 and crc32 0; repeated keys share a shard and get
different slots; an empty table gives an empty result.  Only the key and the
text columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small

from .common import stage


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0-based) that wins ``key`` among shards of the given weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(text, F.lit(shard)), 11).cast("double")
        u = (bits + F.lit(0.5)) * F.lit(2.0 ** -53)
        scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard")))
    best = F.least(*scores) if len(scores) > 1 else scores[0]
    return best.getField("shard")


def number_within(rows: DataFrame, group: str, slot: str) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... without gaps within each value of ``group``.

    ``rows`` is staged; no task gets more rows of a group than one staged file
    holds, however large the group is.
    """
    staged = stage(rows, "numbered").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = staged.groupBy("_file", group).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_file", group).orderBy("_row")) - 1
    numbered = staged.withColumn("_local", local)
    return (join_small(numbered, offsets, ["_file", group], "inner")
            .withColumn(slot, F.col("_offset") + F.col("_local"))
            .drop("_file", "_row", "_local", "_offset"))


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text",
          weights: Sequence[float] = (1.0,) * 8, new_weight: float = 1.0) -> DataFrame:
    """One row per document: its key, size, text_crc32, law, shard, slot and the shard
    it would have with one more shard of weight ``new_weight`` (grown_shard)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(f"`{key}`").alias(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(f"`{key}`"), weights).alias("shard"),
        rendezvous(F.col(f"`{key}`"), [*weights, new_weight]).alias("grown_shard"),
    )
    return number_within(placed, "shard", "slot").select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
