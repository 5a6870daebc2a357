"""What an activation target has absorbed, as bitmaps (ACT6, Q6).

A row of an inbound change table is named by (reqtsn, datapakid, record).  A target
remembers the rows it holds by one bitmap for each package and stretch of 32,768
record numbers, so the memory grows with packages, not with records.  The bitmaps
lie in folders by a hash of the request; the folders are named in the manifest of
the target's snapshot itself.  So they count from the very commit that publishes
the rows, a crash before it leaves nothing behind, and an emptied target, whose
manifest starts anew, has absorbed nothing.  A merge reads only the folders of the
requests that arrive.  A bucket of more than ``FOLDERS`` folders is written again as
one, with the bitmaps of a package joined.

Rows with a NULL in their identity cannot be told apart: they are never remembered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions import REQUEST_FIELDS
from lodestar.operators.sizing import join_small, materialize
from lodestar.sources.store import Store

BUCKETS = 64
FOLDERS = 16
PACKAGE = ["reqtsn", "datapakid"]
SCHEMA = "reqtsn STRING, datapakid STRING, slot BIGINT, bits BINARY"


def request_bucket() -> Column:
    return F.format_string("%02d", F.pmod(F.hash("reqtsn"), F.lit(BUCKETS)))


def package_marks(rows: DataFrame) -> DataFrame:
    """One row per package and stretch of record numbers: its bitmap and its number of rows.
    Materialized: small beside the rows."""
    return materialize(rows.groupBy(*PACKAGE, F.bitmap_bucket_number("record").alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("record")).alias("bits"), F.count(F.lit(1)).alias("n")))


def holds(bits: Column, record: Column) -> Column:
    """Whether ``record`` is set in the bitmap of its stretch."""
    at = F.bitmap_bit_position(record)
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def pending(store: Store, inbound: DataFrame, target: str) -> DataFrame:
    """The inbound rows that ``target`` has not absorbed: ``inbound`` itself if none of its
    packages was seen before, else the rest, materialized once."""
    if not store.absorbed(target):
        return inbound
    arriving = [r["b"] for r in inbound.select(request_bucket().alias("b")).distinct().collect()]  # at most BUCKETS
    entries = store.absorbed(target, arriving)
    if not entries:
        return inbound
    packages = inbound.select(*PACKAGE).distinct()
    seen = materialize(join_small(store.read_absorbed(target, entries, SCHEMA), packages, PACKAGE, "left_semi")
                       .groupBy(*PACKAGE, "slot").agg(F.bitmap_or_agg("bits").alias("_bits")))
    if seen.isEmpty():
        return inbound
    marked = join_small(inbound.withColumn("slot", F.bitmap_bucket_number("record")), seen, [*PACKAGE, "slot"], "left",
                        materialized=True)
    new = F.col("_bits").isNull() | ~holds(F.col("_bits"), F.col("record"))
    return materialize(marked.where(new).select(*inbound.columns))


def once(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """One row per identity, for sums: a record delivered twice counts once.

    Only packages that hold more rows than identities, by their marks, are shuffled
    to drop the doubles; all others are passed through."""
    double = marks.where(F.col("n") > F.bitmap_count("bits"))
    unnamed = F.col("reqtsn").isNull() | F.col("datapakid").isNull()
    found = double.agg(F.count(F.lit(1)).alias("n"), F.count_if(unnamed).alias("unnamed")).collect()[0]
    if not found["n"]:
        return rows
    if found["unnamed"]:
        return rows.dropDuplicates(list(REQUEST_FIELDS))
    packages = materialize(double.select(*PACKAGE).distinct())
    again = join_small(rows, packages, PACKAGE, "left_semi", materialized=True)
    return (join_small(rows, packages, PACKAGE, "left_anti", materialized=True)
            .unionByName(again.dropDuplicates(list(REQUEST_FIELDS))))


def absorb(store: Store, target: str, marks: DataFrame) -> list[dict]:
    """Write the marks and return what the target's next snapshot has absorbed."""
    named = marks.where(" AND ".join(f"{c} IS NOT NULL" for c in (*PACKAGE, "slot")))
    written = store.write_absorbed(target, named.select(*PACKAGE, "slot", "bits"), request_bucket())
    entries = store.absorbed(target) + written
    touched = {e["bucket"] for e in written}
    full = {b for b in touched if sum(e["bucket"] == b for e in entries) > FOLDERS}
    if not full:
        return entries
    old = store.read_absorbed(target, [e for e in entries if e["bucket"] in full], SCHEMA)
    joined = old.groupBy(*PACKAGE, "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
    return [e for e in entries if e["bucket"] not in full] + store.write_absorbed(target, joined, request_bucket())
