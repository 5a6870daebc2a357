"""Index of keys to months: where a delta's keys can lie in a month-partitioned target (JN2).

When the day is not part of the key, a change can hit a row of any month.  The index
holds pairs (hash of the key, month) in folders by a hash bucket, sorted by hash; the
folders are named in the manifest of the target's snapshot, as what it has absorbed is.
So a merge reads the buckets of its keys instead of the key columns of the whole table.

The pairs may be too many, never too few: a merge adds the pairs of its delta, and a key
that left a month is still found there, which costs a rewrite of that month and changes
nothing else.  Data folders that no merge has seen yet (loads, replaced months) are marked
by the absence of ``indexed`` in their manifest entry: the next merge scans the keys of
these alone and adds them.  A bucket of more than ``FOLDERS`` folders is written again as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small
from lodestar.sources.store import NULL_MONTH, PART_COL, Store, month_of

BUCKETS = 16  # few enough that one listing finds the files of all
FOLDERS = 16
SCHEMA = "key_hash BIGINT, month STRING"


def bucket() -> Column:
    return F.format_string("%02d", F.pmod(F.col("key_hash"), F.lit(BUCKETS)))


def pairs(rows: DataFrame, keys: list[str], date_col: str, like: DataFrame) -> DataFrame:
    """(key_hash, month) of ``rows``, which hold a key once; keys are hashed in the types of ``like``."""
    hashed = F.xxhash64(*[F.col(f"`{k}`").cast(like.schema[k].dataType) for k in keys])
    month = F.coalesce(month_of(date_col), F.lit(NULL_MONTH))
    return rows.select(hashed.alias("key_hash"), month.alias("month"))


def _write(store: Store, target: str, rows: DataFrame) -> list[dict]:
    rows = rows.withColumn(PART_COL, bucket()).hint("rebalance", PART_COL).sortWithinPartitions(PART_COL, "key_hash")
    return store.write_side(target, rows.drop(PART_COL), bucket())


def candidates(store: Store, target: str, delta: DataFrame, keys: list[str], date_col: str) -> tuple[list[str], list[dict]]:
    """The months that ``delta`` can change, and the index entries of the target's next snapshot.

    At most one value per calendar month and ``BUCKETS`` bucket names reach the driver."""
    active = store.read(target)
    own = pairs(delta, keys, date_col, active)  # the delta is materialized
    new = own
    if store.unindexed(target):
        new = own.unionByName(pairs(store.read_unindexed(target), keys, date_col, active))
    entries = store.index(target) + _write(store, target, new)
    asked = {r["b"] for r in own.select(bucket().alias("b")).distinct().collect()}
    hit = [e for e in entries if e["bucket"] in asked]
    if not hit:
        return [], entries
    known = store.read_side(target, hit, SCHEMA)
    found = join_small(known, own.select("key_hash"), ["key_hash"], "left_semi", materialized=True)
    months = sorted(r["month"] for r in found.select("month").distinct().collect())
    return months, compacted(store, target, entries)


def compacted(store: Store, target: str, entries: list[dict]) -> list[dict]:
    """The entries, with buckets of too many folders written again as one, each pair once."""
    count: dict[str, int] = {}
    for e in entries:
        count[e["bucket"]] = count.get(e["bucket"], 0) + 1
    full = {b for b, n in count.items() if n > FOLDERS}
    if not full:
        return entries
    old = store.read_side(target, [e for e in entries if e["bucket"] in full], SCHEMA).distinct()
    return [e for e in entries if e["bucket"] not in full] + _write(store, target, old)
