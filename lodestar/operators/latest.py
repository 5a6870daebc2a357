"""Per-key aggregations of an inbound change table (AGG1-3, AGG5-7, JN1).

All have a partial (map-side) phase, so a hot key sends at most one partial
row per map task into the shuffle: hash aggregates for sums and counts, sort
aggregates for ``max_by`` over structs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import REQUEST_FIELDS, request_key


def _q(c: str) -> str:
    return f"`{c}`"


def _ordered(kind: T.DataType) -> bool:
    """Whether values of the type can be compared."""
    return isinstance(kind, T.AtomicType) and not isinstance(kind, (T.VariantType, T.SpatialType))


def latest_per_key(df: DataFrame, keys: list[str], order: str = "numeric") -> DataFrame:
    """AGG1: the whole latest record of each key, latest = max request identity.

    One aggregate: ``max_by(struct(row), identity)``; no key table and no join
    back (JN1 is folded in).  The identity is held once, as the key of the maximum.
    ``order='text'`` reproduces the text comparison of the concatenated identity
    (quirk Q1)."""
    rest = [c for c in df.columns if c not in keys]
    if order == "numeric" and not set(REQUEST_FIELDS) & set(keys):
        others = [c for c in rest if c not in REQUEST_FIELDS]
        if all(_ordered(df.schema[c].dataType) for c in others):
            # the greatest row by identity first: among rows of one identity any may be the latest
            row = F.struct(*[F.col(c) for c in REQUEST_FIELDS], *[F.col(_q(c)) for c in others])
            agg = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.max(row).alias("_latest"))
            return agg.select(*[F.col(_q(c)) if c in keys else F.col(f"_latest.{_q(c)}").alias(c) for c in df.columns])
    row = F.struct(*[F.col(_q(c)) for c in rest])
    agg = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.max_by(row, request_key(order)).alias("_latest"))
    return agg.select(*[F.col(_q(k)) for k in keys], *[F.col(f"_latest.{_q(c)}").alias(c) for c in rest]).select(
        *df.columns
    )


def latest_identities(df: DataFrame, keys: list[str], order: str = "numeric") -> DataFrame:
    """The latest-record key table: request identity + key per key."""
    agg = df.groupBy(*[F.col(_q(k)) for k in keys]).agg(
        F.max_by(F.struct(*[F.col(c) for c in REQUEST_FIELDS]), request_key(order)).alias("_id")
    )
    return agg.select(*[F.col(f"_id.{c}").alias(c) for c in REQUEST_FIELDS], *[F.col(_q(k)) for k in keys])


def join_latest_semi(inbound: DataFrame, identities: DataFrame) -> DataFrame:
    """JN1: inbound rows whose identity is in the key table (inbound columns only)."""
    return inbound.join(identities.select(*REQUEST_FIELDS), list(REQUEST_FIELDS), "left_semi")


def _sum_cast(df: DataFrame, figure: str):
    return F.sum(F.col(_q(figure))).cast(df.schema[figure].dataType).alias(figure)


def sum_per_key(df: DataFrame, keys: list[str], figures: list[str]) -> DataFrame:
    """AGG2: sums of key figures per key, cast back to the figure types (an
    overflow raises under ANSI).  When none is named, ``rowcnt`` is the number of
    rows of the key (the source system's literal ``1`` per key says nothing)."""
    aggs = [_sum_cast(df, f) for f in figures] or [F.count(F.lit(1)).alias("rowcnt")]
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(*aggs)


def sum_per_stock_key(df: DataFrame, keys: list[str], figures: list[str], day_col: str = "calday") -> DataFrame:
    """AGG3: as AGG2 without the day; the earliest day is kept."""
    k = [c for c in keys if c != day_col]
    aggs = [F.min(F.col(_q(day_col))).alias(day_col)] + [_sum_cast(df, f) for f in figures]
    return df.groupBy(*[F.col(_q(c)) for c in k]).agg(*aggs)


def key_profile(df: DataFrame, keys: list[str], mode_col: str = "recordmode") -> DataFrame:
    """AGG7: per key, the maximum of each request field separately and the row
    count (field-wise maxima are not one record: a profile only)."""
    aggs = [F.max(c).alias(c) for c in REQUEST_FIELDS]
    if mode_col in df.columns:
        aggs.append(F.max(mode_col).alias(mode_col))
    aggs.append(F.count(F.lit(1)).alias("cnt"))
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(*aggs)


def count_rows(df: DataFrame) -> DataFrame:
    """AGG5."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def distinct_requests(df: DataFrame) -> DataFrame:
    """AGG6."""
    return df.select("reqtsn").distinct()
