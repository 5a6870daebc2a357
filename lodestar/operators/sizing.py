"""Measured broadcast: a side is broadcast only after its size has been counted.

The small side is written as Parquet in the shared checkpoint folder so
that the measurement and the join read the same rows, then its exact payload
is summed on the executors (one aggregate row comes back).  Beyond the limit
the join stays a shuffle join and AQE's skew handling applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import work_dir

LIMIT_KEY = "lodestar.broadcast.maxBytes"
DEFAULT_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def broadcast_limit(spark) -> int:
    v = spark.conf.get(LIMIT_KEY, None)
    return int(v) if v is not None else DEFAULT_LIMIT


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows once as Parquet in the shared checkpoint folder (never a
    local one) and read them back, so that later passes open only the columns they use."""
    if any(kind in df.schema.simpleString() for kind in ("void", ":interval,", ":interval>")):
        return df.checkpoint(eager=True)  # types that Parquet does not hold
    path = work_dir(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Exact in-memory payload estimate: fixed width per column plus string bytes."""
    fixed = 0
    var = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            var.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            fixed += 16  # upper bound of any fixed-width value (decimal(38) incl.)
    row = F.lit(ROW_OVERHEAD + fixed)
    for v in var:
        row = row + v
    got = df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("b")).collect()[0]["b"]
    return int(got)


def fits_broadcast(df: DataFrame) -> bool:
    return measured_bytes(df) <= broadcast_limit(df.sparkSession)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str, materialized: bool = False) -> DataFrame:
    """``big.join(small)`` with ``small`` broadcast only if measured small enough."""
    if not materialized:
        small = materialize(small)
    if fits_broadcast(small):
        small = F.broadcast(small)
    return big.join(small, on, how)
