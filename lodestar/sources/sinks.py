"""File sinks outside the store (SNK6-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.sequence import running_total


def convert(df: DataFrame, fmt: str, path: str) -> None:
    """SNK6: format conversion (e.g. CSV -> ORC / Parquet) into a fresh folder."""
    df.write.mode("errorifexists").format(fmt).save(path)


def write_by_request(df: DataFrame, fmt: str, path: str, col: str = "reqtsn", cluster: bool = True) -> None:
    """SNK7: write one folder per request id.  By default rows of a request are
    clustered first so each request folder gets few files (a rebalance: AQE
    splits a hot request over several tasks instead of one).  Input that is
    already range-partitioned by request (as numbered inbound rows are) is
    written as it stands: each task holds a contiguous run of requests."""
    if cluster:
        df = df.hint("rebalance", col)
    df.write.mode("errorifexists").partitionBy(col).format(fmt).save(path)


def read_by_request(spark: SparkSession, fmt: str, path: str, schema: T.StructType,
                    requests: list[str] | None = None) -> DataFrame:
    """Read back a request-partitioned folder; the request column stays text
    (no type inference on 23-digit ids) and a request list prunes folders."""
    df = spark.read.schema(schema).format(fmt).load(path)
    if requests is not None:
        df = df.where(F.col("reqtsn").isin(list(requests)))
    return df


def request_profile(df: DataFrame, col: str = "reqtsn") -> DataFrame:
    """SNK8: rows per request with a running total in request order."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    return running_total(counts, [col], "cnt", name="running_total")
