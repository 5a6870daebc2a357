"""Exact ordered numbering and running totals without one-task groups.

``row_number() over (partition by g order by o)`` sends each group ``g`` to one
task; a hot group holding a third of the rows would then be sorted by a single
task.  Here the rows are range-partitioned on the *full* sort key (groups are
cut across partitions) and sorted inside each partition, and every row takes
its position in that order (``monotonically_increasing_id`` right after the
sort, fixed by writing the sorted rows once).  A row's number is its position minus
the position of its group's first row in the same partition, plus the rows of
its group in earlier partitions.  Only the per-(partition, group) table, at
most (#groups + #partitions) rows, is aggregated and joined back: the rows
themselves are shuffled once, by the range partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small, materialize


def _range_sorted(df: DataFrame, keys: list, num_partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    s = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())  # position in the sorted partition
    )
    # Written once (shared folder): fixes partition ids and positions for the
    # passes below, which read only their columns, and survives executor loss.
    return materialize(s)


def sequence_within(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    name: str = "record",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = row_number() within ``group_cols`` ordered by ``order_cols``.

    (group_cols, order_cols) must identify rows for the numbering to be exact
    and deterministic.  The number is an INT, as the request field it fills: a
    group of more than 2**31 - 1 rows raises (deliver it in several packages)."""
    s = _range_sorted(df, [*group_cols, *order_cols], num_partitions)
    # rows whose group is NULL are a group like any other: each group column is compared
    # as a value and a flag
    group = [c for i, g in enumerate(group_cols) for c in (F.col(f"`{g}`").isNull().alias(f"_null{i}"),
                                                           F.coalesce(F.col(f"`{g}`").cast("string"), F.lit("")).alias(f"_group{i}"))]
    names = [f"{n}{i}" for i in range(len(group_cols)) for n in ("_null", "_group")]
    s = s.select("*", *group)
    runs = s.groupBy("_pid", *names).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*names).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select("_pid", *names, "_first",
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    out = join_small(s, carry, ["_pid", *names], "inner")
    number = F.col("_pos") - F.col("_first") + F.lit(1) + F.col("_carry")
    return out.withColumn(name, number.cast("int")).drop("_pid", "_pos", *names, "_first", "_carry")


def running_total(
    df: DataFrame,
    order_cols: list[str],
    value_col: str,
    name: str = "running_total",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = sum(value) over (order by order_cols rows unbounded preceding).

    ``order_cols`` must be unique.  Work per task is one range partition."""
    s = _range_sorted(df, list(order_cols), num_partitions)
    local = s.withColumn(
        "_local",
        F.sum(value_col).over(
            Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    totals = s.groupBy("_pid").agg(F.sum(value_col).alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a proven bound, so this window and broadcast are small
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    out = local.join(F.broadcast(offsets), ["_pid"], "inner")
    return out.withColumn(name, F.col("_local") + F.col("_off")).drop("_pid", "_pos", "_local", "_off")
