"""Data checks (CHK1-4): each yields rows ``(check, cnt)``; all zero = pass.

Checks are aggregates computed on the executors; only the verdict row (one
row) reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import INITIAL, REQUEST_FIELDS
from lodestar.spec import EntitySpec


def _row(name: str, cnt_df: DataFrame) -> DataFrame:
    return cnt_df.select(F.lit(name).alias("check"), F.col("cnt").cast("long").alias("cnt"))


def check_pk(df: DataFrame, keys: list[str], where: str = "true", name: str = "pk") -> DataFrame:
    """CHK1: number of keys occurring more than once."""
    dup = df.where(F.expr(where)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _row(name, dup.agg(F.count(F.lit(1)).alias("cnt")))


def check_pk_incoming(existing: DataFrame, incoming: DataFrame, keys: list[str], name: str = "pk",
                      where: str = "true") -> DataFrame:
    """CHK1 for a load: keys of ``incoming`` that would occur more than once in
    ``existing`` plus ``incoming``.  The incoming rows are read once, for their keys
    and counts; only existing rows whose key arrives are read past a semi join
    (incoming keys broadcast when measured small), so the table itself is never grouped.
    Where no row exists yet, the doubles are counted from that aggregate and no key is kept."""
    from lodestar.operators.sizing import join_small, materialize

    inc = incoming.where(F.expr(where)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if existing.isEmpty():
        return _row(name, materialize(inc.where(F.col("n") > 1).agg(F.count(F.lit(1)).alias("cnt"))))
    inc = materialize(inc)
    hit = join_small(existing.where(F.expr(where)).select(*keys), inc.select(*keys), keys, "left_semi", materialized=True)
    double = inc.where(F.col("n") > 1).select(*keys).unionByName(hit).distinct()
    return _row(name, double.agg(F.count(F.lit(1)).alias("cnt")))


def check_initial(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """CHK2: rows whose key holds the initial value chr(0)."""
    cnt = df.agg(F.count_if(F.col(col) == F.lit(INITIAL)).alias("cnt"))
    return _row(name or f"initial:{col}", cnt)


def check_not_null(df: DataFrame, spec: EntitySpec, column: str | None = None) -> DataFrame:
    """CHK3: NULLs in NOT NULL columns (or in one), one pass, one row per column."""
    cols = [c for c in ([column] if column else spec.not_null) if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "check STRING, cnt LONG")
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(f"not_null:{c}").alias("check"), F.col(f"`{c}`").cast("long").alias("cnt"))
                      for c in cols])
    return counts.select(F.inline(pairs))


def check_report(checks: list[DataFrame]) -> DataFrame:
    """CHK4: union of check rows."""
    return reduce(lambda a, b: a.unionByName(b), checks)


def verdict(report: DataFrame) -> bool:
    """True when every check counted zero (one aggregate row to the driver)."""
    row = report.agg(F.coalesce(F.max("cnt"), F.lit(0)).alias("worst")).collect()[0]
    return int(row["worst"]) == 0


def load_metrics(staged: T.StructType, spec: EntitySpec, n: str) -> dict[str, Column]:
    """The declared checks of one load into table ``n`` that a count tells (NULLs, initial
    values), as aggregates to be observed while the rows are written."""
    out: dict[str, Column] = {}
    if n == "1":
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUEST_FIELDS])
        out["not_null:request"] = F.count_if(any_null)
    for check in spec.checks:
        if check.kind == "not_null":
            for c in [check.column] if check.column else spec.not_null:
                if c in staged.names:
                    out[f"not_null:{c}"] = F.count_if(F.col(f"`{c}`").isNull())
        elif check.kind == "initial":
            if staged[check.column].dataType.typeName() != "string":
                raise ValueError(f"initial-value check on {check.column}, which is no STRING column")
            out[f"initial:{check.column}"] = F.count_if(F.col(f"`{check.column}`") == F.lit(INITIAL))
    return out


def load_checks(existing: DataFrame, staged: DataFrame, spec: EntitySpec, n: str) -> list[DataFrame]:
    """The declared checks of one load into table ``n`` that need the other rows: its
    unique keys over existing + staged rows (read incrementally).  The inbound change log
    (1) is unique on the request identity, not on the entity key; the stock marker (5)
    is keyed without the day."""
    if n == "1":
        return [check_pk_incoming(existing, staged, list(REQUEST_FIELDS), name="pk:request")]
    keys = spec.key_spec(drop=spec.day_col) if n == "5" else list(spec.keys)
    return [check_pk_incoming(existing, staged, keys, where=check.where)
            for check in spec.checks if check.kind == "pk" and keys]


def standard_checks(df: DataFrame, spec: EntitySpec) -> list[DataFrame]:
    out = [check_not_null(df, spec)]
    if spec.keys:
        out.append(check_pk(df, list(spec.keys)))
        out.append(check_initial(df, spec.keys[0]))
    return out
