"""Dimensions: calendar, attribute text tables, master-data loads (DIM1-4, AGG4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.project import project
from lodestar.operators.sizing import materialize
from lodestar.spec import EntitySpec

# The default calendar range of the calendar dimension.
CAL_START = dt.date(2000, 1, 1)
CAL_END = dt.date(2030, 12, 31)


def calendar_from_bounds(bounds: DataFrame, weekend: str = "sat_sun") -> DataFrame:
    """DIM1 + DIM2 over a one-row frame of (start DATE, end DATE).

    Days come from ``explode(sequence(start, end, 1 day))``; ``weekend`` is
    Saturday/Sunday by default, ``'mon_sun'`` reproduces the day-1-or-7 test
    after the Monday=1 renumbering (quirk Q9)."""
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("calday"))
    return calendar_columns(days, weekend)


def calendar_columns(days: DataFrame, weekend: str = "sat_sun") -> DataFrame:
    d = F.col("calday")
    wd = ((F.dayofweek(d) + 5) % 7 + 1).cast("int")  # Monday=1 ... Sunday=7
    if weekend == "sat_sun":
        we = wd.isin(6, 7)
    elif weekend == "mon_sun":
        we = wd.isin(1, 7)
    else:
        raise ValueError(f"unknown weekend rule {weekend!r}")
    yr, mo, qu = F.year(d), F.month(d), F.quarter(d)
    return days.select(
        d.alias("calday"),
        F.date_format(d, "yyyyMMdd").alias("calday_s"),
        yr.cast("int").alias("calyear"),
        qu.cast("int").alias("calquarter1"),
        mo.cast("int").alias("calmonth2"),
        wd.alias("weekday1"),
        F.date_format(d, "EEEE").alias("weekday1_txt"),
        we.alias("weekend"),
        F.lit(False).alias("holiday"),
        F.concat(yr.cast("string"), F.lpad(mo.cast("string"), 2, "0")).alias("calmonth"),
        F.concat(yr.cast("string"), F.lpad(qu.cast("string"), 2, "0")).alias("calquarter"),
    )


def calendar(spark: SparkSession, start: dt.date = CAL_START, end: dt.date = CAL_END,
             weekend: str = "sat_sun") -> DataFrame:
    """Calendar dimension for a fixed day range (11,323 days by default)."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_from_bounds(bounds, weekend).orderBy("calday")


def calendar_for(df: DataFrame, date_col: Column, weekend: str = "sat_sun") -> DataFrame:
    """Calendar spanning the days of a table column (bounds by one aggregate)."""
    bounds = df.agg(F.min(date_col.cast("date")).alias("start"), F.max(date_col.cast("date")).alias("end"))
    return calendar_from_bounds(bounds.where(F.col("start").isNotNull()), weekend)


def attribute_table(staged: DataFrame, name: str, code: str, text: str, where: str = "true") -> DataFrame:
    """AGG4: distinct (code, text) pairs of one attribute, filtered, ordered by code.

    Two texts for one code give two rows (quirk Q11); CHK1 reports them."""
    return (
        staged.where(F.expr(where))
        .select(F.expr(code).cast("string").alias(name), F.expr(text).cast("string").alias(f"{name}_txt"))
        .distinct()
        .orderBy(F.col(name).asc(), F.col(f"{name}_txt").asc())
    )


def attribute_tables(staged: DataFrame, spec: EntitySpec) -> dict[str, DataFrame]:
    """DIM3: one (code, text) table per attribute of the spec, ordered by code.

    All attributes come from one scan of the staging rows: ``attributes_long``
    is computed once and checkpointed, and each table is a filter of that
    small result (not one scan and one distinct per attribute)."""
    if not spec.attributes:
        return {}
    texts = materialize(attributes_long(staged, spec))
    return {
        a.name: texts.where(F.col("attr") == a.name)
        .select(F.col("code").alias(a.name), F.col("text").alias(f"{a.name}_txt"))
        .orderBy(F.col(a.name).asc(), F.col(f"{a.name}_txt").asc())
        for a in spec.attributes
    }


def attributes_long(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """DIM3 in one pass: (attr, code, text) for all attributes with one scan and
    one distinct (partial dedup before the shuffle)."""
    parts = []
    for a in spec.attributes:
        parts += [F.lit(a.name), F.expr(a.code).cast("string"), F.expr(a.text).cast("string")]
    n = len(spec.attributes)
    stacked = staged.where(F.expr(spec.where)).select(
        F.inline(F.array(*[F.struct(parts[3 * i].alias("attr"), parts[3 * i + 1].alias("code"),
                                    parts[3 * i + 2].alias("text")) for i in range(n)]))
    )
    return stacked.distinct()


def load_master(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    """DIM4: filter, project, order: the content of a master-data snapshot."""
    return project(staged, spec, "0")
