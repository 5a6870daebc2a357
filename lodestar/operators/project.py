"""Projection, load filter and load order (PRJ1-7, FLT1, SRT1, SRT2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.spec import EntitySpec


def _q(name: str) -> str:
    return f"`{name}`"


def mapped_columns(spec: EntitySpec) -> list:
    """Target columns from the spec mapping, cast to the declared types.

    Unmapped target columns are taken by name.  Casting follows store
    assignment under ANSI: a bad text raises instead of becoming NULL."""
    m = dict(spec.mapping)
    cols = []
    for f in spec.schema.fields:
        src = F.expr(m[f.name]) if f.name in m else F.col(_q(f.name))
        cols.append(src.cast(f.dataType).alias(f.name))
    return cols


def project(df: DataFrame, spec: EntitySpec, n: str = "2", where: str | None = None,
            order: str | None = None) -> DataFrame:
    """PRJ1/PRJ2 + FLT1 + SRT1: ``SELECT mapped FROM src WHERE where ORDER BY order``.

    Table ``1`` (inbound) gets the request fields first."""
    cond = where if where is not None else spec.where
    src = df.where(F.expr(cond)) if cond and cond.strip().lower() not in ("true", "(1=1)") else df
    cols = mapped_columns(spec)
    if n == "1":
        req = [
            F.col(_q("reqtsn")).cast("string").alias("reqtsn"),
            F.col(_q("datapakid")).cast("string").alias("datapakid"),
            F.col(_q("record")).cast("int").alias("record"),
        ]
        cols = req + cols
    out = src.select(*cols)
    return sort_load(out, order if order is not None else spec.order)


def project_sql(spark, view: str, spec: EntitySpec, n: str = "2") -> DataFrame:
    """PRJ1 + FLT1 over a staged view (SRC11, ``files.stage``) as one SQL
    statement: ``SELECT <mapping> FROM <view> WHERE <filter>``, the spec's
    expressions as SQL text, planned by Catalyst like any DataFrame query."""
    m = dict(spec.mapping)
    cols = [f"CAST({m.get(f.name, _q(f.name))} AS {f.dataType.simpleString()}) AS {_q(f.name)}"
            for f in spec.schema.fields]
    if n == "1":
        cols = ["CAST(reqtsn AS STRING) AS reqtsn", "CAST(datapakid AS STRING) AS datapakid",
                "CAST(record AS INT) AS record", *cols]
    return spark.sql(f"SELECT {', '.join(cols)} FROM {_q(view)} WHERE {spec.where or 'true'}")


def _orderable(dt) -> bool:
    from pyspark.sql import types as T

    return not isinstance(dt, (T.MapType, T.ArrayType, T.StructType, T.BinaryType, T.VariantType))


def sort_load(df: DataFrame, order: str | None) -> DataFrame:
    """SRT1: load order; a bare digit is an ordinal of the output columns.

    The remaining columns follow as tie-breakers (the order among ties is
    unspecified anyway): the range partitioning of the global sort can then
    cut a hot order value over several tasks instead of sorting it in one."""
    return df.orderBy(*order_keys(df, order)) if order else df


def order_keys(df: DataFrame, order: str) -> list:
    """The sort columns of a load order: those it names, then the others as tie-breakers."""
    keys, named = [], set()
    for item in order.split(","):
        item = item.strip()
        desc = item.lower().endswith(" desc")
        name = item.rsplit(" ", 1)[0].strip() if (desc or item.lower().endswith(" asc")) else item
        if name.isdigit():
            name = df.columns[int(name) - 1]
            col = F.col(_q(name))
        else:
            col = F.expr(name)
        named.add(name.strip("`"))
        keys.append(col.desc() if desc else col.asc())
    ties = [F.col(_q(f.name)).asc() for f in df.schema.fields if f.name not in named and _orderable(f.dataType)]
    return [*keys, *ties]


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """SRT2: first n rows of an order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)
