"""Set operations and views (SET1, SET2, VW1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inbound_active_view(inbound: DataFrame, active: DataFrame, cols: list[str], name: str | None = None) -> DataFrame:
    """SET1: inbound rows and all active rows, entity columns only (UNION ALL)."""
    df = inbound.select(*cols).unionByName(active.select(*cols))
    if name:
        df.createOrReplaceTempView(name)
    return df


def material_text_view(md: DataFrame, name: str | None = None) -> DataFrame:
    """VW1: material, group || last six digits of the material, text."""
    df = md.select(
        "material",
        F.concat(F.col("matl_group"), F.expr("right(material, 6)")).alias("material_ext"),
        "material_txt",
    )
    if name:
        df.createOrReplaceTempView(name)
    return df


def material_views(md: DataFrame, subset: list[str], prefix: str | None = None) -> dict[str, DataFrame]:
    """VW1: the declared views over master data: all columns (``all``), the text view
    (``ext``) and a subset of columns (``01``); registered as ``<prefix>_<name>`` if asked."""
    views = {"all": md, "ext": material_text_view(md), "01": md.select(*subset)}
    for name, df in views.items():
        if prefix:
            df.createOrReplaceTempView(f"{prefix}_{name}")
    return views


def missing_keys(latest_keys: DataFrame, active: DataFrame, keys: list[str]) -> DataFrame:
    """SET2: keys of the latest-key table that are not in active (EXCEPT DISTINCT)."""
    return latest_keys.select(*keys).subtract(active.select(*keys))
