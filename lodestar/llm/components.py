"""Connected components of a link table, by alternating star contractions.

Every round hangs each vertex's neighbours on its smallest neighbour.  Groups
are never gathered: a vertex's smallest neighbour is an aggregate with a
map-side phase, joined back to the links (the joined side is unique per
vertex, the link side can be split).  Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _contract(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over rows (u, v)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = stage(large, "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    low_first = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return low_first.union(least.select("u", F.col("m").alias("v"))).distinct()


def _sign(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).collect()[0])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every vertex of ``links`` (u, v): root is the smallest vertex reachable."""
    held = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    sign = _sign(held)
    while sign[0]:
        held = stage(_contract(held), "small-star")
        now = _sign(held)
        if now == sign:
            break
        sign = now
    return held.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
