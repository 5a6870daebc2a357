"""Operator 13: how the sources of each language diverge in their vocabulary.

Terms are maximal runs of ASCII letters (lower-cased) and characters beyond ASCII.
A language keeps the terms that occur in at least ``least`` of its documents.
Each (language, source) group and each language as a whole gives a kept term the
smoothed share ``p = 1 + scale * (count + add) // (N + add * V)``; two groups
diverge by the sum of ``|p - q|`` over all kept terms, and a term stands out in a
group by ``p - q`` against its language.

A group is a column over its language's vocabulary and is mostly runs: the
vocabulary is reordered so that equal counts lie together (terms found in the same
groups first, within these by the counts in the language's smallest groups, then
by the whole vector of counts), each column is run-length encoded, and a pair of
columns is compared by its merged run boundaries: ``|p - q|`` times run length.

How it scales: terms are counted per batch of texts before they are shuffled; the
reordered vocabulary is range-partitioned and read back in blocks of ``BLOCK``
terms; a task compares one block of one pair of column tiles (``TILE`` columns
each), so neither a long vocabulary nor many sources meet in one task.  Sums of
64-bit values are exact: a share is at most ``scale`` + 1 and shares are summed over
one block in numpy and over blocks as Spark longs (an overflow raises).

Defined cases: null text, language and source count as ''; a row counts as a
document of its own even if it is repeated; groups without terms take part with
count 0; a language without kept terms gives pairs of value 0 and no terms; an
empty table gives an empty result.  Only the three columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.sizing import join_small

from .common import release, stage

BLOCK = 4096  # terms of the vocabulary that are compared at a time
TILE = 32  # columns of a tile
LEADERS = 6  # groups whose counts order the vocabulary within equal support
HELD = 200_000  # distinct (group, term) entries a task holds before it hands them on
PIECE = 1 << 22  # bytes of a text that are split at a time
#: Every byte that is no part of a term becomes a space, A-Z become a-z.
_TABLE = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
COUNTED = "lang string, source string, term string, n long, docs long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of those of about ``PIECE`` bytes each."""
    clean, lo = text.translate(_TABLE), 0
    while lo < len(clean):
        hi = clean.find(b" ", lo + PIECE)
        hi = len(clean) if hi < 0 else hi
        yield clean[lo:hi].split()
        lo = hi


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), added up within a task as far as
    memory goes."""
    release()
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            size = len(n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.repeat(lang, size), "source": pa.repeat(source, size),
                "term": pa.array(list(n), pa.binary()).cast(pa.string()),
                "n": pa.array(n.values(), pa.int64()), "docs": pa.array([docs[t] for t in n], pa.int64())})
        found.clear()

    held = 0
    for batch in batches:
        rows = zip(batch.column("text").cast(pa.large_binary()), batch.column("lang").to_pylist(),
                   batch.column("source").to_pylist(), strict=True)
        for text, lang, source in rows:
            n, docs = found.setdefault((lang, source), (Counter(), Counter()))
            here: set[bytes] = set()
            held -= len(n)
            for some in terms(text.as_py()):
                n.update(some)
                here.update(some)
            docs.update(here)
            held += len(n)
            if held > HELD:
                yield from handed()
                held = 0
    yield from handed()


def share(count: Column, total: Column, size: Column, add: int, scale: int) -> Column:
    """1 + scale * (count + add) // (total + add * size), exact for counts of any size."""
    whole = lambda c: c.cast("decimal(20,0)")
    wide = whole(count) + F.lit(add)
    below = F.greatest(whole(total) + whole(size) * F.lit(add), F.lit(1))
    return (F.lit(1) + F.call_function("div", wide * F.lit(scale), below)).cast("long")


def count(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(occurring groups, occurrences n and documents docs of every term in every group)."""
    named = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n)
                          for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    groups = named.select("lang", "source").distinct()
    counted = (named.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term")
               .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return groups, stage(counted, "term-counts")


def vocabulary(counted: DataFrame, least: int) -> DataFrame:
    """The kept terms (lang, term, total) with their place (part, position) in an order
    that clusters equal counts.  Staged: places are fixed."""
    sizes = counted.groupBy("lang", "source").agg(F.sum("n").alias("_size"))
    by_size = Window.partitionBy("lang").orderBy("_size", "source")
    leaders = sizes.withColumn("_leads", F.row_number().over(by_size)).where(F.col("_leads") <= LEADERS).drop("_size")
    marked = join_small(counted, leaders, ["lang", "source"], "left")
    kept = marked.groupBy("lang", "term").agg(
        F.sum("docs").alias("_docs"), F.sum("n").alias("total"),
        F.bit_xor(F.xxhash64("source")).alias("_support"), F.bit_xor(F.xxhash64("source", "n")).alias("_vector"),
        *[F.sum(F.when(F.col("_leads") == i, F.col("n")).otherwise(0)).alias(f"_c{i}") for i in range(1, LEADERS + 1)],
    ).where(F.col("_docs") >= least)
    order = ["lang", "_support", *[f"_c{i}" for i in range(1, LEADERS + 1)], "_vector", "term"]
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (kept.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("lang", "term", "total", F.spark_partition_id().alias("part"),
                      (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("position")))
    return stage(placed, "vocabulary")


def runs(size: int, usual: int, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length form (ends, values) of a column of ``size`` terms that holds ``usual``
    except ``values`` at the places ``at``."""
    dense = np.full(size, usual, np.int64)
    dense[at] = values
    ends = np.append(np.flatnonzero(dense[1:] != dense[:-1]) + 1, size)
    return ends, dense[ends - 1]


def distance(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of |x - y| over two run-length columns, run by run of their merged boundaries."""
    ends = np.union1d(x[0], y[0])
    gap = np.abs(x[1][np.searchsorted(x[0], ends)] - y[1][np.searchsorted(y[0], ends)])
    return int((gap * np.diff(ends, prepend=0)).sum())


def _compared(key: tuple, table: pa.Table) -> pa.Table:
    """All pairs of the columns of tile ``a`` with those of tile ``b`` over one block."""
    lang, a, b = key[0].as_py(), key[3].as_py(), key[4].as_py()
    size = table.column("size")[0].as_py()
    group, at, value = (table.column(c).to_numpy() for c in ("group", "at", "p"))
    order = np.lexsort((at, group))
    group, at, value = group[order], at[order], value[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    columns = {}
    for lo, hi in zip(starts, np.append(starts[1:], len(group)), strict=True):
        # the row with place -1 says what the column holds elsewhere
        columns[int(group[lo])] = runs(size, value[lo], at[lo + 1:hi], value[lo + 1:hi]) if size else None
    left = [g for g in columns if g // TILE == a]
    right = [g for g in columns if g // TILE == b]
    pairs = [(x, y, distance(columns[x], columns[y]) if size else 0) for x in left for y in right if x < y]
    xs, ys, sums = zip(*pairs, strict=True) if pairs else ((), (), ())
    return pa.table({"lang": pa.array([lang] * len(pairs), pa.string()), "x": pa.array(xs, pa.int64()),
                     "y": pa.array(ys, pa.int64()), "value": pa.array(sums, pa.int64())})


def _pairs(info: DataFrame, cells: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, x, y, value) of every pair of group numbers x < y of a language."""
    blocks = words.groupBy("lang", "part", "block").agg(
        F.count("*").cast("int").alias("size"), F.min("position").alias("first"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(
        F.least(F.col("tile"), u).alias("a"), F.greatest(F.col("tile"), u).alias("b")))
    tiled = info.select("lang", "source", "group", "usual", F.col("tile"), tiles.alias("pairs"))
    heads = tiled.join(blocks, "lang", "left").select(
        "lang", "part", "block", F.coalesce("size", F.lit(0)).alias("size"), F.inline("pairs"), "group",
        F.lit(-1).cast("long").alias("at"), F.col("usual").alias("p"))
    placed = join_small(cells, blocks, ["lang", "part", "block"], "inner")
    rest = join_small(placed, tiled, ["lang", "source"], "inner").select(
        "lang", "part", "block", "size", F.inline("pairs"), "group", (F.col("position") - F.col("first")).alias("at"), "p")
    parts = (heads.unionByName(rest).groupBy("lang", "part", "block", "a", "b")
             .applyInArrow(_compared, "lang string, x long, y long, value long"))
    return parts.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30,
          add: int = 5, scale: int = 10 ** 9, ranks: int = 50) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` ranks the other sources of the
    language by their divergence, part ``term`` the terms that stand out, up to ``ranks``."""
    groups, counted = count(docs, text, lang, source)
    words = vocabulary(counted, least).withColumn("block", F.floor(F.col("position") / BLOCK))
    whole = words.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("all"))
    in_groups = stage(counted.select("lang", "source", "term", "n").join(words, ["lang", "term"]), "cells")
    sizes = in_groups.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    in_order = Window.partitionBy("lang").orderBy("source")
    info = (groups.join(sizes, ["lang", "source"], "left").join(whole, "lang", "left")
            .select("lang", "source", F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("kept", F.lit(0)).alias("kept"),
                    F.coalesce("all", F.lit(0)).alias("all"), (F.row_number().over(in_order) - 1).cast("long").alias("group"),
                    F.count("*").over(Window.partitionBy("lang")).alias("_groups"))
            .withColumn("tile", F.floor(F.col("group") / TILE).cast("int"))
            .withColumn("tiles", F.ceil(F.col("_groups") / TILE).cast("int"))
            .withColumn("usual", share(F.lit(0), F.col("words"), F.col("kept"), add, scale)))
    info = stage(info, "groups")
    cells = join_small(in_groups, info.select("lang", "source", "words", "kept", "all"), ["lang", "source"], "inner").select(
        "lang", "source", "term", "part", "block", "position", share(F.col("n"), F.col("words"), F.col("kept"), add, scale).alias("p"),
        share(F.col("total"), F.col("all"), F.col("kept"), add, scale).alias("q"))
    found = _pairs(info, cells, words)
    both = found.unionByName(found.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), "value"))
    names = info.select("lang", F.col("group"), "source")
    pairs = (both.join(names.withColumnRenamed("group", "x"), ["lang", "x"])
             .join(names.select("lang", F.col("group").alias("y"), F.col("source").alias("item")), ["lang", "y"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    terms_ = cells.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (pairs.withColumn("rank", F.row_number().over(ranked))
            .unionByName(terms_.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= ranks)))
