"""Operator 12: document fingerprints by winnowing.

A text is read as *units*: a run of at most 32 letters or digits of scripts that
put spaces between words is one unit; every other code point that is no white
space is a unit of its own (signs, the characters of scripts written without
spaces, and those of longer runs).
Every run of ``k`` units gets a rolling hash, the polynomial
``sum(code[j] * BASE**(k-1-j)) mod 2**31-1`` over hash codes of its units.  Of
every ``window`` hashes in a row the smallest is chosen, the rightmost of equal
ones; what is chosen by any window, with its position, is the fingerprint.  So a
passage of ``window + k - 1`` units that two texts share leaves the same hash in
both fingerprints (the guarantee), and no shared run below ``k`` units ever does.

Only DataFrame functions are used.  Arrays have no running fold that keeps its
steps, so the rolling values are made by doubling: the hashes of runs of 2n units
are those of n units combined with themselves n places on.  Window minima double
in the same way, over hash and position packed in one long.

``against_next`` compares each text with the next one by key: rows are dealt by
ranges of the key, and each range also gets the first row of the range after it,
so one shuffle of the texts serves and no task sees more than its range.

Defined cases: a null text counts as empty; a text without units has an empty
fingerprint, one of fewer than ``k`` units a single hash of all of them, one of
fewer than ``window`` hashes a single choice.  The likeness of two fingerprints
is the share of their distinct hashes they have in common, 1 if both are empty.
Null keys come first; rows of equal keys are ordered by their texts.  The next
row after the last is the first one (of a single row: itself).  Only the key and
the text column are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import stage

#: Code points of the scripts that put spaces between words (ASCII letters and
#: digits, Latin to Sinhala, Georgian to Ethiopic, extended Latin and Greek, Hangul).
LETTER = r"[0-9A-Za-z\x{AA}-\x{DFF}\x{10A0}-\x{139F}\x{1E00}-\x{1FFF}\x{AC00}-\x{D7A3}]"
UNIT = rf"(?<!{LETTER}){LETTER}{{1,32}}+(?!{LETTER})|\S"
PRIME = 2 ** 31 - 1
BASE = 1_000_003
PLACES = 1 << 32
FINGERPRINT = "array<struct<position: int, hash: int>>"


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _without_last(a: Column, n: int) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - n, F.lit(0)))


def _without_first(a: Column, n: int) -> Column:
    return F.slice(a, F.lit(n + 1), F.greatest(F.size(a) - n, F.lit(0)))


def _followed_by(n: int):
    """Hash of a run followed by a run of ``n`` units."""
    power = _long(pow(BASE, n, PRIME))
    return lambda a, b: (a * power + b) % _long(PRIME)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = 5, window: int = 8) -> DataFrame:
    """Add ``name``: the chosen hashes of ``text`` with their positions (counted in units).

    Each step is a column of its own that the next one names as an argument, never
    inside a lambda, so that it is computed once per row."""
    if k < 1 or window < 1:
        raise ValueError("k and window must be at least 1")
    tmp = f"_{name}_"
    col = lambda c: F.col(f"`{tmp}{c}`")
    units = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(UNIT), F.lit(0))
    out = df.withColumn(f"{tmp}h1", F.transform(units, lambda u: F.pmod(F.xxhash64(u), _long(PRIME))))
    n = 1
    while 2 * n <= k:
        out = out.withColumn(f"{tmp}h{2 * n}", F.zip_with(
            _without_last(col(f"h{n}"), n), _without_first(col(f"h{n}"), n), _followed_by(n)))
        n *= 2
    length = n
    while length < k:  # the smaller powers of two that make up k
        n //= 2
        if length + n <= k:
            out = out.withColumn(f"{tmp}h{length + n}", F.zip_with(
                _without_last(col(f"h{length}"), n), _without_first(col(f"h{n}"), length), _followed_by(n)))
            length += n
    few = F.when(F.size(col("h1")) > 0, F.array(F.aggregate(
        col("h1"), _long(0), lambda h, code: (h * _long(BASE) + code) % _long(PRIME)))).otherwise(F.array().cast("array<long>"))
    hashes = F.when(F.size(col(f"h{k}")) > 0, col(f"h{k}")).otherwise(few)
    # of equal hashes the one with the larger position packs to the smaller long
    out = out.withColumn(f"{tmp}m1", F.transform(
        hashes, lambda h, i: h * _long(PLACES) + (_long(PRIME) - i.cast("long"))))
    n = 1
    while 2 * n <= window:
        out = out.withColumn(f"{tmp}m{2 * n}", F.zip_with(
            _without_last(col(f"m{n}"), n), _without_first(col(f"m{n}"), n), _smaller))
        n *= 2
    if n < window:  # two overlapping spans of n cover the window
        out = out.withColumn(f"{tmp}w", F.zip_with(
            _without_last(col(f"m{n}"), window - n), _without_first(col(f"m{n}"), window - n), _smaller))
        minima = col("w")
    else:
        minima = col(f"m{n}")
    one = F.when(F.size(col("m1")) > 0, F.array(F.array_min(col("m1")))).otherwise(col("m1"))
    chosen = F.array_distinct(F.when(F.size(minima) > 0, minima).otherwise(one))
    return out.withColumn(name, F.transform(chosen, lambda v: F.struct(
        (_long(PRIME) - F.pmod(v, _long(PLACES))).cast("int").alias("position"),
        F.shiftright(v, 32).cast("int").alias("hash")))).select(*[f"`{c}`" for c in df.columns], f"`{name}`")


def hash_set(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(fingerprint.getField("hash"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two hash sets; of two empty ones 1."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def as_text(fingerprint: Column) -> Column:
    """``hash@position`` (hash in hexadecimal) of every choice, in order, joined by spaces."""
    return F.array_join(F.transform(fingerprint, lambda e: F.concat(
        F.lower(F.hex(e["hash"])), F.lit("@"), e["position"].cast("string"))), " ")


def beside_next(docs: DataFrame, key: str, text: str, ranges: int | None = None) -> tuple[DataFrame, WindowSpec]:
    """Rows (_key, _text) dealt so that each row's successor lies in the same group of the
    window that is returned; rows with ``_guest`` are such successors only.

    The groups are ranges of the key, bounded by what Spark's range partitioning of the
    keys alone gives: ``ranges`` of them (16 for each shuffle partition).  The first row of
    each range is also dealt to the range before it, that of the first one to the last."""
    spark = docs.sparkSession
    parts = ranges or 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), body.alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    place = F.struct("_key", "_hash")
    firsts = stage(rows.select("_key", "_hash").repartitionByRange(parts, "_key", "_hash")
                   .groupBy(F.spark_partition_id().alias("_part")).agg(F.min(place).alias("_first")), "range-bounds")
    bounds = firsts.agg(F.sort_array(F.collect_list("_first"))).scalar()  # ``parts`` entries at most
    bound = lambda at: F.get(F.col("_bounds"), at)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(parts.bit_length()))])
    ranged = rows.withColumn("_bounds", bounds).withColumn("_range", F.aggregate(  # binary search
        steps, F.lit(0), lambda at, step: at + F.when(bound(at + step - 1) <= place, step).otherwise(0)) - 1)
    before = F.when(F.col("_range") == 0, F.size("_bounds") - 1).otherwise(F.col("_range") - 1)
    own = F.struct(F.col("_range"), F.lit(False).alias("_guest"))
    guest = F.struct(before.alias("_range"), F.lit(True).alias("_guest"))
    copies = F.when(bound(F.col("_range")) == place, F.array(own, guest)).otherwise(F.array(own))
    dealt = ranged.select("_key", "_text", "_hash", F.inline(copies))
    return dealt, Window.partitionBy("_range").orderBy("_guest", "_key", "_hash", "_text")


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, window: int = 8,
                 ranges: int | None = None) -> DataFrame:
    """One row per document: key, n_chars, ``edited`` (its last half replaced by the start of
    the next document), both fingerprints, and the likeness of its own to the edited text's
    (near_edited) and to the next document's (near_next)."""
    dealt, order = beside_next(docs, key, text, ranges)
    named = with_fingerprint(dealt.withColumn("_next_text", F.lead("_text").over(order)), "_text", "_print", k, window)
    paired = named.withColumn("_next_print", F.lead("_print").over(order)).where("NOT _guest")
    size = F.char_length("_text")
    half = F.floor(size / 2).cast("int")
    cut = paired.withColumn("edited", F.concat(F.left("_text", size - half), F.left("_next_text", half)))
    both = with_fingerprint(cut, "edited", "edited_print", k, window)
    sets = (both.withColumn("_own", hash_set(F.col("_print"))).withColumn("_new", hash_set(F.col("edited_print")))
            .withColumn("_other", hash_set(F.col("_next_print"))))
    return sets.select(
        F.col("_key").alias(key), size.cast("long").alias("n_chars"), "edited",
        F.col("_print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_other")).alias("near_next"))
