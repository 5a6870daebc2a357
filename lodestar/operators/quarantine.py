"""Quarantine: split a load into rows that fit the entity and rows that do not (PRJ4, PRJ5).

The strict projection ends the whole load at the first bad date or number.  Here the
same mapping is evaluated leniently, in the same pass, and every row gets the reasons
why it cannot be loaded:

* ``<column>: bad value``: the mapped value is NULL although a source column it is made
  from holds something (not NULL, blank, the initial value or zeros only, the source
  system's empty date);
* ``<column>: null``: NULL in a NOT NULL, key or request column;
* ``malformed line``: the reader could not take the line apart (CSV).

Rows without a reason are loaded.  The others go, with file, reason and their source
text as JSON, to a reject table, so nothing is lost and the load is not held up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import INITIAL, REQUEST_FIELDS
from lodestar.spec import EntitySpec

REASON, RAW, FILE, CORRUPT = "_reason", "_raw", "_file", "_corrupt"
INTERNAL = (REASON, RAW, FILE, CORRUPT)
REJECT_DDL = "n STRING, file STRING, reason STRING, raw STRING"
ANSI = "spark.sql.ansi.enabled"


@contextmanager
def _lenient(spark: SparkSession) -> Iterator[None]:
    """Expressions built inside give NULL for bad input instead of an error."""
    strict = spark.conf.get(ANSI)
    spark.conf.set(ANSI, "false")
    try:
        yield
    finally:
        spark.conf.set(ANSI, strict)


def _sources(expression: str, columns: list[str]) -> list[str]:
    """The source columns an expression names (text in quotes left out)."""
    code = re.sub(r"'(?:[^'\\]|\\.)*'", "''", expression)
    return [c for c in columns if re.search(rf"(?<![\w.]){re.escape(c)}(?!\w)", code, re.IGNORECASE)]


def _filled(column: str) -> Column:
    text = F.trim(F.col(f"`{column}`").cast("string"))
    return F.coalesce(~text.isin("", INITIAL) & ~text.rlike("^0+$"), F.lit(False))


def marked(src: DataFrame, spec: EntitySpec, n: str = "2") -> DataFrame:
    """The mapped rows of table ``n`` that pass the load filter, with ``_reason`` ('' if the
    row fits), ``_file`` and ``_raw``.  Source columns keep their names only in ``_raw``."""
    mapping = dict(spec.mapping)
    given = [c for c in src.columns if c not in INTERNAL]
    fields = list(spec.schema.fields)
    if n == "1":
        fields = list(spec.inbound_schema().fields[:len(REQUEST_FIELDS)]) + fields
    required = {*spec.not_null, *spec.keys, *(REQUEST_FIELDS if n == "1" else ())}
    values, reasons = [], []
    for f in fields:
        own = f.name in REQUEST_FIELDS and n == "1"
        text = mapping[f.name] if f.name in mapping and not own else f"`{f.name}`"
        value = F.expr(text).cast(f.dataType)
        values.append(value.alias(f.name))
        filled = [_filled(c) for c in _sources(text, given)]
        bad = F.lit(False)
        for one in filled:
            bad = bad | one
        reason = F.when(value.isNull() & bad, F.lit(f"{f.name}: bad value"))
        if f.name in required:
            reason = reason.when(value.isNull(), F.lit(f"{f.name}: null"))
        reasons.append(reason)
    json = F.to_json(F.struct(*[F.col(f"`{c}`") for c in given]))
    if CORRUPT in src.columns:
        broken = F.col(CORRUPT).isNotNull()
        why = F.when(broken, F.lit("malformed line")).otherwise(F.concat_ws("; ", *reasons))
        raw = F.coalesce(F.col(CORRUPT), json)
    else:
        broken, why, raw = F.lit(False), F.concat_ws("; ", *reasons), json
    name = F.col(FILE) if FILE in src.columns else F.lit(None).cast("string")
    with _lenient(src.sparkSession):
        # a malformed line is rejected whatever its columns would say to the filter
        return src.where(broken | F.expr(spec.where or "true")).select(
            *values, why.alias(REASON), raw.alias(RAW), name.alias(FILE))


def rejected(rows: DataFrame, n: str) -> DataFrame:
    """The reject table's rows of a marked load."""
    return rows.where(F.col(REASON) != "").select(
        F.lit(n).alias("n"), F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(RAW).alias("raw"))
