"""Scalar column functions used by entity specs (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model (must equal the source system's conventions):
# the initial value of a characteristic is one NUL character; dates travel as
# 'yyyyMMdd' text; a request identity is reqtsn (23 chars) + datapakid (6 chars)
# + record; the delete indicator of recordmode is 'D'.
INITIAL = "\u0000"
BW_DATE_FORMAT = "yyyyMMdd"
REQTSN_WIDTH = 23
DATAPAKID_WIDTH = 6
DELETE_MODE = "D"
REQUEST_FIELDS = ("reqtsn", "datapakid", "record")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initial(c) -> Column:
    """NULL characteristic -> initial value chr(0) (PRJ3)."""
    return F.coalesce(_col(c), F.lit(INITIAL))


def bw_date(c, strict: bool = True) -> Column:
    """'yyyyMMdd' text -> DATE (PRJ4). Strict raises on bad text under ANSI;
    non-strict maps unparsable text such as '00000000' to NULL."""
    if strict:
        return F.to_date(_col(c), BW_DATE_FORMAT)
    return F.try_to_date(_col(c), BW_DATE_FORMAT)


def to_decimal(c, precision: int, scale: int) -> Column:
    """Text or number -> DECIMAL(p,s) (PRJ5); raises on bad input under ANSI."""
    return _col(c).cast(f"decimal({precision},{scale})")


def request_key(order: str = "numeric") -> Column:
    """Orderable request identity.

    ``numeric`` compares (reqtsn, datapakid, record) field by field;
    ``text`` reproduces max(reqtsn || datapakid || record) where record is
    compared as text, so 9 sorts after 10 (quirk Q1)."""
    if order == "numeric":
        return F.struct(*[F.col(c) for c in REQUEST_FIELDS])
    if order == "text":
        return F.concat(F.col("reqtsn"), F.col("datapakid"), F.col("record").cast("string"))
    raise ValueError(f"unknown request order {order!r}")


def is_delete(c="recordmode") -> Column:
    """True only for the delete indicator; NULL and '' are after-images."""
    return F.coalesce(_col(c) == F.lit(DELETE_MODE), F.lit(False))


def null_safe_add(*cols: Column) -> Column:
    """Sum where NULL counts as 0 unless every operand is NULL (Q5 default)."""
    anyv = F.coalesce(*cols)
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0))
        total = term if total is None else total + term
    return F.when(anyv.isNull(), F.lit(None)).otherwise(total)
