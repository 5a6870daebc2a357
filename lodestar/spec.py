"""Entity specs: what one warehouse entity looks like and how it is loaded.

A spec replaces the per-entity SQL text of a config file by typed fields whose
expressions are Spark SQL strings given to ``F.expr``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KINDS = ("standard", "cube", "ncum", "master", "insert")


@dataclass(frozen=True)
class Attribute:
    """One attribute text table: code and text expressions over the staging rows."""

    name: str
    code: str
    text: str


@dataclass(frozen=True)
class Check:
    """One declared check: ``pk`` (the entity key is unique among rows that satisfy
    ``where``), ``initial`` (no initial value in the STRING ``column``) or ``not_null``
    (of ``column``, or of every NOT NULL column if none is named)."""

    kind: str
    column: str | None = None
    where: str = "true"

    def __post_init__(self):
        if self.kind not in ("pk", "initial", "not_null") or self.kind == "initial" and not self.column:
            raise ValueError(f"bad check {self!r}")


@dataclass(frozen=True)
class EntitySpec:
    name: str
    kind: str
    ddl: str  # target columns, e.g. "doc_num STRING NOT NULL, value_lc DECIMAL(17,2)"
    mapping: tuple[tuple[str, str], ...] = ()  # (target column, source expression)
    keys: tuple[str, ...] = ()
    figures: tuple[str, ...] = ()  # additive key figures (cube / ncum)
    where: str = "true"  # load filter on source rows
    order: str | None = None  # load order; a digit is an output ordinal
    partition_date: str | None = None  # partition by month of this DATE column
    buckets: int = 0  # unpartitioned targets: hash-bucket tables 2 / 5 on their merge keys
    srcformat: str = "parquet"
    delimiter: str = ","
    loadmanytimes: bool = False
    attributes: tuple[Attribute, ...] = ()
    # stock (ncum) entities: receipt/issue pairs and the day column
    stock_pairs: tuple[tuple[str, str], ...] = ()
    day_col: str = "calday"
    table_name: str | None = None
    safe_dml: bool = False  # audit every load before it is published
    checks: tuple[Check, ...] = (Check("not_null"), Check("pk"))  # what the audit checks
    quarantine: bool = False  # rows that do not fit go to a reject table instead of ending the load
    files: tuple[str, ...] = ()  # a fixed file list instead of the folder
    root: str | None = None  # extract folder (also an object store's), if the caller names none
    archive: bool = False  # keep activated inbound rows in a history table

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def not_null(self) -> list[str]:
        # StructType.fromDDL drops NOT NULL; read it from the DDL text itself.
        out = []
        for part in _split_ddl(self.ddl):
            words = part.split()
            if len(words) >= 2 and "NOT NULL" in " ".join(w.upper() for w in words[1:]):
                out.append(words[0].strip("`"))
        return out

    @property
    def table(self) -> str:
        return self.table_name or f"dwh_t_{self.name}"

    def inbound_schema(self) -> T.StructType:
        req = T.StructType.fromDDL("reqtsn STRING, datapakid STRING, record INT")
        return T.StructType(req.fields + self.schema.fields)

    def key_spec(self, drop: str | None = None) -> list[str]:
        return [k for k in self.keys if k != drop]

    def require_keys(self) -> None:
        if not self.keys:
            # quirk Q17: insert-only entities have no keys and cannot be activated
            raise ValueError(f"entity {self.name} ({self.kind}) has no keys: insert-only, cannot activate")


def _split_ddl(ddl: str) -> list[str]:
    parts, depth, cur = [], 0, []
    for ch in ddl:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        parts.append("".join(cur).strip())
    return parts
