"""Extract folders derived from the test tables, as a source system drops them.

``<root>/<entity>/t1/b<k>/`` hold the inbound delta in batches (rows from the
cut on), ``t2/`` (and ``t5/`` for stock) the active state before the cut.
They are written once per session and data folder (a ``_DONE`` marker), all
by Spark from the given tables.
"""

from __future__ import annotations

import hashlib
import pathlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import activate as act
from lodestar.operators import latest
from lodestar.operators.project import project
from lodestar.operators.sizing import materialize
from lodestar.plans import fixtures as fx
from lodestar.session import fixed_dir
from lodestar.spec import EntitySpec

_CACHE: dict = {}


def cached(spark: SparkSession, sf_dir: str, key: str, build):
    """Per-session cache of materialized fixture frames."""
    k = (spark.sparkContext.applicationId, sf_dir, key)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


def li_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cached(spark, sf_dir, "li_req", lambda: fx.lineitem_requests(spark, sf_dir))


def staging(spark: SparkSession, sf_dir: str, entity: str, numbered: bool = True) -> DataFrame:
    if entity == "events":
        return fx.events_staging(spark, sf_dir)
    li = li_requests(spark, sf_dir) if numbered else fx.lineitem_unnumbered(spark, sf_dir)
    return {"doc": fx.doc_staging, "cube": fx.cube_staging, "stock": fx.stock_staging}[entity](li)


SPECS = {"doc": fx.DOC, "cube": fx.CUBE, "stock": fx.STOCK, "events": fx.EVENTS}
#: What the cuts are compared with.  The request of a lineitem starts with its day, and the numbered
#: rows lie sorted by request: a cut by it skips what lies beyond, and orders as the day does.
DAY_TEXT = {"doc": "reqtsn", "cube": "reqtsn", "stock": "reqtsn", "events": "ev_date"}


def _day_text(entity: str):
    return F.col(DAY_TEXT[entity])


def split(spark: SparkSession, sf_dir: str, entity: str, numbered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(before, after) the cut, as staging rows."""
    st = staging(spark, sf_dir, entity, numbered)
    cut = (fx.EVENTS_CUT if entity == "events" else fx.CUT).replace("-", "")
    day = _day_text(entity)
    return st.where(day < F.lit(cut)), st.where(day >= F.lit(cut))


def inbound(spark: SparkSession, sf_dir: str, entity: str, part: str = "all", numbered: bool = True) -> DataFrame:
    """Typed inbound rows (table 1 projection) of all / before / after the cut.

    ``numbered=False`` is for uses that never look at ``record``: the rows are then a
    plain scan, pruned to the columns used, instead of the sorted and numbered copy."""
    spec = SPECS[entity]
    if part == "all":
        st = staging(spark, sf_dir, entity, numbered)
    else:
        before, after = split(spark, sf_dir, entity, numbered)
        st = before if part == "before" else after
    return project(st, spec, "1")


def initial_state(spark: SparkSession, sf_dir: str, entity: str, n: str = "2") -> DataFrame:
    """Active (or marker) state from the rows before the cut, typed.  Built
    once per session and data folder (written as Parquet): it is the input
    table of the activation queries, not part of their work."""
    return cached(spark, sf_dir, f"state_{entity}_{n}",
                  lambda: materialize(_initial_state(spark, sf_dir, entity, n)))


def _initial_state(spark: SparkSession, sf_dir: str, entity: str, n: str) -> DataFrame:
    spec = SPECS[entity]
    before = inbound(spark, sf_dir, entity, "before", numbered=spec.kind == "standard")
    # no row is active yet: the delta is merged as it comes from its aggregate, neither
    # written nor measured first, and the joins fall away with the empty side
    empty = spark.createDataFrame([], spec.schema).limit(0)
    keys, figures = list(spec.keys), list(spec.figures)
    if spec.kind == "standard":
        return act.apply_standard(empty, latest.latest_per_key(before, keys), spec, strategy="shuffle")
    if n == "5":
        return act.apply_marker(empty, latest.sum_per_stock_key(before, keys, figures, spec.day_col), spec, strategy="in_order")
    stamp = None if spec.kind == "cube" else act.MOVEMENT_STAMP
    return act.apply_cube(empty, latest.sum_per_key(before, keys, figures), spec, stamp=stamp, strategy="in_order")


def _as_extract(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed rows back to the extract layout: dates as 'yyyyMMdd' text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append(F.date_format(c, "yyyyMMdd").alias(f.name) if f.dataType.typeName() == "date" else c)
    return df.select(*out)


def _table_files(spark: SparkSession, sf_dir: str, name: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of a table's files: changed data gives new extracts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = [], fs.listFiles(path, True)
    while files.hasNext():
        st = files.next()
        found.append((st.getPath().getName(), st.getLen(), st.getModificationTime()))
    return sorted(found)


def ensure_extracts(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """Write the extract folders of one entity once; return its root."""
    # the folder name covers everything that defines the extracts, so a
    # changed spec or cut never reuses folders written by other code
    spec = SPECS[entity]
    code = b"".join(pathlib.Path(m.__file__).read_bytes() for m in (fx, sys.modules[__name__]))
    ident = repr((sf_dir, entity, spec, code, _table_files(spark, sf_dir, "events" if entity == "events" else "lineitem")))
    root = fixed_dir(spark, "extracts", hashlib.sha1(ident.encode()).hexdigest()[:16], entity)
    key = ("extracts", root)
    if key in _CACHE:
        return root
    fmt = spec.srcformat
    jvm = spark._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{root}/_DONE")
    fs = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(marker):
        cuts = [] if entity == "events" else [c.replace("-", "") for c in fx.BATCH_CUTS]
        day = _day_text(entity)
        _, after_day = split(spark, sf_dir, entity)
        bounds = [None, *cuts, None]
        for i in range(len(bounds) - 1):
            cond = F.lit(True)
            if bounds[i]:
                cond = cond & (day >= F.lit(bounds[i]))
            if bounds[i + 1]:
                cond = cond & (day < F.lit(bounds[i + 1]))
            after_day.where(cond).write.mode("overwrite").format(fmt).save(f"{root}/t1/b{i + 1}")
        _as_extract(initial_state(spark, sf_dir, entity, "2"), spec).write.mode("overwrite").format(fmt).save(
            f"{root}/t2")
        if spec.kind == "ncum":
            _as_extract(initial_state(spark, sf_dir, entity, "5"), spec).write.mode("overwrite").format(fmt).save(
                f"{root}/t5")
        out = fs.create(marker, True)
        out.close()
    _CACHE[key] = True
    return root
