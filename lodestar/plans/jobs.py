"""End-to-end load jobs (JOB1-6) as plain function calls on a spec.

Table numbers: ``1`` inbound change log, ``2`` active, ``5`` stock marker,
``0`` master data, ``1h`` history of activated inbound rows.  Activation is
exactly-once without a transaction (Q6): what a target has absorbed is part of the
snapshot that holds its rows (``plans/absorption``), so both become visible in one
commit.  Rows of a request that arrive later are absorbed later.  Inbound folders are
cleared last, and only those read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import activate as act
from lodestar.operators import quarantine
from lodestar.operators.checks import load_checks, load_metrics
from lodestar.operators.dims import attribute_tables, load_master
from lodestar.operators.project import order_keys, project, sort_load
from lodestar.operators.sizing import fits_broadcast
from lodestar.plans import keymonths
from lodestar.plans.absorption import absorb, once, package_marks, pending
from lodestar.sources.files import file_list, read_source, source_files
from lodestar.sources.ledger import ledger_append, ledger_reset, unprocessed
from lodestar.sources.publish import publish_checked
from lodestar.sources.store import NULL_MONTH, Store, month_of
from lodestar.spec import EntitySpec


class LoadRejected(RuntimeError):
    """A checked load that failed its checks; ``report`` holds the rows (check, cnt)."""

    def __init__(self, table: str, report: DataFrame):
        self.table, self.report = table, report
        worst = [f"{r['check']}: {r['cnt']}" for r in report.where("cnt > 0").limit(20).collect()]
        super().__init__(f"load into {table} rejected ({'; '.join(worst)})")


def tname(spec: EntitySpec, n: str) -> str:
    return spec.table if n == "0" else f"{spec.table}{n}"


def table_schema(spec: EntitySpec, n: str) -> T.StructType:
    return spec.inbound_schema() if n == "1" else spec.schema


def target_buckets(spec: EntitySpec, n: str) -> dict | None:
    """Bucket layout of an activation target: its merge keys (the marker's
    without the day), so a shuffle merge moves only the delta."""
    if not spec.buckets or spec.partition_date or n not in ("2", "5") or not spec.keys:
        return None
    keys = spec.key_spec(drop=spec.day_col) if n == "5" else list(spec.keys)
    return {"n": spec.buckets, "keys": keys}


def create(store: Store, spec: EntitySpec, n: str) -> None:
    """SNK2 + SRC10: create or replace table n and forget its loaded files
    (its new manifest has absorbed nothing)."""
    store.create(tname(spec, n), table_schema(spec, n), None if n == "1" else spec.partition_date,
                 target_buckets(spec, n))
    ledger_reset(store, spec.name, n)


def drop(store: Store, spec: EntitySpec, n: str) -> None:
    """SNK3: drop with data; the file ledger of n is reset."""
    store.drop(tname(spec, n))
    ledger_reset(store, spec.name, n)


def delete(store: Store, spec: EntitySpec, n: str) -> None:
    """SNK4 as a job step: all rows of table n go.  A target forgets with them what it
    had absorbed (its manifest starts anew); loaded files stay in the ledger."""
    store.truncate(tname(spec, n))


def dropcreate(store: Store, spec: EntitySpec, n: str) -> None:
    """SNK3 as a job step."""
    drop(store, spec, n)
    create(store, spec, n)


def new_files(store: Store, spec: EntitySpec, n: str, root: str | None = None, paths: list[str] | None = None) -> DataFrame:
    """The files of a load: the caller's list, else the spec's, else the folder's; without
    those already loaded."""
    given = paths if paths is not None else list(spec.files) or None
    if given is None and not (root or spec.root):
        raise ValueError(f"entity {spec.name}: no file list and no root folder")
    files = file_list(store.spark, given) if given is not None else source_files(store.spark, root or spec.root, n)
    return files if spec.loadmanytimes else unprocessed(files, store, spec.name, n)


def insert(store: Store, spec: EntitySpec, n: str, root: str | None = None, checked: bool | None = None,
           paths: list[str] | None = None) -> int:
    """insert<n>: new extract files under root/t<n> -> projected -> table n.

    All new files are read in one scan; the ledger is appended only after the
    rows are published.  With ``spec.quarantine`` rows that do not fit the entity go to
    its reject table (after the others are published, before the ledger knows the files:
    a crash in between delivers both again).  With ``checked`` (by default the spec's ``safe_dml``) the
    load is audited first; a rejected one raises ``LoadRejected`` and leaves table
    and ledger as they were.  Returns the number of files loaded."""
    spark = store.spark
    # one list of file names serves the reader and the ledger
    names = [r["file"] for r in new_files(store, spec, n, root, paths).collect()]
    if not names:
        return 0
    name, bad = tname(spec, n), Observation()
    if spec.quarantine:
        source = read_source(spark, spec.srcformat, names, sep=spec.delimiter, with_file=True, corrupt=quarantine.CORRUPT)
        marked = quarantine.marked(source, spec, n)
        fit = F.col(quarantine.REASON) == ""
        rows = marked.observe(bad, F.count_if(~fit).alias("n")).where(fit).select(*table_schema(spec, n).names)
    else:
        rows = project(read_source(spark, spec.srcformat, names, sep=spec.delimiter), spec, n, order="")
    # a month table is sorted by its writer, in the shuffle that brings the months together
    order = order_keys(rows, spec.order) if spec.order and store.partition_date(name) else ()
    rows = rows if order else sort_load(rows, spec.order)
    if spec.safe_dml if checked is None else checked:
        existing = store.read(name)
        ok, report = publish_checked(store, name, rows, lambda d: load_checks(existing, d, spec, n),
                                     metrics=load_metrics(existing.schema, spec, n), order=order)
        if not ok:
            raise LoadRejected(name, report)
    else:
        store.append(name, rows, order=order)
    if spec.quarantine and bad.get["n"]:  # a clean load is one pass; only one with rejects takes a second
        if not store.exists(rejects_name(spec)):
            store.create(rejects_name(spec), T.StructType.fromDDL(quarantine.REJECT_DDL))
        store.append(rejects_name(spec), quarantine.rejected(marked, n))
    ledger_append(store, spec.name, n, file_list(spark, names), spec.loadmanytimes)
    return len(names)


def rejects_name(spec: EntitySpec) -> str:
    return f"{spec.table}_rejects"


def rejects(store: Store, spec: EntitySpec) -> DataFrame:
    """Rows (n, file, reason, raw) that quarantined loads of the entity turned away."""
    name = rejects_name(spec)
    return store.read(name) if store.exists(name) else store.spark.createDataFrame([], quarantine.REJECT_DDL)


def _check_keys(delta: DataFrame, keys: list[str], target: str) -> None:
    """Keys must not be NULL: a NULL key matches nothing and would be inserted again by every merge (Q4)."""
    missing = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    n = delta.agg(F.count_if(missing).alias("n")).collect()[0]["n"]
    if n:
        raise ValueError(f"activation into {target}: {n} change(s) with a NULL in the key ({', '.join(keys)})")


def touched_months(store: Store, target: str, delta: DataFrame, keys: list[str], date_col: str) -> tuple[list[str], list[dict] | None]:
    """Months whose rows an activation can change, and the target's next index of keys to months.

    With the day in the key these are the months of the delta rows, and no index is needed;
    else also the months of the active rows whose key the delta hits (``plans/keymonths``).
    At most one value per calendar month reaches the driver."""
    if date_col not in keys:
        return keymonths.candidates(store, target, delta, keys, date_col)
    m = F.coalesce(month_of(date_col), F.lit(NULL_MONTH)).alias("m")
    return sorted(r["m"] for r in delta.select(m).distinct().collect()), None


def _activate_into(
    store: Store,
    target: str,
    delta: DataFrame,
    keys: list[str],
    bcast_cols: list[str],
    apply: Callable[[DataFrame, str], DataFrame],
    marks: DataFrame,
    order: str | None = None,
) -> None:
    """Merge a reduced delta into ``target`` and publish a new snapshot.

    A month-partitioned target whose day column the delta carries is read and
    rewritten only for the touched months; every other month keeps its files.
    ``marks`` are the packages it absorbs: they enter the same snapshot (Q6).  Rewritten
    months keep the load ``order``."""
    _check_keys(delta, keys, target)
    small = fits_broadcast(delta.select(*bcast_cols))
    strategy = "broadcast" if small else "shuffle"
    part = store.partition_date(target)
    if part and part in delta.columns:
        months, index = touched_months(store, target, delta, keys, part)
        new_rows = apply(store.read(target, months=months), strategy)
        # after a broadcast merge the rows still sit in their month folders'
        # tasks: no clustering shuffle is needed; after a shuffle merge it is
        store.replace_months(target, new_rows, months, cluster=not small, absorbed=absorb(store, target, marks), index=index,
                             order=order_keys(new_rows, order) if order else ())
    else:
        new_rows = apply(store.read(target), strategy)
        store.replace(target, new_rows, keep_meta=True, absorbed=absorb(store, target, marks))


def _archive(store: Store, spec: EntitySpec, inbound: DataFrame) -> None:
    """Append the inbound rows to the history table ``1h``, each identity once."""
    name = tname(spec, "1h")
    if not store.exists(name):
        store.create(name, spec.inbound_schema())
    rows = pending(store, inbound, name)
    marks = package_marks(rows)
    if not marks.isEmpty():
        store.append(name, once(rows, marks), absorbed=absorb(store, name, marks))


def history(store: Store, spec: EntitySpec) -> DataFrame:
    """Inbound rows activated so far (kept if the spec asks for a history)."""
    return store.read(tname(spec, "1h"))


def merge12(store: Store, spec: EntitySpec, mode: str = "upsert", order: str = "numeric",
            null_policy: str = "zero", keep_snapshots: int | None = None) -> None:
    """Activate table 1 into 2 (and 5 for stock), then clear table 1.

    ``keep_snapshots`` expires older snapshots of the targets afterwards and
    deletes the data folders they alone referenced (by default all snapshots
    stay readable for state-as-of reads)."""
    spec.require_keys()
    if spec.kind not in ("standard", "cube", "ncum"):
        return  # any other kind has nothing to activate
    keys = list(spec.keys)
    # The inbound snapshot's files are immutable, so re-reading it is
    # deterministic: only the reduced delta is checkpointed.
    read = store.folders(tname(spec, "1"))
    if not read:
        return  # nothing has arrived
    inbound = store.read(tname(spec, "1"))
    t2, t5 = tname(spec, "2"), tname(spec, "5")
    new2 = pending(store, inbound, t2)
    marks2 = package_marks(new2)
    deltas: dict[str, DataFrame] = {}
    if marks2.isEmpty():
        pass  # nothing new for table 2 (e.g. a rerun): no snapshot is written
    elif spec.kind == "standard":
        latest = act.reduce_standard(new2, spec, order)
        _activate_into(store, t2, latest, keys, keys,
                       lambda a, s: act.apply_standard(a, latest, spec, mode, s), marks2, spec.order)
    else:
        stamp = act.MOVEMENT_STAMP if spec.kind == "ncum" else None
        rows = once(new2, marks2)
        # both stock tables mostly take the same rows: then one shuffle serves both
        shared = spec.kind == "ncum" and new2 is inbound and pending(store, inbound, t5) is inbound
        deltas = act.reduce_stock(rows, spec) if shared else {"2": act.reduce_cube(rows, spec)}
        _activate_into(store, t2, deltas["2"], keys, deltas["2"].columns,
                       lambda a, s: act.apply_cube(a, deltas["2"], spec, null_policy, stamp, s), marks2, spec.order)
    if spec.kind == "ncum":
        if "5" in deltas:
            marks5 = marks2
        else:
            new5 = pending(store, inbound, t5)
            marks5 = package_marks(new5)
            if not marks5.isEmpty():
                deltas["5"] = act.reduce_marker(once(new5, marks5), spec)
        if "5" in deltas:
            _activate_into(store, t5, deltas["5"], spec.key_spec(drop=spec.day_col), deltas["5"].columns,
                           lambda a, s: act.apply_marker(a, deltas["5"], spec, null_policy, s), marks5)
    if spec.archive:
        _archive(store, spec, inbound)
    store.remove_folders(tname(spec, "1"), read)  # every row of these is absorbed; later ones stay
    if keep_snapshots is not None:
        for n in ("1", "2", "5") if spec.kind == "ncum" else ("1", "2"):
            store.expire(tname(spec, n), keep=keep_snapshots)


# --------------------------------------------------------------------------- #
# JOB1-6
# --------------------------------------------------------------------------- #
def job_init(store: Store, spec: EntitySpec, root: str, tables: tuple[str, ...]) -> None:
    """Initial load: create the tables, then load the extract folders."""
    for n in tables:
        create(store, spec, n)
    for n in tables:
        insert(store, spec, n, root)


def job_cube_init(store: Store, spec: EntitySpec, root: str) -> DataFrame:
    """JOB1: t1 -> inbound, t2 -> active."""
    job_init(store, spec, root, ("1", "2"))
    return store.read(tname(spec, "2"))


def job_delta(store: Store, spec: EntitySpec, root: str, activate: bool = True, **kw) -> DataFrame:
    """JOB2/JOB4/JOB5 delta: new t1 files -> inbound -> activation."""
    insert(store, spec, "1", root)
    if activate:
        merge12(store, spec, **kw)
    return store.read(tname(spec, "2"))


def job_standard_init(store: Store, spec: EntitySpec, root: str) -> DataFrame:
    """JOB3: t2 -> active (inbound created empty)."""
    create(store, spec, "1")
    job_init(store, spec, root, ("2",))
    return store.read(tname(spec, "2"))


def job_stock_init(store: Store, spec: EntitySpec, root: str) -> None:
    create(store, spec, "1")
    job_init(store, spec, root, ("2", "5"))


def job_master(store: Store, spec: EntitySpec, staged: DataFrame | None = None, root: str | None = None,
               paths: list[str] | None = None) -> dict[str, DataFrame]:
    """JOB6: reload the master-data snapshot, then replace every attribute table.

    The rows come from ``staged`` or, as for ``insert``, from the files of a list or a
    folder, which then enter the ledger.  All attribute tables come from one scan of
    the staging rows: the distinct (attribute, code, text) rows of every attribute are
    computed together and checkpointed, and each table is a filter of that small
    result.  With ``safe_dml`` the new snapshot is audited before it replaces the old."""
    name, names = tname(spec, "0"), []
    if staged is None:
        names = [r["file"] for r in new_files(store, spec, "0", root, paths).collect()]
        if not names:
            raise ValueError(f"entity {spec.name}: no new files to reload from")
        staged = read_source(store.spark, spec.srcformat, names, sep=spec.delimiter)
    rows = load_master(staged, spec)
    if spec.safe_dml:
        if not store.exists(name):
            store.create(name, rows.schema)
        nothing = store.spark.createDataFrame([], rows.schema)
        ok, report = publish_checked(store, name, rows, lambda d: load_checks(nothing, d, spec, "0"), "replace",
                                     load_metrics(rows.schema, spec, "0"))
        if not ok:
            raise LoadRejected(name, report)
    else:
        store.replace(name, rows)
    out = {"0": store.read(name)}
    for attr, df in attribute_tables(staged, spec).items():
        store.replace(f"dwh_t_{attr}", df)
        out[attr] = store.read(f"dwh_t_{attr}")
    if names:
        ledger_append(store, spec.name, "0", file_list(store.spark, names), spec.loadmanytimes)
    return out
