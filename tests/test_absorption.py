"""Activation absorbs every inbound row exactly once, whatever arrives, crashes or is emptied."""

import dataclasses
import datetime

import pytest
from pyspark.sql import functions as F

from lodestar.plans import jobs
from lodestar.sources import files
from lodestar.spec import Check, EntitySpec

SPEC = EntitySpec(name="abs", kind="cube", ddl="k STRING, d DATE, q DECIMAL(17,3)", keys=("k", "d"), figures=("q",), partition_date="d")
STD = EntitySpec(name="std", kind="standard", ddl="recordmode STRING, k STRING, d DATE, q DECIMAL(17,3)", keys=("k",), partition_date="d")
DAY = datetime.date(2020, 1, 5)


def write(spark, root, folder, rows, spec=SPEC):
    head = "reqtsn STRING, datapakid STRING, record INT, "
    spark.createDataFrame(rows, head + spec.ddl).coalesce(1).write.parquet(f"{root}/t1/{folder}")


def row(req, pack, rec, k, q, day=DAY):
    return (req, pack, rec, k, day, q)


def dec(x):
    from decimal import Decimal

    return Decimal(x)


def totals(store, spec=SPEC):
    return {r["k"]: float(r["q"]) for r in store.read(jobs.tname(spec, "2")).collect()}


@pytest.fixture()
def root(spark):
    from lodestar.session import work_dir

    return work_dir(spark, "absorb")


def start(store, spec=SPEC):
    jobs.create(store, spec, "1")
    jobs.create(store, spec, "2")


def test_a_later_package_of_an_absorbed_request_is_absorbed(spark, store, root):
    start(store)
    write(spark, root, "a", [row("R1", "1", 1, "x", dec(1)), row("R1", "1", 2, "y", dec(2))])
    jobs.job_delta(store, SPEC, root)
    write(spark, root, "b", [row("R1", "2", 1, "x", dec(10)), row("R1", "1", 3, "z", dec(5))])
    jobs.job_delta(store, SPEC, root)
    assert totals(store) == {"x": 11.0, "y": 2.0, "z": 5.0}
    assert store.read(jobs.tname(SPEC, "1")).count() == 0


def test_records_delivered_again_count_once(spark, store, root):
    start(store)
    rows = [row("R1", "1", 1, "x", dec(1)), row("R1", "1", 2, "y", dec(2))]
    write(spark, root, "a", rows)
    write(spark, root, "b", rows[:1])  # twice in one load
    jobs.job_delta(store, SPEC, root)
    write(spark, root, "c", rows + [row("R2", "1", 1, "x", dec(4))])  # and again later
    jobs.job_delta(store, SPEC, root)
    assert totals(store) == {"x": 5.0, "y": 2.0}


def test_crash_between_ledger_and_commit_loses_nothing(spark, store, root, monkeypatch):
    start(store)
    write(spark, root, "a", [row("R1", "1", 1, "x", dec(1))])
    jobs.insert(store, SPEC, "1", root)
    real = store.replace_months
    monkeypatch.setattr(store, "replace_months", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        jobs.merge12(store, SPEC)
    monkeypatch.setattr(store, "replace_months", real)
    store.compact(jobs.tname(SPEC, "2"))  # another write takes the next snapshot number
    jobs.merge12(store, SPEC)
    assert totals(store) == {"x": 1.0}
    # a crash after the commit, before the inbound is cleared: nothing is counted twice
    write(spark, root, "b", [row("R2", "1", 1, "x", dec(2))])
    jobs.insert(store, SPEC, "1", root)
    clear = store.remove_folders
    monkeypatch.setattr(store, "remove_folders", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        jobs.merge12(store, SPEC)
    monkeypatch.setattr(store, "remove_folders", clear)
    store.compact(jobs.tname(SPEC, "2"))
    jobs.merge12(store, SPEC)
    assert totals(store) == {"x": 3.0} and store.read(jobs.tname(SPEC, "1")).count() == 0


@pytest.mark.parametrize("empty", [jobs.delete, jobs.create, jobs.dropcreate])
def test_an_emptied_target_has_absorbed_nothing(spark, store, root, empty):
    start(store)
    write(spark, root, "a", [row("R1", "1", 1, "x", dec(1))])
    jobs.job_delta(store, SPEC, root)
    empty(store, SPEC, "2")
    jobs.create(store, SPEC, "1")  # its files may be loaded again
    jobs.job_delta(store, SPEC, root)
    assert totals(store) == {"x": 1.0}


def test_rows_that_arrive_during_activation_stay(spark, store, root, monkeypatch):
    start(store)
    write(spark, root, "a", [row("R1", "1", 1, "x", dec(1))])
    jobs.insert(store, SPEC, "1", root)
    real = store.replace_months

    def late(*a, **k):
        write(spark, root, "b", [row("R2", "1", 1, "x", dec(7))])
        jobs.insert(store, SPEC, "1", root)
        return real(*a, **k)

    monkeypatch.setattr(store, "replace_months", late)
    jobs.merge12(store, SPEC)
    monkeypatch.setattr(store, "replace_months", real)
    assert totals(store) == {"x": 1.0} and store.read(jobs.tname(SPEC, "1")).count() == 1
    jobs.merge12(store, SPEC)
    assert totals(store) == {"x": 8.0}


@pytest.mark.parametrize("spec", [SPEC, STD])
def test_null_keys_raise_and_change_nothing(spark, store, root, spec):
    start(store, spec)
    rows = [("R1", "1", 1, *(("N",) if spec is STD else ()), None, DAY, dec(1))]
    write(spark, root, "a", rows, spec)
    with pytest.raises(ValueError, match="NULL in the key"):
        jobs.job_delta(store, spec, root)
    assert store.read(jobs.tname(spec, "2")).count() == 0 and store.read(jobs.tname(spec, "1")).count() == 1


def test_checked_load_is_rejected_with_its_report(spark, store, root):
    spec = dataclasses.replace(SPEC, safe_dml=True, ddl="k STRING NOT NULL, d DATE NOT NULL, q DECIMAL(17,3)",
                               checks=(Check("not_null"), Check("pk"), Check("initial", "k")))
    start(store, spec)
    write(spark, root, "a", [row("R1", "1", 1, "x", dec(1)), row("R1", "1", 1, chr(0), dec(1))])
    with pytest.raises(jobs.LoadRejected) as bad:
        jobs.insert(store, spec, "1", root)
    found = {r["check"]: r["cnt"] for r in bad.value.report.collect()}
    assert found == {"not_null:request": 0, "pk:request": 1, "not_null:k": 0, "not_null:d": 0, "initial:k": 1}
    assert store.read(jobs.tname(spec, "1")).count() == 0
    assert jobs.new_files(store, spec, "1", root).count() == 1  # still to be loaded
    with pytest.raises(ValueError, match="no STRING column"):
        jobs.insert(store, dataclasses.replace(spec, checks=(Check("initial", "d"),)), "1", root)


@pytest.mark.parametrize("n", ["1", "2", "5"])
def test_checked_stock_loads_with_a_day_first_in_the_key(spark, store, n):
    from conftest import SF_SMALL

    from lodestar.plans import extracts as ex
    from lodestar.plans import fixtures as fx

    root = ex.ensure_extracts(spark, SF_SMALL, "stock")
    spec = dataclasses.replace(fx.STOCK, safe_dml=True)
    jobs.create(store, spec, n)
    assert jobs.insert(store, spec, n, root) > 0
    assert store.read(jobs.tname(spec, n)).count() > 0


def test_file_lists_take_precedence(spark, store, root):
    start(store)
    for f, k in (("a", "x"), ("b", "y"), ("c", "z")):
        write(spark, root, f, [row("R" + f, "1", 1, k, dec(1))])
    every = sorted(r["file"] for r in files.source_files(spark, root, "1").collect())
    spec = dataclasses.replace(SPEC, files=tuple(every[1:2]), root=root)
    assert jobs.insert(store, spec, "1", paths=every[:1]) == 1  # the caller's list
    assert jobs.insert(store, spec, "1") == 1  # else the spec's
    assert jobs.insert(store, dataclasses.replace(spec, files=()), "1") == 1  # else the folder, without those loaded
    assert sorted(r["k"] for r in store.read(jobs.tname(SPEC, "1")).collect()) == ["x", "y", "z"]


def test_cube_delta_rewrites_its_own_months_only(spark, store, root):
    start(store)
    days = [datetime.date(2020, m, 3) for m in range(1, 7)]
    write(spark, root, "a", [row("R1", "1", i, "x", dec(1), d) for i, d in enumerate(days)])
    jobs.job_delta(store, SPEC, root)
    before = set(store.folders(jobs.tname(SPEC, "2")))
    write(spark, root, "b", [row("R2", "1", 1, "x", dec(1), days[2])])
    jobs.job_delta(store, SPEC, root)
    kept = before & set(store.folders(jobs.tname(SPEC, "2")))
    assert len(before) == 6 and len(kept) == 5


def test_conditional_delete_keeps_the_folders_of_other_months(spark, store):
    days = spark.range(48 * 28).select(F.expr("add_months(date'2018-01-01', cast(id / 28 as int)) + cast(id % 28 as int)").alias("d"), F.col("id").alias("v"))
    store.create("t", days.schema, "d")
    store.append("t", days)
    before = set(store.folders("t"))
    store.delete_where("t", "d = date'2019-05-07'")
    assert len(before) == 48 and len(before & set(store.folders("t"))) == 47
    assert store.read("t").count() == 48 * 28 - 1
    snapshots = store.snapshots("t")
    store.delete_where("t", "v < 0")
    assert store.snapshots("t") == snapshots  # no hit, nothing written


def test_snapshot_numbers_beyond_six_digits(spark, store):
    df = spark.range(3)
    store.create("t", df.schema)
    store._write_text(store._snap_file("t", 999_999), store._read_text(store._snap_file("t", 1)))
    store.append("t", df)
    store.append("t", df)
    assert store.snapshots("t")[-1] == 1_000_001 and store.read("t").count() == 6


def test_csv_columns_by_name(spark, root):
    spark.createDataFrame([("a", "2", "20")], "doc STRING, qty STRING, amt STRING").coalesce(1).write.csv(f"{root}/x", header=True)
    spark.createDataFrame([("200", "b", "3")], "amt STRING, doc STRING, qty STRING").coalesce(1).write.csv(f"{root}/y", header=True)
    got = files.read_source(spark, "csv", [f"{root}/x", f"{root}/y"])
    assert sorted((r["doc"], r["qty"], r["amt"]) for r in got.collect()) == [("a", "2", "20"), ("b", "3", "200")]
    spark.createDataFrame([("c", "1")], "doc STRING, amt STRING").coalesce(1).write.csv(f"{root}/z", header=True)
    with pytest.raises(ValueError, match=r"/z/.*lacks column\(s\) qty"):
        files.read_source(spark, "csv", [f"{root}/x", f"{root}/y", f"{root}/z"])


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_columns_added_between_extracts(spark, root, fmt):
    spark.createDataFrame([("a", 1)], "k STRING, v INT").write.format(fmt).save(f"{root}/x")
    spark.createDataFrame([(2, "new", "b")], "v INT, w STRING, k STRING").write.format(fmt).save(f"{root}/y")
    got = files.read_source(spark, fmt, [f"{root}/x", f"{root}/y"])
    assert sorted((r["k"], r["v"], r["w"] or "") for r in got.collect()) == [("a", 1, ""), ("b", 2, "new")]


def test_numbering_keeps_rows_without_a_group(spark):
    from lodestar.operators.sequence import sequence_within

    df = spark.range(30).select(F.expr("nullif(id % 3, 0)").alias("g"), F.col("id").alias("o"))
    got = {(r["g"], r["o"]): r["rn"] for r in sequence_within(df, ["g"], ["o"], "rn", 4).collect()}
    assert len(got) == 30 and all(rn == o // 3 + 1 for (_, o), rn in got.items())


def test_unnumbered_inbound_scans_the_columns_it_needs(spark):
    from conftest import SF_SMALL

    from lodestar.plans import catalog

    for name, columns in (("count_rows", 0), ("sum_per_key", 5)):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "FileScan parquet" in plan
        assert len(plan.split("ReadSchema: struct<")[1].split(">")[0].split(",")) <= max(columns, 1)
