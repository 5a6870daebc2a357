"""Rows that do not fit an entity are turned away with their reasons; all others are loaded."""

import dataclasses
import json

import pytest

from lodestar.operators import quarantine
from lodestar.plans import jobs
from lodestar.session import work_dir
from lodestar.spec import Check, EntitySpec

SPEC = EntitySpec(
    name="quar", kind="standard", srcformat="csv", quarantine=True, keys=("doc",),
    ddl="recordmode STRING, doc STRING NOT NULL, day DATE, qty DECIMAL(5,2)",
    mapping=(("doc", "nullif(doc, '')"), ("day", "to_date(nullif(day, '00000000'), 'yyyyMMdd')"), ("qty", "CAST(qty AS DECIMAL(5,2))")))
HEAD = "reqtsn,datapakid,record,recordmode,doc,day,qty"


def deliver(spark, root, folder, lines, head=HEAD):
    spark.createDataFrame([(0, head)] + [(i + 1, x) for i, x in enumerate(lines)], "i int, value string") \
        .coalesce(1).sortWithinPartitions("i").select("value").write.text(f"{root}/t1/{folder}")


@pytest.fixture()
def root(spark):
    return work_dir(spark, "quarantine-test")


def start(store, spec=SPEC):
    jobs.create(store, spec, "1")
    jobs.create(store, spec, "2")


LINES = ["R1,1,1,N,a,20200105,1.50", "R1,1,2,N,b,20201399,2", "R1,1,3,N,c,00000000,3", "R1,1,4,N,d,20200101,n/a",
         "R1,1,x,N,e,20200101,4", "R1,1,6,N,,20200101,5", "R1,1,7,N,g,20200101,99999.99", "R1,1,8,N,h,,",
         "R1,1,9", "R1,1,10,N,j,20200101,6,extra"]


def test_bad_rows_go_to_the_reject_table_and_the_rest_is_activated(spark, store, root):
    start(store)
    deliver(spark, root, "a", LINES)
    assert jobs.insert(store, SPEC, "1", root) == 1
    jobs.merge12(store, SPEC)
    assert {r["doc"]: (str(r["day"]), r["qty"] and float(r["qty"])) for r in store.read(jobs.tname(SPEC, "2")).collect()} == {
        "a": ("2020-01-05", 1.5), "c": ("None", 3.0), "h": ("None", None)}
    got = {}
    for r in jobs.rejects(store, SPEC).collect():
        assert r["n"] == "1" and "/t1/a/" in r["file"]
        got[json.loads(r["raw"])["record"] if r["raw"].startswith("{") else r["raw"]] = r["reason"]
    assert got == {"2": "day: bad value", "4": "qty: bad value", "x": "record: bad value", "6": "doc: null", "7": "qty: bad value",
                   "R1,1,9": "malformed line", "R1,1,10,N,j,20200101,6,extra": "malformed line"}
    assert jobs.insert(store, SPEC, "1", root) == 0  # the file is done: its rejects are not delivered again
    assert spark.conf.get(quarantine.ANSI) == "true"


def test_without_quarantine_one_bad_value_ends_the_load(spark, store, root):
    spec = dataclasses.replace(SPEC, quarantine=False)
    start(store, spec)
    deliver(spark, root, "a", LINES[:2])
    with pytest.raises(Exception, match="20201399|CANNOT_PARSE|DATETIME"):
        jobs.insert(store, spec, "1", root)
    assert store.read(jobs.tname(spec, "1")).count() == 0


def test_a_clean_load_makes_no_reject_table(spark, store, root):
    start(store)
    deliver(spark, root, "a", LINES[:1])
    jobs.insert(store, SPEC, "1", root)
    assert not store.exists(jobs.rejects_name(SPEC)) and jobs.rejects(store, SPEC).count() == 0


def test_checks_see_only_the_rows_that_fit(spark, store, root):
    spec = dataclasses.replace(SPEC, safe_dml=True, checks=(Check("not_null"), Check("initial", "doc"), Check("pk")))
    start(store, spec)
    deliver(spark, root, "a", LINES)
    assert jobs.insert(store, spec, "1", root) == 1
    assert store.read(jobs.tname(spec, "1")).count() == 3 and jobs.rejects(store, spec).count() == 7
    deliver(spark, root, "b", [LINES[0], "R2,1,1,N,z,bad,1"])  # a record of a loaded request again
    with pytest.raises(jobs.LoadRejected):
        jobs.insert(store, spec, "1", root)
    assert jobs.rejects(store, spec).count() == 7  # a load that is rejected as a whole leaves nothing


def test_typed_sources_and_the_load_filter(spark):
    spec = EntitySpec(name="q2", kind="insert", ddl="k INT, d DATE", mapping=(("d", "to_date(raw_day, 'yyyyMMdd')"),), where="k > 1")
    src = spark.createDataFrame([(1, "bad"), (2, "bad"), (3, "20200101"), (4, None), (5, "  ")], "k INT, raw_day STRING")
    got = {r["k"]: r["_reason"] for r in quarantine.marked(src, spec).collect()}
    assert got == {2: "d: bad value", 3: "", 4: "", 5: ""}


def test_observed_checks_read_the_staged_files_once(spark, store, root, monkeypatch):
    """Five declared checks and a unique key: after the key counts are taken nothing reads the files."""
    from lodestar.operators import sizing

    spec = dataclasses.replace(SPEC, quarantine=False, safe_dml=True, ddl="recordmode STRING, doc STRING NOT NULL, day DATE NOT NULL, qty DECIMAL(5,2) NOT NULL",
                               checks=(Check("not_null", "doc"), Check("not_null", "day"), Check("not_null", "qty"), Check("initial", "doc"), Check("pk")))
    start(store, spec)
    deliver(spark, root, "a", [LINES[0], "R1,1,1,N,b,20200101,", "R1,1,3,N,c,,1"])
    staged, real = {}, store.stage
    taken, materialize = [], sizing.materialize

    def stage(*a, **k):
        staged["entries"], rows = real(*a, **k)
        return staged["entries"], rows

    def first_only(df):
        out = materialize(df)
        if not taken and staged:
            taken.append(out)
            store.discard(jobs.tname(spec, "1"), staged["entries"])  # whoever reads them from now on fails
        return out

    monkeypatch.setattr(store, "stage", stage)
    monkeypatch.setattr(sizing, "materialize", first_only)
    with pytest.raises(jobs.LoadRejected) as bad:
        jobs.insert(store, spec, "1", root)
    assert taken and {r["check"]: r["cnt"] for r in bad.value.report.collect()} == {
        "not_null:request": 0, "not_null:doc": 0, "not_null:day": 1, "not_null:qty": 1, "initial:doc": 0, "pk:request": 1}
