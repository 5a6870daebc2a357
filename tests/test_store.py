"""Manifest snapshots and month-incremental activation of partitioned targets."""

import json

import pytest
from pyspark.sql import functions as F

from lodestar.operators.activate import activate_standard
from lodestar.plans import extracts as ex
from lodestar.plans import fixtures as fx
from lodestar.plans import jobs
from lodestar.sources.store import Store
from lodestar.spec import EntitySpec

from conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def _folders(store: Store, name: str) -> dict[str, set[str]]:
    man = json.loads(store._read_text(store._snap_file(name, store.snapshots(name)[-1])))
    out: dict[str, set[str]] = {}
    for e in man["folders"]:
        out.setdefault(e["month"], set()).add(e["path"])
    return out


def test_replace_months_keeps_other_folders(spark, store):
    o = spark.createDataFrame(
        [(1, "2024-01-05"), (2, "2024-01-20"), (3, "2024-02-03"), (4, "2024-03-09")], "id INT, d STRING"
    ).select("id", F.to_date("d").alias("d"))
    store.create("t", o.schema, partition_date="d")
    store.append("t", o)
    before = _folders(store, "t")
    assert set(before) == {"202401", "202402", "202403"}
    # February is emptied, January rewritten, March untouched
    jan = o.where("id = 1")
    store.replace_months("t", jan, ["202401", "202402"])
    after = _folders(store, "t")
    assert set(after) == {"202401", "202403"}
    assert after["202403"] == before["202403"]
    assert after["202401"] != before["202401"]
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 4]
    assert store.read("t", months=["202403"]).count() == 1


def test_failed_write_is_never_read(spark, store):
    o = spark.createDataFrame([(1,)], "id INT")
    store.create("t", o.schema)
    store.append("t", o)
    n = len(store.snapshots("t"))
    bad = spark.range(3).select(F.expr("IF(id < 2, CAST(id AS INT), CAST(raise_error('boom') AS INT))").alias("id"))
    try:
        store.append("t", bad)
    except Exception:
        pass
    assert len(store.snapshots("t")) == n
    assert store.read("t").count() == 1


def test_standard_delta_job_equals_full_activation(spark, store):
    root = ex.ensure_extracts(spark, SF_SMALL, "doc")
    jobs.job_standard_init(store, fx.DOC, root)
    name = jobs.tname(fx.DOC, "2")
    jobs.job_delta(store, fx.DOC, root)
    full = activate_standard(ex.initial_state(spark, SF_SMALL, "doc"), ex.inbound(spark, SF_SMALL, "doc", "after"),
                             fx.DOC)
    assert _sorted(store.read(name)) == _sorted(full)


PSPEC = EntitySpec(name="p", kind="standard", ddl="recordmode STRING, k STRING NOT NULL, d DATE, v INT",
                   keys=("k",), partition_date="d")


def test_standard_merge_rewrites_only_touched_months(spark, store):
    jobs.create(store, PSPEC, "1")
    jobs.create(store, PSPEC, "2")
    t1, t2 = jobs.tname(PSPEC, "1"), jobs.tname(PSPEC, "2")
    active = spark.createDataFrame(
        [(None, "a", "2024-01-03", 1), (None, "b", "2024-02-03", 2), (None, "c", "2024-03-03", 3),
         (None, "e", "2024-04-03", 5)], "recordmode STRING, k STRING, d STRING, v INT"
    ).withColumn("d", F.to_date("d"))
    store.append(t2, active)
    req = "20240501" + "0" * 15
    inbound = spark.createDataFrame(
        [(req, "000001", 1, "N", "b", "2024-05-02", 20),   # b moves from February to May
         (req, "000001", 2, "D", "c", "2024-03-03", 3),    # c deleted: March becomes empty
         (req, "000001", 3, None, "x", "2024-05-09", 9)],  # new key in May
        "reqtsn STRING, datapakid STRING, record INT, recordmode STRING, k STRING, d STRING, v INT"
    ).withColumn("d", F.to_date("d"))
    store.append(t1, inbound)
    before = _folders(store, t2)
    jobs.merge12(store, PSPEC)
    after = _folders(store, t2)
    assert set(after) == {"202401", "202404", "202405"}
    assert after["202401"] == before["202401"] and after["202404"] == before["202404"]
    got = sorted((r["k"], str(r["d"]), r["v"]) for r in store.read(t2).collect())
    assert got == [("a", "2024-01-03", 1), ("b", "2024-05-02", 20), ("e", "2024-04-03", 5), ("x", "2024-05-09", 9)]
    assert store.read(t1).count() == 0


def test_stock_marker_and_movements_incremental(spark, store):
    root = ex.ensure_extracts(spark, SF_SMALL, "stock")
    jobs.job_stock_init(store, fx.STOCK, root)
    t2 = jobs.tname(fx.STOCK, "2")
    before = _folders(store, t2)
    jobs.job_delta(store, fx.STOCK, root)
    after = _folders(store, t2)
    assert any(before[m] == after.get(m) for m in before)
    want = ex.initial_state(spark, SF_SMALL, "stock", "2")
    from lodestar.operators.activate import activate_movements

    want = activate_movements(want, ex.inbound(spark, SF_SMALL, "stock", "after"), fx.STOCK)
    assert _sorted(store.read(t2)) == _sorted(want)


def test_checked_publish_commits_staged_files_and_discards_rejects(spark, store):
    from lodestar.operators.checks import check_pk_incoming
    from lodestar.sources.publish import publish_checked

    o = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, s STRING")
    store.create("t", o.schema)
    checks = lambda d: [check_pk_incoming(store.read("t"), d, ["id"])]
    ok, _ = publish_checked(store, "t", o, checks)
    assert ok
    data_dirs = store._subdirs(f"{store.table_path('t')}/data")
    assert len(data_dirs) == 1 and _folders(store, "t")[None] == {f"data/{data_dirs[0]}"}
    ok2, report = publish_checked(store, "t", spark.createDataFrame([(2, "dup"), (3, "c")], o.schema), checks)
    assert not ok2 and report.collect()[0]["cnt"] == 1
    assert store._subdirs(f"{store.table_path('t')}/data") == data_dirs  # rejected files are gone
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 2]


def test_checked_insert_checks_by_table_number(spark, store):
    from lodestar.session import work_dir
    from lodestar.sources import ledger

    root = ex.ensure_extracts(spark, SF_SMALL, "doc")
    for n in ("1", "2"):
        jobs.create(store, fx.DOC, n)
    # the change log holds several changes per key: unique on the request identity only
    assert jobs.insert(store, fx.DOC, "1", root, checked=True) > 0
    assert store.read(jobs.tname(fx.DOC, "1")).count() == ex.inbound(spark, SF_SMALL, "doc", "after").count()
    assert jobs.insert(store, fx.DOC, "2", root, checked=True) > 0
    n2 = store.read(jobs.tname(fx.DOC, "2")).count()
    # the same active rows again from another folder: duplicate keys, rejected
    dup = work_dir(spark, "dup")
    spark.read.orc(f"{root}/t2").write.orc(f"{dup}/t2")
    with pytest.raises(jobs.LoadRejected):
        jobs.insert(store, fx.DOC, "2", dup, checked=True)
    assert store.read(jobs.tname(fx.DOC, "2")).count() == n2
    assert ledger.ledger(store).where(F.col("file").contains(dup)).count() == 0


def test_expire_keeps_live_folders_only(spark, store):
    o = spark.createDataFrame(
        [(1, "2024-01-05"), (2, "2024-02-03"), (3, "2024-03-09")], "id INT, d STRING"
    ).select("id", F.to_date("d").alias("d"))
    store.create("t", o.schema, partition_date="d")
    store.append("t", o)
    store.replace_months("t", o.where("id = 2").withColumn("id", F.lit(20)), ["202402"])
    want = sorted(r["id"] for r in store.read("t").collect())
    assert store.expire("t", keep=1, grace_seconds=3600) == []  # everything is younger than the grace
    gone = store.expire("t", keep=1, grace_seconds=-1)
    assert len(gone) == 1 and gone[0].endswith("calmonth_p=202402")
    assert store.snapshots("t") == [3]
    assert sorted(r["id"] for r in store.read("t").collect()) == want == [1, 3, 20]


def test_compact_merges_appends(spark, store):
    o = spark.createDataFrame([(i, f"2024-0{1 + i % 3}-05") for i in range(9)], "id INT, d STRING") \
        .select("id", F.to_date("d").alias("d"))
    store.create("t", o.schema, partition_date="d")
    for i in range(3):
        store.append("t", o.where(f"id % 3 = {i}"))
    assert all(len(v) == 1 for v in _folders(store, "t").values())  # each month written by one append
    store.append("t", o.where("id = 0"))
    assert len(_folders(store, "t")["202401"]) == 2
    store.compact("t", months=["202401"])
    assert len(_folders(store, "t")["202401"]) == 1
    assert sorted(r["id"] for r in store.read("t").collect()) == sorted([*range(9), 0])


def test_null_day_rows_are_a_month_of_their_own(spark, store):
    jobs.create(store, PSPEC, "1")
    jobs.create(store, PSPEC, "2")
    t1, t2 = jobs.tname(PSPEC, "1"), jobs.tname(PSPEC, "2")
    store.append(t2, spark.createDataFrame(
        [(None, "a", None, 1), (None, "b", "2024-02-03", 2), (None, "n", None, 7)],
        "recordmode STRING, k STRING, d STRING, v INT").withColumn("d", F.to_date("d")))
    assert "__HIVE_DEFAULT_PARTITION__" in _folders(store, t2)
    req = "20240501" + "0" * 15
    store.append(t1, spark.createDataFrame(
        [(req, "000001", 1, "N", "a", "2024-05-02", 10),   # a leaves the NULL-day month
         (req, "000001", 2, "N", "b", None, 20)],          # b moves into it
        "reqtsn STRING, datapakid STRING, record INT, recordmode STRING, k STRING, d STRING, v INT",
    ).withColumn("d", F.to_date("d")))
    jobs.merge12(store, PSPEC)
    got = sorted((r["k"], None if r["d"] is None else str(r["d"]), r["v"]) for r in store.read(t2).collect())
    assert got == [("a", "2024-05-02", 10), ("b", None, 20), ("n", None, 7)]
    assert "202402" not in _folders(store, t2)


def test_jobs_take_the_shuffle_path_over_the_broadcast_limit(spark, store):
    from lodestar.operators.sizing import LIMIT_KEY

    root = ex.ensure_extracts(spark, SF_SMALL, "stock")
    spark.conf.set(LIMIT_KEY, "0")  # nothing fits: every merge is a shuffle join
    try:
        jobs.job_stock_init(store, fx.STOCK, root)
        jobs.job_delta(store, fx.STOCK, root)
        got2 = _sorted(store.read(jobs.tname(fx.STOCK, "2")))
        got5 = _sorted(store.read(jobs.tname(fx.STOCK, "5")))
    finally:
        spark.conf.unset(LIMIT_KEY)
    from lodestar.operators.activate import activate_marker, activate_movements

    after = ex.inbound(spark, SF_SMALL, "stock", "after")
    want2 = activate_movements(ex.initial_state(spark, SF_SMALL, "stock", "2"), after, fx.STOCK)
    want5 = activate_marker(ex.initial_state(spark, SF_SMALL, "stock", "5"), after, fx.STOCK)
    assert got2 == _sorted(want2) and got5 == _sorted(want5)


def test_bucketed_target_merges_without_shuffling_active(spark, store):
    import dataclasses

    from lodestar.operators.activate import activate_cube, apply_cube, reduce_cube
    from lodestar.operators.sizing import LIMIT_KEY

    spec = dataclasses.replace(fx.CUBE, buckets=8, partition_date=None)
    root = ex.ensure_extracts(spark, SF_SMALL, "cube")
    jobs.create(store, spec, "1")
    jobs.create(store, spec, "2")
    jobs.insert(store, spec, "2", root)
    t2 = jobs.tname(spec, "2")
    assert store.buckets(t2) == {"n": 8, "keys": ["calday", "material", "vendor"]}
    active = store.read(t2)
    delta = reduce_cube(ex.inbound(spark, SF_SMALL, "cube", "after"), spec)
    plan = apply_cube(active, delta, spec, strategy="shuffle")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the delta side only
    spark.conf.set(LIMIT_KEY, "0")
    try:
        jobs.insert(store, spec, "1", root)
        jobs.merge12(store, spec)
    finally:
        spark.conf.unset(LIMIT_KEY)
    assert store.buckets(t2)["n"] == 8
    want = activate_cube(ex.initial_state(spark, SF_SMALL, "cube"), ex.inbound(spark, SF_SMALL, "cube", "after"),
                         fx.CUBE)
    assert _sorted(store.read(t2)) == _sorted(want)


def test_bucketed_catalog_entries_go_with_their_folders(spark, store):
    o = spark.createDataFrame([(str(i), i) for i in range(20)], "k STRING, v INT")
    store.create("b", o.schema, buckets={"n": 4, "keys": ["k"]})
    store.append("b", o)
    assert store.read("b").count() == 20
    ref = store._bucket_ref(f"{store.table_path('b')}/{next(iter(_folders(store, 'b')[None]))}")
    assert spark.catalog.tableExists(ref)
    store.drop("b")
    assert not spark.catalog.tableExists(ref)


def test_bucketed_standard_target_shuffles_only_the_delta(spark, store):
    from lodestar.operators.activate import apply_standard, reduce_standard

    root = ex.ensure_extracts(spark, SF_SMALL, "events")
    jobs.job_standard_init(store, fx.EVENTS, root)
    active = store.read(jobs.tname(fx.EVENTS, "2"))
    latest = reduce_standard(ex.inbound(spark, SF_SMALL, "events", "after"), fx.EVENTS)
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")  # Spark would broadcast these few keys on its own
    try:
        out = apply_standard(active, latest, fx.EVENTS, strategy="shuffle")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_publish_without_checks_passes(spark, store):
    from lodestar.sources.publish import publish_checked

    o = spark.createDataFrame([(1,)], "id INT")
    store.create("t", o.schema)
    ok, report = publish_checked(store, "t", o, lambda d: [])
    assert ok and report.count() == 0 and store.read("t").count() == 1
