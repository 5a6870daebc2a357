"""The memory of absorbed rows: bitmaps by package, read by bucket, in few folders."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import activate as act
from lodestar.plans import absorption, jobs
from lodestar.plans import fixtures as fx
from lodestar.spec import EntitySpec

SPEC = EntitySpec(name="bits", kind="cube", ddl="k STRING, q DECIMAL(17,3)", keys=("k",), figures=("q",))
HEAD = "reqtsn STRING, datapakid STRING, record INT, k STRING, q DECIMAL(17,3)"
TARGET = "dwh_t_bits2"


def load(store, requests, records, package="1"):
    """Append records of requests to the inbound table."""
    rows = (store.spark.createDataFrame([(r,) for r in requests], "reqtsn STRING")
            .crossJoin(store.spark.createDataFrame([(x,) for x in records], "record INT"))
            .select("reqtsn", F.lit(package).alias("datapakid"), "record", F.lit("x").alias("k"), F.lit(1).alias("q")))
    store.append("dwh_t_bits1", rows)


@pytest.fixture()
def target(store):
    jobs.create(store, SPEC, "1")
    jobs.create(store, SPEC, "2")
    return store


def marks(store):
    entries = store.absorbed(TARGET)
    return store.read_absorbed(TARGET, entries, absorption.SCHEMA) if entries else None


def total(store):
    return int(store.read(TARGET).agg(F.sum("q")).collect()[0][0])


def test_memory_grows_with_packages_not_records(target):
    load(target, ["R1", "R2"], range(1, 5001))
    jobs.merge12(target, SPEC)
    assert total(target) == 10_000 and marks(target).count() == 2


def test_record_numbers_of_every_kind(target):
    odd = [0, -1, -7, -32768, -40000, 1, 2, 8, 9, 32767, 32768, 32769, 65536, 65537, 2**31 - 1, -(2**31)]
    load(target, ["R1"], odd)
    jobs.merge12(target, SPEC)
    load(target, ["R1"], odd + [3, -2, 32770])
    jobs.merge12(target, SPEC)
    assert total(target) == len(odd) + 3


def test_a_merge_reads_only_the_buckets_of_arriving_requests(target, monkeypatch):
    requests = [f"R{i}" for i in range(40)]
    load(target, requests, [1])
    jobs.merge12(target, SPEC)
    read = []
    real = target.read_absorbed
    monkeypatch.setattr(target, "read_absorbed", lambda n, entries, schema: read.append(entries) or real(n, entries, schema))
    load(target, ["R7"], [1, 2])
    jobs.merge12(target, SPEC)
    every = {e["bucket"] for e in target.absorbed(TARGET)}
    assert len(every) > 10 and read and all(len({e["bucket"] for e in some}) == 1 for some in read)
    assert total(target) == 41


def test_folders_of_a_bucket_stay_few_and_packages_join(target):
    for i in range(absorption.FOLDERS + 4):
        load(target, ["R1"], [i, i + 1])  # each record but the ends is delivered twice
        jobs.merge12(target, SPEC)
    assert total(target) == absorption.FOLDERS + 5
    assert len(target.absorbed(TARGET)) <= absorption.FOLDERS
    rows = marks(target).groupBy("slot").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")).collect()
    assert sum(r["n"] for r in rows) == absorption.FOLDERS + 5


def test_rows_without_identity_are_never_remembered(target):
    df = target.spark.createDataFrame([("R1", None, 1, "x", 1), ("R1", "1", None, "x", 1), (None, "1", 1, "x", 1)],
                                      "reqtsn STRING, datapakid STRING, record INT, k STRING, q INT")
    for times in (1, 2):
        target.append("dwh_t_bits1", df)
        jobs.merge12(target, SPEC)
        assert total(target) == 3 * times
    assert not target.absorbed(TARGET)


def test_only_packages_with_doubles_are_shuffled(spark):
    rows = spark.createDataFrame([("A", "1", i, "x", 1) for i in range(50)] + [("B", "1", i // 2, "x", 1) for i in range(50)],
                                 "reqtsn STRING, datapakid STRING, record INT, k STRING, q INT")
    kept = absorption.once(rows, absorption.package_marks(rows))
    assert kept.count() == 75
    single = rows.where("reqtsn = 'A'")
    assert absorption.once(single, absorption.package_marks(single)) is single


def test_stock_deltas_come_from_one_shuffle(spark):
    spec = fx.STOCK
    head = ", ".join(["reqtsn STRING", "datapakid STRING", "record INT", spec.ddl.replace(" NOT NULL", "")])
    schema = spark.createDataFrame([], head).schema
    cols = []
    for f in schema.fields:
        if f.name == spec.day_col:
            c = F.expr("nullif(date_add(DATE'2024-01-01', cast(id % 5 as int)), DATE'2024-01-02')")
        elif f.name in spec.figures:
            c = F.expr("nullif(id % 7, 3)")
        elif f.name in spec.keys:
            c = F.expr("cast(id % 3 as string)")
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    rows = spark.range(200).select(*cols)
    both = act.reduce_stock(rows, spec)
    for n, alone in (("2", act.reduce_cube(rows, spec)), ("5", act.reduce_marker(rows, spec))):
        assert both[n].schema.simpleString() == alone.schema.simpleString()
        assert sorted(map(str, both[n].collect())) == sorted(map(str, alone.collect()))


def test_grouping_sets_plan_has_one_exchange(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(act, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    spec = fx.STOCK
    rows = spark.createDataFrame([], ", ".join(["reqtsn STRING", "datapakid STRING", "record INT", spec.ddl.replace(" NOT NULL", "")]))
    act.reduce_stock(rows, spec)
    assert len(plans) == 1 and plans[0].count("Exchange") == 1
