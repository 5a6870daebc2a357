"""Steps that every load shares: rows are kept as columns, an empty side costs nothing, each side moves once."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import activate as act
from lodestar.operators import checks, sizing
from lodestar.operators.latest import latest_per_key
from lodestar.operators.sequence import sequence_within
from lodestar.plans import extracts as ex
from lodestar.plans import fixtures as fx
from lodestar.spec import EntitySpec

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


SPEC = EntitySpec(name="k", kind="standard", keys=("k",), ddl="recordmode STRING, k STRING, v INT")
INBOUND = "reqtsn STRING, datapakid STRING, record INT, recordmode STRING, k STRING, v INT"


def test_materialized_rows_are_read_by_column(spark):
    held = sizing.materialize(spark.range(50).select("id", F.col("id").cast("string").alias("text")))
    plan = _plan(held.select("id"))
    assert "Scan parquet" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert held.count() == 50


def test_materialize_keeps_types_that_parquet_lacks(spark):
    held = sizing.materialize(spark.range(3).select("id", F.lit(None).alias("nothing")))
    assert isinstance(held.schema["nothing"].dataType, T.NullType) and held.count() == 3


def test_numbering_tells_a_null_group_from_an_empty_one(spark):
    df = spark.createDataFrame([(g, i) for i, g in enumerate([None, "", "a", None, "", None])], "g STRING, o INT")
    assert _rows(sequence_within(df, ["g"], ["o"], "n", 3)) == sorted(
        [(None, 0, 1), (None, 3, 2), (None, 5, 3), ("", 1, 1), ("", 4, 2), ("a", 2, 1)], key=repr)


def test_an_empty_table_falls_out_of_joins(spark, store):
    store.create("nothing", T.StructType.fromDDL("k STRING, v INT"))
    other = spark.createDataFrame([("a", 1)], "k STRING, w INT")
    plan = _plan(store.read("nothing").join(other, "k", "left_anti"))
    assert "Join" not in plan and "Exchange" not in plan


def test_initial_state_needs_one_shuffle(spark):
    for entity, n in (("doc", "2"), ("cube", "2"), ("stock", "2"), ("stock", "5")):
        plan = _plan(ex._initial_state(spark, SF_SMALL, entity, n))
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan.replace("BroadcastHashJoin", ""), (entity, n)


def test_a_cut_by_day_reaches_the_scan_of_the_numbered_rows(spark):
    before, _ = ex.split(spark, SF_SMALL, "doc")
    assert "LessThan(reqtsn," + fx.CUT.replace("-", "") in _plan(before)
    day = F.col("pstng_date")
    st = ex.staging(spark, SF_SMALL, "doc")
    cut = fx.CUT.replace("-", "")
    assert before.count() == st.where(day < cut).count() > 0


def test_latest_holds_the_identity_once(spark):
    rows = [("r1", "p", 9, None, "a", 1), ("r1", "p", 10, None, "a", 2), ("r0", "p", 99, None, "a", 3),
            (None, "p", 1, None, "b", 4), ("r1", "p", None, "D", None, 5), ("r1", "p", 1, None, None, 6)]
    df = spark.createDataFrame(rows, INBOUND)
    got = latest_per_key(df, ["k"])
    assert _rows(got) == _rows(spark.createDataFrame([rows[1], rows[3], rows[5]], INBOUND))
    assert _plan(got).count("reqtsn, ") and "max_by" not in _plan(got)
    # quirk Q1 as before: record is compared as text, so 9 comes after 10
    assert [r["v"] for r in latest_per_key(df.where("k = 'a'"), ["k"], "text").collect()] == [1]


def test_latest_of_rows_with_a_map(spark):
    df = spark.createDataFrame([("r1", "p", 1, "a"), ("r2", "p", 1, "a")], "reqtsn STRING, datapakid STRING, record INT, k STRING")
    got = latest_per_key(df.withColumn("m", F.create_map(F.lit("x"), F.col("reqtsn"))), ["k"]).collect()
    assert [r["m"] for r in got] == [{"x": "r2"}]


def test_strict_activation_moves_each_side_once(spark):
    active = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (None, "b", 3), (None, "c", 4), (None, "c", 5), (None, None, 6)], SPEC.ddl)
    latest = spark.createDataFrame([("D", "a", 10), (None, "b", 20), ("D", "d", 30), ("N", "e", 40), ("D", None, 50)], SPEC.ddl)
    want = _rows(act.apply_standard(active, latest, SPEC, "strict", "broadcast"))
    got = act.apply_standard(active, latest, SPEC, "strict", "shuffle")
    assert _rows(got) == want
    assert (None, "d", 30) in want and (None, None, 6) in want and (None, None, 50) in want and (None, "b", 3) in want
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        assert _plan(act.apply_standard(active, latest, SPEC, "strict", "shuffle")).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset(limit)


def test_a_merge_is_sorted_by_the_key_that_tells_most(spark):
    spec = EntitySpec(name="c", kind="cube", keys=("unit", "day", "k"), figures=("v",), ddl="unit STRING, day INT, k STRING, v INT")
    delta = sizing.materialize(spark.range(200).select(
        F.lit("PC").alias("unit"), (F.col("id") % 4).cast("int").alias("day"), F.col("id").cast("string").alias("k"), F.lit(1).alias("v")))
    assert act.telling_first(delta, list(spec.keys)) == ["k", "day", "unit"]
    active = delta.where("day < 2").unionByName(delta.where("k = '1'"))
    got = act.apply_cube(active, delta, spec, strategy="shuffle")
    assert got.columns == ["unit", "day", "k", "v"]
    assert _rows(got) == _rows(act.apply_cube(active, delta, spec, strategy="broadcast"))


def test_unique_keys_of_a_first_load_are_counted_without_keeping_them(spark, monkeypatch):
    kept = []
    materialize = sizing.materialize
    monkeypatch.setattr(sizing, "materialize", lambda df: kept.append(materialize(df)) or kept[-1])
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k STRING, v INT")
    none = rows.where("v > 9")
    assert checks.check_pk_incoming(none, rows, ["k"]).collect()[0]["cnt"] == 2
    assert [df.count() for df in kept] == [1]  # one row: the count
    assert checks.check_pk_incoming(rows.where("k = 'b'"), rows, ["k"]).collect()[0]["cnt"] == 3
    assert checks.check_pk_incoming(none, rows.where("k = 'b'"), ["k"]).collect()[0]["cnt"] == 0
