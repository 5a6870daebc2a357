"""Plan shape: exchanges per activation side, pushdown and pruning into the scan."""

from pyspark.sql import functions as F

from lodestar.operators.activate import activate_cube, activate_standard
from lodestar.plans import extracts as ex
from lodestar.plans import fixtures as fx

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(spark, store, entity: str, name: str):
    """The pre-cut state of an entity as a store table (a parquet scan)."""
    spec = ex.SPECS[entity]
    store.replace(name, ex.initial_state(spark, SF_SMALL, entity), spec.partition_date)
    return store.read(name)


def test_shuffle_activation_exchanges_each_side_once(spark, store):
    active = _stored(spark, store, "cube", "cube2")
    out = activate_cube(active, ex.inbound(spark, SF_SMALL, "cube", "after"), fx.CUBE, strategy="shuffle")
    plan = _plan(out)
    assert "FullOuter" in plan
    # the active scan and the checkpointed delta are each hash-partitioned once on the key
    assert plan.count("Exchange hashpartitioning") == 2


def test_broadcast_activation_never_shuffles_active(spark, store):
    active = _stored(spark, store, "doc", "doc2")
    out = activate_standard(active, ex.inbound(spark, SF_SMALL, "doc", "after"), fx.DOC, strategy="broadcast")
    plan = _plan(out)
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan


def test_filters_and_columns_reach_the_parquet_scan(spark, store):
    active = _stored(spark, store, "doc", "doc2")
    q = active.where(F.col("value_lc") > 50000).select("doc_num", "value_lc")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(value_lc), GreaterThan(value_lc,50000" in plan
    assert "ReadSchema: struct<doc_num:string,value_lc:decimal(17,2)>" in plan


def test_month_read_opens_only_that_month(spark, store):
    active = _stored(spark, store, "doc", "doc2")
    months = store.months("doc2")
    one = store.read("doc2", months=[months[0]])
    files = one.inputFiles()
    assert files and all(f"calmonth_p={months[0]}" in f for f in files)
    assert one.count() == active.where(F.date_format("pstng_date", "yyyyMM") == months[0]).count()
