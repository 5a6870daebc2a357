"""States as of many requests and stock by day against one activation or sum for each."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestar.operators import activate as act
from lodestar.operators import asof
from lodestar.plans import fixtures as fx
from lodestar.sources.publish import as_of_request
from lodestar.spec import EntitySpec

STD = EntitySpec(name="s", kind="standard", ddl="recordmode STRING, k STRING, n INT, q INT", keys=("k", "n"))
CUBE = EntitySpec(name="c", kind="cube", ddl="k STRING, note STRING, q DECIMAL(17,3), v DECIMAL(17,2)", keys=("k",), figures=("q", "v"))
HEAD = "reqtsn STRING, datapakid STRING, record INT, "
ASKED = ["R5", "R2", "R9", "R2", "R0"]


def same(found, one, base, inbound, spec, **kw):
    """Every request's rows equal those of an activation of its own."""
    cols = base.columns
    for r in sorted(set(ASKED)):
        got = sorted(map(repr, found.where(F.col("reqtsn") == r).select(*cols).collect()))
        assert got == sorted(map(repr, one(base, inbound, spec, r, **kw).select(*cols).collect())), r
    assert {r["reqtsn"] for r in found.select("reqtsn").collect()} <= set(ASKED)


def test_standard_states_with_deletes_and_returns(spark):
    rng = random.Random(4)
    base = spark.createDataFrame([("D" if i == 3 else None, f"k{i}", i, i) for i in range(12)], STD.ddl)
    rows = [(f"R{rng.randrange(1, 10)}", str(rng.randrange(3)), i, rng.choice(["N", "D", "", None]), f"k{rng.randrange(20)}", 0, i) for i in range(150)]
    rows = [(*r[:5], int(r[4][1:]), r[6]) for r in rows]
    inbound = spark.createDataFrame(rows, HEAD + STD.ddl)
    same(asof.as_of_requests(base, inbound, STD, ASKED), as_of_request, base, inbound, STD)


def test_cube_states_with_nulls(spark):
    rng = random.Random(5)
    number = lambda: rng.choice([None, Decimal(rng.randrange(-9, 9))])
    base = spark.createDataFrame([(f"k{i}", f"note {i}", number(), number()) for i in range(8)], CUBE.ddl)
    inbound = spark.createDataFrame([(f"R{rng.randrange(1, 10)}", "1", i, f"k{rng.randrange(14)}", "new", number(), number())
                                     for i in range(60)], HEAD + CUBE.ddl)
    same(asof.as_of_requests(base, inbound, CUBE, ASKED), as_of_request, base, inbound, CUBE)


def stock_rows(spark, seed, n, head):
    rng = random.Random(seed)
    number = lambda: rng.choice([None, Decimal(rng.randrange(0, 50))])
    rows = []
    for i in range(n):
        row = {"recordmode": None, "recordtp": "2", "calday": datetime.date(2024, 1, 1 + rng.randrange(20)), "base_uom": "EA",
               "loc_currcy": "EUR", "plant": f"p{rng.randrange(4)}", "material": f"m{rng.randrange(3)}", "stor_loc": "s", "valspecst": "v"}
        row |= {f: number() for f in fx.STOCK_FIGS}
        lead = (f"R{rng.randrange(1, 10)}", "1", i) if head else ()
        rows.append((*lead, *[row[f.name] for f in fx.STOCK.schema.fields]))
    return spark.createDataFrame(rows, spark.createDataFrame([], (HEAD if head else "") + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in fx.STOCK.schema.fields)).schema)


def tables(spark):
    nothing = spark.createDataFrame([], fx.STOCK.schema)
    old = stock_rows(spark, 1, 40, True)
    return (act.activate_movements(nothing, old, fx.STOCK).checkpoint(), act.activate_marker(nothing, old, fx.STOCK).checkpoint(),
            stock_rows(spark, 2, 70, True))


@pytest.mark.parametrize("n", ["2", "5"])
def test_stock_states(spark, n):
    movements, marker, inbound = tables(spark)
    base = movements if n == "2" else marker
    same(asof.as_of_requests(base, inbound, fx.STOCK, ASKED, n=n), as_of_request, base, inbound, fx.STOCK, n=n)


def test_rows_are_shuffled_once_for_all_requests(spark):
    base = spark.createDataFrame([(None, "a", 1, 1)], STD.ddl)
    inbound = spark.createDataFrame([("R1", "1", 1, "N", "a", 1, 5)], HEAD + STD.ddl)
    plan = asof.as_of_requests(base, inbound, STD, ["R1", "R2", "R3"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_stock_of_each_day_and_of_stated_days(spark):
    movements, marker, _ = tables(spark)
    plants = [r["plant"] for r in marker.select("plant").distinct().orderBy("plant").collect()]
    marker = marker.where(F.col("plant") != plants[0])  # these keys have no marker ...
    still = marker.limit(1).withColumn("material", F.lit("never moved"))  # ... and this one no movement
    marker = marker.unionByName(still).checkpoint()
    keys = fx.STOCK.key_spec(drop="calday")
    zero = lambda x: x or Decimal(0)
    balance, moves = {}, {}
    for r in marker.collect():
        balance[tuple(r[k] for k in keys)] = [zero(r[a]) - zero(r[b]) for a, b in fx.STOCK.stock_pairs]
    for r in movements.collect():
        moves.setdefault(tuple(r[k] for k in keys), []).append((r["calday"], [zero(r[a]) - zero(r[b]) for a, b in fx.STOCK.stock_pairs]))

    def stock(key, day):
        total = balance.get(key) or [sum(m[1][i] for m in moves[key]) for i in range(3)]
        return [total[i] - sum((m[1][i] for m in moves.get(key, []) if m[0] > day), Decimal(0)) for i in range(3)]

    names = [f"{a}_stock" for a, _ in fx.STOCK.stock_pairs]
    by_day = {(tuple(r[k] for k in keys), r["calday"]): [r[c] for c in names] for r in asof.stock_by_day(movements, marker, fx.STOCK).collect()}
    assert by_day == {(k, d): stock(k, d) for k, ms in moves.items() for d, _ in ms}
    days = [datetime.date(2023, 1, 1), datetime.date(2024, 1, 9), datetime.date(2025, 1, 1)]
    found = asof.stock_on_days(movements, marker, fx.STOCK, days + days[:1]).collect()
    assert len(found) == 3 * len(moves.keys() | balance.keys())
    assert {(tuple(r[k] for k in keys), r["calday"]): [r[c] for c in names] for r in found} == \
        {(k, d): stock(k, d) for k in moves.keys() | balance.keys() for d in days}


def test_empty_tables_and_lists(spark):
    base, inbound = spark.createDataFrame([], STD.ddl), spark.createDataFrame([], HEAD + STD.ddl)
    assert asof.as_of_requests(base, inbound, STD, ["R1"]).collect() == []
    with pytest.raises(ValueError, match="needs a request"):
        asof.as_of_requests(base, inbound, STD, [])
    nothing = spark.createDataFrame([], fx.STOCK.schema)
    assert asof.stock_by_day(nothing, nothing, fx.STOCK).collect() == []
    assert asof.stock_on_days(nothing, nothing, fx.STOCK, [datetime.date(2024, 1, 1)]).collect() == []
