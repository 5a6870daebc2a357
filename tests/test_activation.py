"""Hand-made cases for every activation branch (standard, cube, stock)."""

from decimal import Decimal as D

import pytest

from lodestar.operators.activate import (activate_cube, activate_marker, activate_movements,
                                         activate_standard, stock_balance)
from lodestar.spec import EntitySpec

STD = EntitySpec(name="t", kind="standard", ddl="recordmode STRING, k STRING NOT NULL, v STRING, n DECIMAL(17,2)",
                 keys=("k",))
IN_DDL = "reqtsn STRING, datapakid STRING, record INT, recordmode STRING, k STRING, v STRING, n DECIMAL(17,2)"


def req(day: int) -> str:
    return f"2024010{day}" + "0" * 15


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture()
def active(spark):
    return spark.createDataFrame(
        [(None, "a", "old-a", D("1.00")), (None, "b", "old-b", D("2.00")), (None, "c", "old-c", D("3.00")),
         (None, "d", "old-d", D("4.00"))], STD.ddl)


@pytest.fixture()
def inbound(spark):
    data = [
        (req(1), "000001", 1, "N", "a", "new-a", D("10.00")),   # matched, after-image 'N'
        (req(1), "000001", 2, "D", "b", "old-b", D("2.00")),    # matched delete
        (req(1), "000001", 3, "", "c", "new-c", D("30.00")),    # matched, after-image ''
        (req(1), "000001", 4, None, "x", "new-x", D("5.00")),   # unmatched NULL mode
        (req(1), "000001", 5, "D", "y", "gone-y", D("6.00")),   # unmatched delete
        (req(2), "000001", 1, "D", "c", "new-c", D("30.00")),   # later: delete c again
        (req(2), "000001", 2, "N", "c", "newer-c", D("31.00")),  # ...then re-insert c (latest)
    ]
    return spark.createDataFrame(data, IN_DDL)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_standard_upsert(active, inbound, strategy):
    out = activate_standard(active, inbound, STD, strategy=strategy)
    assert rows(out, "k", "v", "n", "recordmode") == [
        ("a", "new-a", D("10.00"), None), ("c", "newer-c", D("31.00"), None),
        ("d", "old-d", D("4.00"), None), ("x", "new-x", D("5.00"), None)]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_standard_strict(active, inbound, strategy):
    out = activate_standard(active, inbound, STD, mode="strict", strategy=strategy)
    # matched after-images keep the target (Q2); unmatched 'D' is inserted (Q3)
    assert rows(out, "k", "v") == [("a", "old-a"), ("c", "old-c"), ("d", "old-d"), ("x", "new-x"),
                                   ("y", "gone-y")]


def test_standard_empty_sides(spark, active, inbound):
    empty_in = spark.createDataFrame([], IN_DDL)
    assert rows(activate_standard(active, empty_in, STD), "k") == [("a",), ("b",), ("c",), ("d",)]
    empty_t = spark.createDataFrame([], STD.ddl)
    assert rows(activate_standard(empty_t, inbound, STD), "k") == [("a",), ("c",), ("x",)]


def test_record_text_order(spark):
    """Record 10 beats 9 numerically; as text '9' > '10' (Q1)."""
    data = [(req(1), "000001", 9, None, "k", "nine", D("9")), (req(1), "000001", 10, None, "k", "ten", D("10"))]
    inb = spark.createDataFrame(data, IN_DDL)
    empty = spark.createDataFrame([], STD.ddl)
    assert rows(activate_standard(empty, inb, STD), "v") == [("ten",)]
    assert rows(activate_standard(empty, inb, STD, order="text"), "v") == [("nine",)]


def test_null_key_never_matches(spark):
    act_ = spark.createDataFrame([(None, None, "t", D("1"))], STD.ddl.replace(" NOT NULL", ""))
    inb = spark.createDataFrame([(req(1), "000001", 1, "D", None, "s", D("1"))], IN_DDL)
    out = activate_standard(act_, inb, STD, mode="strict")
    assert rows(out, "v") == [("s",), ("t",)]


CUBE = EntitySpec(name="c", kind="cube", ddl="k STRING NOT NULL, q DECIMAL(17,3), v DECIMAL(17,2)",
                  keys=("k",), figures=("q", "v"))
CIN = "reqtsn STRING, datapakid STRING, record INT, k STRING, q DECIMAL(17,3), v DECIMAL(17,2)"


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_cube_null_policy(spark, strategy):
    act_ = spark.createDataFrame([("a", D("1.000"), None), ("b", D("2.000"), D("2.00"))], CUBE.ddl)
    inb = spark.createDataFrame([
        (req(1), "000001", 1, "a", D("1.000"), D("5.00")),
        (req(1), "000001", 2, "a", D("1.000"), None),
        (req(1), "000001", 3, "c", None, None)], CIN)
    zero = activate_cube(act_, inb, CUBE, strategy=strategy)
    assert rows(zero, "k", "q", "v") == [("a", D("3.000"), D("5.00")), ("b", D("2.000"), D("2.00")),
                                         ("c", None, None)]
    strict = activate_cube(act_, inb, CUBE, null_policy="strict", strategy=strategy)
    assert rows(strict, "k", "q", "v") == [("a", D("3.000"), None), ("b", D("2.000"), D("2.00")),
                                           ("c", None, None)]


def test_cube_overflow_raises(spark):
    act_ = spark.createDataFrame([("a", D("99999999999999.999"), None)], CUBE.ddl)
    inb = spark.createDataFrame([(req(1), "000001", 1, "a", D("1.000"), None)], CIN)
    with pytest.raises(Exception):
        activate_cube(act_, inb, CUBE).collect()


STOCK = EntitySpec(
    name="s", kind="ncum",
    ddl=("recordmode STRING, recordtp STRING, calday DATE NOT NULL, m STRING NOT NULL, "
         "rec DECIMAL(17,3), iss DECIMAL(17,3)"),
    keys=("calday", "m"), figures=("rec", "iss"), stock_pairs=(("rec", "iss"),))
SIN = "reqtsn STRING, datapakid STRING, record INT, recordmode STRING, recordtp STRING, calday DATE, m STRING, " \
      "rec DECIMAL(17,3), iss DECIMAL(17,3)"


def test_marker_and_movements(spark):
    import datetime as dt

    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    marker = spark.createDataFrame([(None, "1", d1, "p", D("10.000"), D("4.000"))], STOCK.ddl)
    moves = spark.createDataFrame([(None, "2", d1, "p", D("10.000"), D("4.000"))], STOCK.ddl)
    inb = spark.createDataFrame([
        (req(2), "000001", 1, None, None, d2, "p", D("5.000"), None),
        (req(2), "000001", 2, None, None, d3, "p", None, D("2.000")),
        (req(2), "000001", 3, None, None, d3, "q", D("7.000"), None)], SIN)
    m = activate_marker(marker, inb, STOCK)
    # p matched: rec = 10 + (5 - 2), issues and day unchanged; q inserted raw, recordtp '1'
    assert rows(m, "m", "calday", "rec", "iss", "recordtp") == [
        ("p", d1, D("13.000"), D("4.000"), "1"), ("q", d3, D("7.000"), None, "1")]
    bal = stock_balance(m, STOCK)
    assert rows(bal, "m", "rec_bal") == [("p", D("9.000")), ("q", D("7.000"))]
    mv = activate_movements(moves, inb, STOCK)
    assert rows(mv, "m", "calday", "rec", "iss", "recordtp") == [
        ("p", d1, D("10.000"), D("4.000"), "2"), ("p", d2, D("5.000"), None, "2"),
        ("p", d3, None, D("2.000"), "2"), ("q", d3, D("7.000"), None, "2")]


def test_insert_only_entity_cannot_activate(spark):
    spec = EntitySpec(name="ins", kind="insert", ddl="a STRING")
    with pytest.raises(ValueError):
        activate_cube(spark.createDataFrame([], "a STRING"), spark.createDataFrame([], "a STRING"), spec)


def test_broadcast_plan_keeps_active_unshuffled(spark, active, inbound):
    out = activate_standard(active.repartition(4), inbound, STD, strategy="broadcast")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    out2 = activate_standard(active, inbound, STD, strategy="shuffle")
    assert rows(out2, "k") == rows(out, "k")


def test_kind_dispatch(spark, active, inbound):
    import dataclasses
    import datetime as dt

    from lodestar.operators.activate import activate

    out = activate(STD, active, inbound)
    assert set(out) == {"2"} and rows(out["2"], "k") == rows(activate_standard(active, inbound, STD), "k")
    d1 = dt.date(2024, 1, 1)
    marker = spark.createDataFrame([(None, "1", d1, "p", D("10.000"), D("4.000"))], STOCK.ddl)
    inb = spark.createDataFrame([(req(2), "000001", 1, None, None, d1, "p", D("5.000"), None)], SIN)
    both = activate(STOCK, marker, inb, marker=marker)
    assert set(both) == {"2", "5"}
    assert rows(both["5"], "m", "rec") == [("p", D("15.000"))]
    assert activate(dataclasses.replace(STD, kind="master"), active, inbound) == {}
