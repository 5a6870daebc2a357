"""The README's usage example: CSV extracts through the standard jobs, then a rerun."""

from decimal import Decimal as D

from lodestar.plans import jobs
from lodestar.session import work_dir
from lodestar.sources.store import Store
from lodestar.spec import EntitySpec

SPEC = EntitySpec(
    name="orders", kind="standard", srcformat="csv",
    ddl="recordmode STRING, doc STRING NOT NULL, qty DECIMAL(17,3), amt DECIMAL(17,2)",
    mapping=(("doc", "ifnull(doc, chr(0))"), ("qty", "CAST(qty AS DECIMAL(17,3))"),
             ("amt", "CAST(amt AS DECIMAL(17,2))")),
    keys=("doc",),
)


def test_csv_extracts_standard_jobs_and_rerun(spark):
    root = work_dir(spark, "usage")
    spark.createDataFrame([("", "1", "10", "100.00"), ("", "2", "20", "5.50")],
                          "recordmode STRING, doc STRING, qty STRING, amt STRING") \
        .write.option("header", True).csv(f"{root}/extracts/t2")
    req = "20240102" + "0" * 15
    spark.createDataFrame([(req, "000001", "1", "N", "1", "11", "110.00"),
                           (req, "000001", "2", "D", "2", "20", "5.50"),
                           (req, "000001", "3", None, "3", "30", "7.25")],
                          "reqtsn STRING, datapakid STRING, record STRING, recordmode STRING, doc STRING, "
                          "qty STRING, amt STRING") \
        .write.option("header", True).csv(f"{root}/extracts/t1")
    store = Store(spark, f"{root}/warehouse")
    jobs.job_standard_init(store, SPEC, f"{root}/extracts")
    jobs.job_delta(store, SPEC, f"{root}/extracts")
    got = sorted((r["doc"], r["qty"], r["amt"]) for r in store.read(jobs.tname(SPEC, "2")).collect())
    assert got == [("1", D("11.000"), D("110.00")), ("3", D("30.000"), D("7.25"))]
    assert jobs.insert(store, SPEC, "1", f"{root}/extracts") == 0  # every file is in the ledger
    jobs.job_delta(store, SPEC, f"{root}/extracts")
    again = sorted((r["doc"], r["qty"], r["amt"]) for r in store.read(jobs.tname(SPEC, "2")).collect())
    assert again == got
