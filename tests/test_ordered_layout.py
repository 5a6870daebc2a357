"""Month tables keep the load order inside their files (SRT1), so filters skip files and row groups."""

import dataclasses
import datetime
import glob

import pyarrow.parquet as pq
import pytest

from lodestar.plans import jobs
from lodestar.session import work_dir
from lodestar.spec import Check, EntitySpec

SPEC = EntitySpec(name="ord", kind="standard", ddl="recordmode STRING, k INT, d DATE, q INT", keys=("k",),
                  partition_date="d", order="q desc, k", srcformat="parquet")
ROWS = [(None, i, datetime.date(2024, 1 + i % 2, 3), (i * 37) % 500) for i in range(1000)]


@pytest.fixture()
def wide(spark):
    """Small shuffles keep their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def files(store, name):
    """The data files of the current snapshot by month."""
    return {e["month"]: sorted(glob.glob(f"{store.table_path(name)}/{e['path']}/*.parquet".removeprefix("file:"))) for e in store._manifest(name)["folders"]}


def check_order(found, least_files):
    for paths in found.values():
        assert len(paths) >= least_files
        ranges = []
        for path in paths:
            table = pq.read_table(path, columns=["q", "k"]).to_pylist()
            assert table == sorted(table, key=lambda r: (-r["q"], r["k"]))
            meta = pq.ParquetFile(path).metadata
            at = meta.schema.names.index("q")
            ranges += [(s.min, s.max) for s in (meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups))]
        # a filter on one value of the order meets few row groups: two where a value is cut
        assert all(sum(lo <= v <= hi for lo, hi in ranges) <= 2 for v in range(500))


@pytest.mark.parametrize("checked", [False, True])
def test_loads_and_merges_keep_the_order_in_month_files(wide, store, checked):
    spec = dataclasses.replace(SPEC, safe_dml=checked, checks=(Check("not_null", "q"),) if checked else ())
    root = work_dir(wide, "ordered")
    wide.createDataFrame(ROWS, SPEC.ddl).repartition(5).write.parquet(f"{root}/t2/a")
    for n in ("1", "2"):
        jobs.create(store, spec, n)
    jobs.insert(store, spec, "2", root)
    t2 = jobs.tname(spec, "2")
    check_order(files(store, t2), 3)
    assert sorted(map(tuple, store.read(t2).collect()), key=lambda r: r[1]) == ROWS
    store.append(jobs.tname(spec, "1"), wide.createDataFrame(
        [("R1", "1", i, "N", i, datetime.date(2024, 1, 9), 250 + i) for i in range(0, 40, 2)],
        "reqtsn STRING, datapakid STRING, record INT, " + SPEC.ddl))
    jobs.merge12(store, spec)
    check_order({m: f for m, f in files(store, t2).items() if m == "202401"}, 3)
    assert store.read(t2).count() == 1000


def test_a_load_is_shuffled_once(wide, store, monkeypatch):
    root = work_dir(wide, "ordered")
    wide.createDataFrame(ROWS, SPEC.ddl).write.parquet(f"{root}/t2/a")
    jobs.create(store, SPEC, "2")
    written = []
    real = store._write_data
    monkeypatch.setattr(store, "_write_data", lambda name, df, *a, **k: written.append((df, k["order"])) or real(name, df, *a, **k))
    jobs.insert(store, SPEC, "2", root)
    df, order = written[0]
    assert order and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
