"""The index of keys to months: a delta opens the months it can change and no others."""

import datetime

import pytest

from lodestar.plans import jobs, keymonths
from lodestar.sources.store import Store
from lodestar.spec import EntitySpec

SPEC = EntitySpec(name="km", kind="standard", ddl="recordmode STRING, k STRING, n INT, d DATE, q INT",
                  keys=("k", "n"), partition_date="d")
T2 = jobs.tname(SPEC, "2")
ROW = "recordmode STRING, k STRING, n INT, d DATE, q INT"


class Watched(Store):
    """A store that notes the data files of every read it hands out."""

    opened: list

    def read(self, name, snapshot=None, months=None):
        df = super().read(name, snapshot, months)
        if name == T2 and months is not None:
            self.opened.append((tuple(months), len(df.inputFiles())))
        return df

    def read_unindexed(self, name):
        df = super().read_unindexed(name)
        self.opened.append(("keys", len(df.inputFiles())))
        return df


def day(month, d=3):
    return None if month is None else datetime.date(2024, month, d)


@pytest.fixture()
def store(spark):
    from lodestar.session import work_dir

    made = Watched(spark, work_dir(spark, "keymonths"))
    made.opened = []
    for n in ("1", "2"):
        jobs.create(made, SPEC, n)
    rows = [(None, f"k{i}", i, day(1 + i % 6), i) for i in range(60)] + [(None, "none", 0, None, 7)]
    made.append(T2, spark.createDataFrame(rows, ROW).coalesce(1))
    return made


def load(store, request, rows):
    """Activate changes (recordmode, k, n, d, q) and return the rows of the active table."""
    store.append(jobs.tname(SPEC, "1"), store.spark.createDataFrame(
        [(request, "1", i, *r) for i, r in enumerate(rows)], "reqtsn STRING, datapakid STRING, record INT, " + ROW))
    store.opened.clear()
    jobs.merge12(store, SPEC)
    return {(r["k"], r["n"]): (r["d"], r["q"]) for r in store.read(T2).collect()}


def test_only_candidate_months_are_opened(store):
    before = load(store, "R1", [("N", "k0", 0, day(1), 100)])
    assert before["k0", 0] == (day(1), 100) and len(before) == 61
    assert store.opened[0][0] == "keys"  # what was loaded is scanned once, by the first merge
    assert store.unindexed(T2) == []
    folders = {e["month"]: e["path"] for e in store._manifest(T2)["folders"]}
    after = load(store, "R2", [("N", "k1", 1, day(2), 200), ("N", "new", 1, day(2), 1)])
    assert store.opened == [(("202402",), 1)]
    assert after == before | {("k1", 1): (day(2), 200), ("new", 1): (day(2), 1)}
    now = {e["month"]: e["path"] for e in store._manifest(T2)["folders"]}
    assert {m for m in now if now[m] != folders[m]} == {"202402"}


def test_a_key_is_found_in_the_month_it_lies_in(store):
    load(store, "R1", [("N", "k0", 0, day(1), 100)])
    moved = load(store, "R2", [("N", "k1", 1, day(5), 200)])  # from February to May
    assert store.opened[-1][0] == ("202402", "202405") and moved["k1", 1] == (day(5), 200) and len(moved) == 61
    gone = load(store, "R3", [("D", "k1", 1, day(9), 0), ("N", "none", 0, day(3), 8)])  # from no month to March
    assert ("k1", 1) not in gone and gone["none", 0] == (day(3), 8) and len(gone) == 60
    assert "__HIVE_DEFAULT_PARTITION__" in store.opened[-1][0]


def test_rows_that_come_past_the_index_are_found(store):
    load(store, "R1", [("N", "k0", 0, day(1), 100)])
    store.append(T2, store.spark.createDataFrame([(None, "late", 1, day(4), 5)], ROW))
    store.delete_where(T2, "k = 'k2'")  # replaces a month
    got = load(store, "R2", [("N", "late", 1, day(6), 6), ("N", "k8", 8, day(3), 80)])
    assert got["late", 1] == (day(6), 6) and got["k8", 8] == (day(3), 80) and ("k2", 2) not in got and len(got) == 61
    assert store.opened[0] == ("keys", 2)
    assert store.unindexed(T2) == []


def test_a_lost_commit_leaves_the_index_as_it_was(store, monkeypatch):
    load(store, "R1", [("N", "k0", 0, day(1), 100)])
    entries = store.index(T2)
    real = store._commit
    monkeypatch.setattr(store, "_commit", lambda name, *a, **k: (_ for _ in ()).throw(RuntimeError("lost")) if name == T2 else real(name, *a, **k))
    with pytest.raises(RuntimeError, match="lost"):
        load(store, "R2", [("N", "k1", 1, day(5), 200)])
    monkeypatch.setattr(store, "_commit", real)
    assert store.index(T2) == entries
    jobs.merge12(store, SPEC)
    assert {(r["k"], r["d"], r["q"]) for r in store.read(T2).where("k = 'k1'").collect()} == {("k1", day(5), 200)}


def test_full_buckets_are_written_as_one_and_emptied_tables_start_anew(store, monkeypatch):
    monkeypatch.setattr(keymonths, "FOLDERS", 2)
    for i in range(4):
        got = load(store, f"R{i}", [("N", "k0", 0, day(1 + i), i)])
    assert got["k0", 0] == (day(4), 3) and len(got) == 61
    per_bucket = [e["bucket"] for e in store.index(T2)]
    assert max(map(per_bucket.count, per_bucket)) <= 2
    held = store.read_side(T2, store.index(T2), keymonths.SCHEMA)
    assert held.count() == held.distinct().count() == 61 + 3  # each key's months, once
    jobs.delete(store, SPEC, "2")
    assert store.index(T2) == []
