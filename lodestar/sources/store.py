"""Path tables with manifest snapshots (SNK1-5, SNK3 drop, PUB2 state reads).

A table is a folder ``<root>/<name>/``:

* ``data/<write-id>/`` holds the files of one write, never touched again;
  tables partitioned by month write one ``calmonth_p=<yyyyMM>`` sub-folder per
  month (a derived folder column, dropped from results).
* ``_snapshots/v<seq>.json`` is a snapshot: the schema, the partition date and
  the list of data folders (with their month) that make up the table.

Every create / replace / append / truncate writes its rows to a fresh data
folder first and then commits a new manifest by renaming it into place, so a
failed or half-written job is never read and the previous snapshot stays
current.  A replace never overwrites what it reads.  ``replace_months`` swaps
only the folders of the given months, so activating a delta that touches a
few months rewrites those months and reuses every other folder as it is.
Older snapshots stay readable (state as of an earlier load) until they are
expired.  Only folder names travel through the driver, never rows.

One writer per table at a time (load jobs run one after another per entity).
A second committer is detected where rename refuses an existing target (HDFS);
on object stores, whose rename is a copy, the single-writer rule must hold.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_COL = "calmonth_p"
NULL_MONTH = "__HIVE_DEFAULT_PARTITION__"  # folder name Spark gives a NULL partition value
_SNAP = re.compile(r"^v(\d{6,})\.json$")


def month_of(c) -> F.Column:
    """Partition value of a DATE column: 'yyyyMM'."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMM")


class Store:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # ------------------------------------------------------------------ fs
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def _write_text(self, path: str, text: str) -> None:
        fs, p = self._fs(path)
        out = fs.create(p, False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()

    def _read_text(self, path: str) -> str:
        jvm = self.spark._jvm
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _subdirs(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())

    # ------------------------------------------------------------------ meta
    def table_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _snap_file(self, name: str, seq: int) -> str:
        return f"{self.table_path(name)}/_snapshots/v{seq:06d}.json"

    def snapshots(self, name: str) -> list[int]:
        fs, p = self._fs(f"{self.table_path(name)}/_snapshots")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            m = _SNAP.match(st.getPath().getName())
            if m:
                out.append(int(m.group(1)))
        return sorted(out)

    def _manifest(self, name: str, snapshot: int | None = None) -> dict:
        snaps = self.snapshots(name)
        if not snaps:
            raise FileNotFoundError(f"table {name} has no committed snapshot under {self.root}")
        seq = snapshot if snapshot is not None else snaps[-1]
        return json.loads(self._read_text(self._snap_file(name, seq)))

    def exists(self, name: str) -> bool:
        return bool(self.snapshots(name))

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._manifest(name)["schema"]))

    def partition_date(self, name: str) -> str | None:
        return self._manifest(name).get("partition_date")

    def months(self, name: str) -> list[str]:
        """Months present in the current snapshot (from the manifest)."""
        return sorted({e["month"] for e in self._manifest(name)["folders"] if e["month"] is not None})

    def next_snapshot(self, name: str) -> int:
        return max(self.snapshots(name) or [0]) + 1

    def buckets(self, name: str) -> dict | None:
        """Bucket layout of the table: {"n": buckets, "keys": [...]}, or None."""
        return self._manifest(name).get("buckets")

    def absorbed(self, name: str, buckets: list[str] | None = None) -> list[dict]:
        """Folders of what the rows of the current snapshot have absorbed (see ``plans/absorption``),
        of all buckets or of the given ones."""
        found = self._manifest(name).get("absorbed", []) if self.exists(name) else []
        return [e for e in found if buckets is None or e["bucket"] in buckets]

    def read_absorbed(self, name: str, entries: list[dict], schema: str) -> DataFrame:
        return self.read_side(name, entries, schema)

    def write_absorbed(self, name: str, rows: DataFrame, bucket: Column) -> list[dict]:
        return self.write_side(name, rows, bucket)

    def index(self, name: str) -> list[dict]:
        """Folders of the current snapshot's index of keys to months (see ``plans/keymonths``)."""
        return self._manifest(name).get("index", [])

    def unindexed(self, name: str) -> list[dict]:
        """Data folders of the current snapshot that its index does not cover."""
        return [e for e in self._manifest(name)["folders"] if not e.get("indexed")]

    def read_unindexed(self, name: str) -> DataFrame:
        paths = [f"{self.table_path(name)}/{e['path']}" for e in self.unindexed(name)]
        return self.spark.read.schema(self.schema(name)).format(self.fmt).load(paths)

    def read_side(self, name: str, entries: list[dict], schema: str) -> DataFrame:
        """Rows that lie beside the table's own, in the folders of the given entries."""
        return self.spark.read.schema(schema).format(self.fmt).load([f"{self.table_path(name)}/{e['path']}" for e in entries])

    def write_side(self, name: str, rows: DataFrame, bucket: Column) -> list[dict]:
        """Write rows to fresh folders, one for each value of ``bucket``; they count once a
        commit names their entries."""
        rel = f"data/{uuid.uuid4().hex}"
        rows.withColumn(PART_COL, bucket).write.option("compression", "zstd").partitionBy(PART_COL) \
            .format(self.fmt).save(f"{self.table_path(name)}/{rel}")
        return [{"bucket": d.split("=", 1)[1], "path": f"{rel}/{d}"}
                for d in self._subdirs(f"{self.table_path(name)}/{rel}") if d.startswith(f"{PART_COL}=")]

    def folders(self, name: str) -> list[str]:
        """Data folders of the current snapshot."""
        return [e["path"] for e in self._manifest(name)["folders"]]

    def _commit(self, name: str, schema: T.StructType, partition_date: str | None, folders: list[dict],
                buckets: dict | None = None, absorbed: list[dict] | tuple = (), index: list[dict] | tuple = ()) -> int:
        """Publish a snapshot: write the manifest aside, then rename it into place.

        ``absorbed`` and ``index`` travel with the rows: a commit that keeps the table's
        rows keeps them, one that empties the table starts without any."""
        seq = self.next_snapshot(name)
        final = self._snap_file(name, seq)
        tmp = f"{self.table_path(name)}/_snapshots/.tmp-{uuid.uuid4().hex}"
        self._write_text(tmp, json.dumps({"schema": schema.json(), "partition_date": partition_date,
                                          "buckets": buckets, "folders": folders,
                                          "absorbed": list(absorbed), "index": list(index)}))
        fs, p_tmp = self._fs(tmp)
        _, p_final = self._fs(final)
        if fs.exists(p_final) or not fs.rename(p_tmp, p_final):
            fs.delete(p_tmp, False)
            raise RuntimeError(f"concurrent commit on table {name}: snapshot {seq} exists")
        return seq

    # ------------------------------------------------------------------ read
    def read(self, name: str, snapshot: int | None = None, months: list[str] | None = None) -> DataFrame:
        """Rows of a snapshot (the latest by default); ``months`` keeps only the
        folders of those months (pruning on the manifest, no file is opened)."""
        man = self._manifest(name, snapshot)
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        folders = man["folders"]
        if months is not None:
            want = set(months)
            folders = [e for e in folders if e["month"] in want]
        paths = [f"{self.table_path(name)}/{e['path']}" for e in folders]
        if not paths:
            return self.spark.createDataFrame([], schema).limit(0)  # known to be empty: joins with it fall away
        if man.get("buckets") and len(paths) == 1:
            return self._bucketed_scan(paths[0], schema, man["buckets"])
        return self.spark.read.schema(schema).format(self.fmt).load(paths)

    @staticmethod
    def _bucket_ref(path: str) -> str:
        return "lodestar_b_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex

    def _unregister(self, paths: list[str]) -> None:
        """Remove the catalog entries of bucketed folders (external: no files touched)."""
        for path in paths:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._bucket_ref(path)}")

    def _bucketed_scan(self, path: str, schema: T.StructType, buckets: dict) -> DataFrame:
        """Read one bucketed folder through an external catalog table, so Spark
        knows the rows are hash-partitioned on the keys: a shuffle join on the
        keys then moves only the other side.  The entry is named by the folder,
        so every session registers it once."""
        ref = self._bucket_ref(path)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in buckets["keys"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {ref} ({cols}) USING {self.fmt} "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets['n'])} BUCKETS LOCATION '{path}'")
        return self.spark.table(ref)

    # ------------------------------------------------------------------ write
    def _write_data(self, name: str, df: DataFrame, part: str | None, cluster: bool = True,
                    buckets: dict | None = None, order: list[Column] | tuple = ()) -> list[dict]:
        """Write rows to a fresh data folder; return its folder entries.

        ``cluster`` shuffles rows of one month together first (a rebalance, so
        AQE splits a hot month over several tasks instead of one).  Rows that
        already arrive month by month (read from month folders, not moved by a
        shuffle) are written as they are: the writer sorts by month inside each
        task.  With an ``order`` the rows of a month table are range-partitioned by month
        and order and sorted: each file holds a narrow range (so filters on the order
        skip files and row groups) and a hot month is still cut over several tasks."""
        rel = f"data/{uuid.uuid4().hex}"
        path = f"{self.table_path(name)}/{rel}"
        if part:
            df = df.withColumn(PART_COL, month_of(part))
            if order:
                keys = [F.col(PART_COL).asc(), *order]
                df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
            elif cluster:
                df = df.hint("rebalance", PART_COL)
            df.write.mode("errorifexists").option("compression", "zstd").partitionBy(PART_COL) \
                .format(self.fmt).save(path)
            out = []
            for d in self._subdirs(path):
                if d.startswith(f"{PART_COL}="):
                    out.append({"month": d.split("=", 1)[1], "path": f"{rel}/{d}"})
            return out
        if buckets:
            # Bucketed files (one per bucket and task) need the catalog writer;
            # the temporary entry is external, so dropping it keeps the files.
            tmp = f"lodestar_w_{uuid.uuid4().hex}"
            keys = list(buckets["keys"])
            df.write.mode("errorifexists").option("compression", "zstd").option("path", path) \
                .bucketBy(int(buckets["n"]), *keys).sortBy(*keys).format(self.fmt).saveAsTable(tmp)
            self.spark.sql(f"DROP TABLE IF EXISTS {tmp}")
            return [{"month": None, "path": rel}]
        df.write.mode("errorifexists").option("compression", "zstd").format(self.fmt).save(path)
        return [{"month": None, "path": rel}]

    def _typed(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    def replace(self, name: str, df: DataFrame, partition_date: str | None = None, keep_meta: bool = False,
                buckets: dict | None = None, absorbed: list[dict] | None = None) -> int:
        """CREATE OR REPLACE with content: a new snapshot of these rows only.

        ``keep_meta`` keeps the layout and what was absorbed, unless ``absorbed`` replaces it."""
        done: list[dict] = []
        if keep_meta and self.exists(name):
            partition_date, buckets, done = self.partition_date(name), self.buckets(name), self.absorbed(name)
        folders = self._write_data(name, df, partition_date, buckets=buckets)
        return self._commit(name, df.schema, partition_date, folders, buckets, done if absorbed is None else absorbed)

    def replace_months(self, name: str, df: DataFrame, months: list[str], cluster: bool = True,
                       absorbed: list[dict] | None = None, index: list[dict] | None = None,
                       order: list[Column] | tuple = ()) -> int:
        """Replace the rows of ``months`` by ``df`` and keep every other month.

        ``df`` must only hold rows of ``months`` (the caller derives the months
        from the rows it changes); a month left without rows disappears.  With an
        ``index`` that covers all rows of the new snapshot its folders count as indexed."""
        man = self._manifest(name)
        part = man["partition_date"]
        if not part:
            raise ValueError(f"table {name} is not partitioned by month")
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        drop = set(months)
        kept = [e for e in man["folders"] if e["month"] not in drop]
        new = self._write_data(name, self._typed(df, schema), part, cluster, order=order)
        folders = kept + new if index is None else [e | {"indexed": True} for e in kept + new]
        return self._commit(name, schema, part, folders,
                            absorbed=man.get("absorbed", []) if absorbed is None else absorbed,
                            index=man.get("index", []) if index is None else index)

    def stage(self, name: str, df: DataFrame, observe: Callable[[DataFrame], DataFrame] | None = None,
              order: list[Column] | tuple = ()) -> tuple[list[dict], DataFrame]:
        """Write rows into fresh data folders of the table without committing
        them (write-audit-publish): returns the folder entries and the rows as
        written, for checks.  ``publish`` commits the very same files;
        ``discard`` deletes them.  No reader sees them before the commit.
        ``observe`` may add metrics to the rows on their way to the files."""
        man = self._manifest(name)
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        typed = self._typed(df, schema)
        entries = self._write_data(name, observe(typed) if observe else typed, man["partition_date"], buckets=man.get("buckets"), order=order)
        paths = [f"{self.table_path(name)}/{e['path']}" for e in entries]
        rows = (self.spark.read.schema(schema).format(self.fmt).load(paths) if paths
                else self.spark.createDataFrame([], schema))
        return entries, rows

    def publish(self, name: str, entries: list[dict], mode: str = "append") -> int:
        """Commit staged folders: added to the table (append) or as the whole table (replace)."""
        man = self._manifest(name)
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        if mode == "append":
            folders = man["folders"] + entries
        elif mode == "replace":
            folders = list(entries)
        else:
            raise ValueError(f"unknown publish mode {mode!r}")
        done, index = (man.get("absorbed", []), man.get("index", [])) if mode == "append" else ([], [])
        return self._commit(name, schema, man["partition_date"], folders, man.get("buckets"), done, index)

    def discard(self, name: str, entries: list[dict]) -> None:
        """Delete staged folders that were never committed."""
        for top in {e["path"].split("/")[1] for e in entries}:
            fs, p = self._fs(f"{self.table_path(name)}/data/{top}")
            fs.delete(p, True)

    def create(self, name: str, schema: T.StructType, partition_date: str | None = None,
               buckets: dict | None = None) -> int:
        """SNK2: create or replace an empty table.  ``buckets`` ({"n", "keys"})
        stores an unpartitioned table hash-bucketed on its keys."""
        if buckets and partition_date:
            raise ValueError("bucketed tables are unpartitioned here")
        return self._commit(name, schema, partition_date, [], buckets)

    def append(self, name: str, df: DataFrame, absorbed: list[dict] | None = None,
               order: list[Column] | tuple = ()) -> int:
        """SNK1: insert by name: the current folders plus one new write."""
        man = self._manifest(name)
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        part = man["partition_date"]
        new = self._write_data(name, self._typed(df, schema), part, buckets=man.get("buckets"), order=order)
        return self._commit(name, schema, part, man["folders"] + new, man.get("buckets"),
                            man.get("absorbed", []) if absorbed is None else absorbed, man.get("index", []))

    def remove_folders(self, name: str, paths: list[str]) -> int:
        """Take the rows of the given data folders out of the table; rows that arrived since stay."""
        man = self._manifest(name)
        gone = set(paths)
        schema = T.StructType.fromJson(json.loads(man["schema"]))
        return self._commit(name, schema, man["partition_date"], [e for e in man["folders"] if e["path"] not in gone],
                            man.get("buckets"), man.get("absorbed", []), man.get("index", []))

    def truncate(self, name: str) -> int:
        """SNK4: delete all rows (a new empty snapshot, same schema)."""
        return self.create(name, self.schema(name), self.partition_date(name), self.buckets(name))

    def delete_where(self, name: str, cond: str) -> int:
        """SNK5: conditional delete; a row is kept unless ``cond`` is true.

        Of a month-partitioned table only the months that lose a row are rewritten
        (their list, one value per calendar month, is found by a scan of the columns
        of ``cond``); with no hit nothing is written."""
        hit = F.coalesce(F.expr(cond), F.lit(False))
        part = self.partition_date(name)
        if not part:
            return self.replace(name, self.read(name).where(~hit), keep_meta=True)
        month = F.coalesce(month_of(part), F.lit(NULL_MONTH)).alias("m")
        months = sorted(r["m"] for r in self.read(name).where(hit).select(month).distinct().collect())
        if not months:
            return self.snapshots(name)[-1]
        return self.replace_months(name, self.read(name, months=months).where(~hit), months)

    def compact(self, name: str, months: list[str] | None = None) -> int:
        """Rewrite many small appends as one write: the whole table, or only
        ``months`` of a month-partitioned table (other months keep their files)."""
        if months is not None:
            return self.replace_months(name, self.read(name, months=months), months)
        return self.replace(name, self.read(name), keep_meta=True)

    def expire(self, name: str, keep: int = 1, grace_seconds: int = 3600) -> list[str]:
        """Drop all but the newest ``keep`` snapshots and delete data folders no
        kept snapshot references (replaced months, rejected or crashed loads).
        Folders younger than ``grace_seconds`` are left alone, so a load being
        written right now is never removed.  Returns the deleted folders."""
        if keep < 1:
            raise ValueError("keep at least one snapshot")
        snaps = self.snapshots(name)
        kept = snaps[-keep:]
        for seq in snaps[:-keep]:
            fs, p = self._fs(self._snap_file(name, seq))
            fs.delete(p, False)
        live = set()
        for seq in kept:
            man = self._manifest(name, seq)
            for e in man["folders"] + man.get("absorbed", []) + man.get("index", []):
                live.add(e["path"])
        jvm = self.spark._jvm
        cutoff = jvm.java.lang.System.currentTimeMillis() - grace_seconds * 1000
        fs, data = self._fs(f"{self.table_path(name)}/data")
        if not fs.exists(data):
            return []
        gone = []
        for st in fs.listStatus(data):
            wid = f"data/{st.getPath().getName()}"
            parts = [c for c in fs.listStatus(st.getPath()) if c.isDirectory()
                     and c.getPath().getName().startswith(f"{PART_COL}=")]
            units = [(f"{wid}/{c.getPath().getName()}", c) for c in parts] or [(wid, st)]
            for rel, status in units:
                if rel not in live and status.getModificationTime() < cutoff:
                    self._unregister([f"{self.table_path(name)}/{rel}"])
                    fs.delete(status.getPath(), True)
                    gone.append(rel)
        return gone

    def drop(self, name: str) -> None:
        """SNK3: drop table with its data (PURGE)."""
        for seq in self.snapshots(name):
            man = self._manifest(name, seq)
            if man.get("buckets"):
                self._unregister([f"{self.table_path(name)}/{e['path']}" for e in man["folders"]])
        fs, p = self._fs(self.table_path(name))
        if fs.exists(p):
            fs.delete(p, True)

    def dropcreate(self, name: str, schema: T.StructType, partition_date: str | None = None,
                   buckets: dict | None = None) -> int:
        if buckets is None and partition_date is None and self.exists(name):
            buckets = self.buckets(name)  # the layout outlives the drop
        self.drop(name)
        return self.create(name, schema, partition_date, buckets)
