"""Processed-file ledger (SRC8-10): each extract file is loaded once.

The ledger is a table ``(entity, n, file, load_ts)`` in the store; the set
difference with the discovered files is an anti join.  It is appended only
after a load is published (quirk Q7), never for ``loadmanytimes`` entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.sources.store import Store

LEDGER = "srcfile_ledger"
FOLDERS = 64  # with more write folders than this the ledger is compacted
SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("load_ts", T.TimestampType()),
    ]
)


def ledger(store: Store) -> DataFrame:
    if not store.exists(LEDGER):
        store.create(LEDGER, SCHEMA)
    return store.read(LEDGER)


def unprocessed(files: DataFrame, store: Store, entity: str, n: str) -> DataFrame:
    """SRC8: files of this table number not yet in the ledger."""
    done = ledger(store).where((F.col("entity") == entity) & (F.col("n") == n)).select("file")
    return files.join(done, ["file"], "left_anti")


def ledger_append(store: Store, entity: str, n: str, files: DataFrame, loadmanytimes: bool = False) -> None:
    """SRC9: record loaded files (suppressed for loadmanytimes entities)."""
    if loadmanytimes:
        return
    ledger(store)
    rows = files.select(
        F.lit(entity).alias("entity"), F.lit(n).alias("n"), F.col("file"), F.current_timestamp().alias("load_ts")
    )
    store.append(LEDGER, rows)
    if len(store.folders(LEDGER)) > FOLDERS:
        store.compact(LEDGER)


def ledger_reset(store: Store, entity: str, n: str) -> None:
    """SRC10: forget the files of one table number (on drop or create)."""
    cur = ledger(store)
    mine = (F.col("entity") == entity) & (F.col("n") == n)
    if cur.where(mine).isEmpty():
        return  # nothing to forget: no rewrite
    store.replace(LEDGER, cur.where(~mine))
