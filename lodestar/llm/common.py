"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import checkpoint_root, work_dir

#: Code points that end a word: space and the five ASCII controls tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    The folder is new each time, so a rerun never meets old files.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, 'llm', name)}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_uid(df: DataFrame) -> DataFrame:
    """Add ``uid``: a long that is unique per row.  Stage the result before using it twice."""
    return df.withColumn("uid", F.monotonically_increasing_id())


def salt() -> str:
    return uuid.uuid4().hex[:8]


def crc_of_id(col) -> F.Column:
    """crc32 of the id written as decimal text (unsigned); a null id counts as empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


_held: dict[tuple, object] = {}


def hold(kind: str, name: object, make: Callable):
    """The model ``name`` of a worker process, made if it is not the one held.

    A process holds one model at a time: workers outlive the job that started them, and
    the next operator's memory must not come on top of the last one's."""
    key = (kind, name)
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Let go of what an earlier operator left in this worker process: its model, and memory
    that was freed but kept by the allocators."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class TwoGenerationCache(dict):
    """A bounded memo: ``self[key]`` computes a missing value with ``make(key)``.

    When ``limit`` keys are held, they become the old generation and a new one
    starts; keys met again are carried over, so frequent keys are kept and
    memory stays within twice the limit.  Long keys are never kept.
    """

    def __init__(self, make: Callable, limit: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


__all__ = ["WORD_PATTERN", "documents", "embeddings", "stage", "with_uid", "salt", "crc_of_id",
           "hold", "release", "TwoGenerationCache", "checkpoint_root", "work_dir"]
