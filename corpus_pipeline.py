"""Corpus pipeline: documents to packed training sequences in four stages.

1. language ID: documents whose language cannot be told go;
2. MinHash near-duplicates: one document of each class of alike texts stays;
3. substring dedup: words of repeated passages go, and documents left empty;
4. best-fit packing: what is left is cut and packed into sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  ``run`` writes
each result as Parquet in the shared folder and gives it, read again, to the
next stage.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import language, minhash, packing, repeats
from lodestar.llm.common import documents, stage

#: No SQL can express the stages; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.cleaned(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language id", language_id),
    ("minhash near-duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
