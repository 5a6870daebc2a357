"""The registered queries of the training-data operators (one per operator)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    counting,
    divergence,
    infill,
    language,
    maxent,
    minhash,
    oracles,
    packing,
    pieces,
    repeats,
    search,
    sharding,
    vectors,
    winnowing,
)
from .common import documents, embeddings


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(documents(spark, sf_dir), path)
    return pieces.digests(pieces.decode(encoded, path))


def op2_packed_sequences(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf_dir), path, capacity=2048, end_id=0)


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "spans")


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), weights=(1.0,) * 8)


def op5_edited_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Counts before and after personal data and secrets are replaced by tags."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    docs = counting.with_redactions(documents(spark, sf_dir).select("doc_id", "text"))
    counted = counting.apply_edits(counting.build(docs, path, edits="edits"), path)
    return counted.select("doc_id", "n_tokens", "n_pretokens", "n_edits", "n_tokens_edited", "n_reencoded")


def op6_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(embeddings(spark, sf_dir), threshold=0.98)


def op7_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(documents(spark, sf_dir))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(embeddings(spark, sf_dir), F.col("id") % 50 == 0, k=5, scale=256)


def _sha256(name: str) -> F.Column:
    return F.sha2(F.col(name).cast("binary"), 256)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = infill.restore(infill.transform(documents(spark, sf_dir).select("doc_id", "text"), seed=42, rate=50, spm=80))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256("output").alias("output_sha256"),
                       _sha256("restored").alias("restored_sha256"))


def op12_winnowed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = winnowing.against_next(documents(spark, sf_dir))
    return prints.select("doc_id", "n_chars", _sha256("edited").alias("edited_sha256"),
                         winnowing.as_text(F.col("fingerprint")).alias("fingerprint"),
                         winnowing.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                         "near_edited", "near_next")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir), least=30, add=5, scale=10 ** 9, ranks=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_packed_sequences": op2_packed_sequences,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_rendezvous_shards": op4_rendezvous_shards,
    "op5_edited_token_counts": op5_edited_token_counts,
    "op6_embedding_near_duplicates": op6_embedding_near_duplicates,
    "op7_maxent_scores": op7_maxent_scores,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_language_id": op9_language_id,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_winnowed_fingerprints": op12_winnowed_fingerprints,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = oracles.ORACLE
