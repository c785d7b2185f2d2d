"""The operators' queries over whole tables, by name, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowledger.llm import (
    bpe,
    chat,
    cross_tokenizer,
    language,
    line_dedup,
    mixing,
    order_minhash,
    permutation_index,
    secrets,
    sharding,
    simhash,
    toxicity,
    whitening,
)
from flowledger.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def order_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_next(table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_report(table(spark, sf_dir, "embeddings"))


def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_report(table(spark, sf_dir, "documents"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(table(spark, sf_dir, "documents"))


def language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(chat.with_probe(table(spark, sf_dir, "conversations")))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer.alignment_report(table(spark, sf_dir, "documents"))


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def deduplicated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_order_minhash": order_minhash_fingerprints,
    "op2_permutation_index": nearest_vectors,
    "op3_shard_documents": shard_documents,
    "op4_secret_scan": secret_scan,
    "op5_simhash_near_dedup": simhash_near_dedup,
    "op6_mix_sources": mix_sources,
    "op7_bpe_encode": bpe_encode,
    "op8_language_id": language_spans,
    "op9_chat_windows": chat_windows,
    "op10_toxicity": toxicity_scores,
    "op11_cross_tokenizer": aligned_tokens,
    "op12_embedding_whitening": whitened_embeddings,
    "op13_line_dedup": deduplicated_lines,
}

SQL: dict[str, str] = {"op9_chat_windows": chat.report_sql(), "op13_line_dedup": line_dedup.report_sql()}
