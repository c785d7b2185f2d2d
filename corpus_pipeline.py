"""A training corpus from raw documents: five operators one after the other.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of documents; the
last one returns the encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.llm import bpe, language, mixing, secrets, simhash
from flowledger.llm.common import bounded_batches, fresh_name, staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the rows that name a language: texts without a letter go, the others bear it.

    If no row names a language, nothing can be told apart: texts with letters stay and their lang stays null.
    """
    model = language.learn(docs)
    if not model.names:
        return bounded_batches(docs).filter(language.has_letter(F.col("text")))
    found = fresh_name(docs, "found")
    marked = bounded_batches(docs).withColumn(found, language.language(F.col("text"), model))
    return marked.filter(F.size(f"{found}.spans") > 0).withColumn("lang", F.col(f"{found}.lang")).drop(found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies the document with the smallest doc_id stays."""
    return simhash.without_near_duplicates(bounded_batches(docs))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: every secret found is masked in place; all documents stay."""
    return bounded_batches(docs).withColumn("text", secrets.without_secrets(F.col("text"))).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents the mix leaves out go, those it takes twice come twice."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: doc_id, ids and their number; ``bpe.decoded`` turns ids back into text."""
    coded = bounded_batches(docs).select("doc_id", bpe.token_ids(F.col("text")).alias("ids"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secrets", remove_secrets),
    ("mix", mix_sources),
    ("bpe", encode),
]

# language ID and the merge rounds cannot be written in SQL; tests/llm/test_pipeline.py holds the stages to plain code
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
