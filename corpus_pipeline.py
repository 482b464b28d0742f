"""Corpus cleaning as stages, each a table written and read again: quality, near-duplicates, leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paxledger.llm import decontam, neardup, packing, quality, secrets
from paxledger.llm.common import settle, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: texts that share 0.8 of their shingles of five words."""
    return neardup.keep_one(docs, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    return secrets.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become token pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("packing", pack_sequences),
]

#: Compression, signatures and tokens can't be expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
