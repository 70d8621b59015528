"""A corpus pipeline: five stages over ``documents``, each a table for the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import bpe, decontamination, quality_classifier, secret_scan, simhash
from pitwall.llm.common import bounded_batches, written
from pitwall.llm.queries import BYTE_RANKS, PATTERN

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more)."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    score = quality_classifier.score_column(docs, model, F.col("text"))
    return docs.filter(score >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest doc_id."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_documents(docs, benchmark)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked in ``text`` and ``n_chars`` counted anew."""
    bounded_batches(spark)
    masked = docs.select(
        *[secret_scan.redacted(F.col("text")).alias("text") if c == "text" else c
          for c in docs.columns]
    )
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the byte-level BPE ids of every document and of the decoded bytes."""
    bounded_batches(spark)
    return bpe.round_trip(docs, BYTE_RANKS, PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", without_secrets),
    ("byte_bpe", encoded),
]

#: A trained classifier and iterated components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
