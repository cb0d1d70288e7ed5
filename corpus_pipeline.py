"""Corpus pipeline: from raw documents to packed training sequences, one written stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faresift.llm import decontaminate, line_dedup, packing, quality, simhash
from faresift.llm.common import materialise, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents stay once."""
    return line_dedup.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids and their places in sequences of fixed length."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sequence_packing", sequence_packing),
]

# SQL cannot say the classifier, the fingerprints and the genetic packing; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
