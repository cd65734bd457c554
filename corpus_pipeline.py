"""The corpus pipeline: quality rules, SimHash near-duplicates, benchmark
decontamination, secret scans, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listenlens.llm import decontaminate, packing, quality_rules, secret_scan, simhash
from listenlens.llm.common import read_table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; all documents stay."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack),
]

#: SimHash and packing are not expressible in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", few=False)
    return STAGES[-1][1](spark, docs, sf_dir)
