"""The operators' queries over the test tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlens.llm import (
    collocations, decontaminate, packing, pii_crf, quality_classifier, quality_rules, runs, secret_scan, simhash, sql,
    suffix_dedup, toxicity, url_filter, warc_zstd,
)
from listenlens.llm.common import read_table


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, d, "documents")).withColumnRenamed("path", "doc_id")


def op2_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.report(read_table(spark, d, "documents"))


def op4_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge(read_table(spark, d, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, d, "documents"))


def op6_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier.judge(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def op7_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return pii_crf.find(read_table(spark, d, "documents"))


def op8_warc_zstd(spark: SparkSession, d: str) -> DataFrame:
    return warc_zstd.round_trip(read_table(spark, d, "pages"))


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contained(read_table(spark, d, "documents"), read_table(spark, d, "benchmark")).select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_shingles", "containment")


def op11_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.judge(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.detect(read_table(spark, d, "documents"), tile=runs.tiled)


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(read_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_secret_scan, op2_best_fit_packing, op3_quality_rules, op4_url_filter, op5_suffix_dedup,
        op6_quality_classifier, op7_personal_data, op8_warc_zstd, op9_simhash, op10_decontamination,
        op11_toxicity, op12_periodic_runs, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
