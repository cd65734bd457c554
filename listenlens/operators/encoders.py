"""Persisted id dictionaries that grow (K2, D4): old codes stay, new values are numbered
after the largest code.

A dictionary is a folder of generations, one for each append that found new values, each
a Parquet table of ``(value, code, rows)``; ``rows`` is the generation's size.  A generation
counts only when all its rows are there, so an append that broke off, at any point, leaves
the dictionary as it was, and the next append overwrites what it left.  One writer at a
time; readers need no lock.

Defined results: null values get no code; repeated ones get one; an append without new
values writes nothing; a folder that does not exist yet is an empty dictionary.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.functions import dense_index
from listenlens.session import materialize

SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("code", T.LongType()),
                       T.StructField("rows", T.LongType()), T.StructField("generation", T.IntegerType())])


def load(spark: SparkSession, path: str) -> DataFrame:
    """``(value, code, generation)`` of all complete generations."""
    try:
        stored = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA).drop("rows")
    whole = stored.groupBy("generation").agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows")).where(F.col("n") == F.col("rows"))
    return stored.join(whole.select("generation"), "generation", "left_semi").select("value", "code", "generation")


def append(values: DataFrame, column: str, path: str) -> int:
    """Give a code to every value of ``column`` that has none; returns how many are new."""
    spark = values.sparkSession
    old = load(spark, path)
    last = old.agg(F.max("code"), F.max("generation")).first()
    fresh = values.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    fresh = materialize(fresh.join(old, "value", "left_anti"))
    n = fresh.count()
    if n:
        base = 0 if last[0] is None else last[0] + 1
        generation = 0 if last[1] is None else last[1] + 1
        numbered = dense_index(fresh, ["value"], name="code", base=base)
        numbered.withColumn("rows", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{path}/generation={generation}")
    return n


def encode(rows: DataFrame, column: str, path: str, name: str | None = None) -> DataFrame:
    """``rows`` with the code of ``column``; null where the dictionary has none."""
    codes = load(rows.sparkSession, path).select(F.col("value").alias("_value"), F.col("code").alias(name or f"{column}_code"))
    return rows.join(codes, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")
