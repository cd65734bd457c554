"""Helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlens import session
from listenlens.session import ensure_checkpoint_dir

#: Bytes of an Arrow batch, unless the session sets its own bound.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``.  Texts are long: batches are bounded in bytes,
    which both the executor's and the worker's buffers follow."""
    conf = df.sparkSession.conf
    conf.set(_BATCH_SETTING, conf.get(_BATCH_SETTING, BATCH_BYTES))
    return session.map_batches(df, run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, few: bool = True) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.  ``few``: the rows go
    to files by their bytes (the adaptive planner's advisory size), whatever made
    them; not for tables of whole texts, nor where the scan's partitions will do.

    Cuts the lineage: a lost executor or a later job reads the table, and a
    retried task cannot see other rows than the first attempt committed.
    """
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if few else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def py_texts(column) -> Iterator[str]:
    """The texts of an Arrow column one by one, null as empty: a batch may hold
    tens of megabytes."""
    return (v.as_py() or "" for v in column)
