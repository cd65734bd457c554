"""Tables that are looked up by key (K3, J6): written once in buckets of the key, so
that later joins on it read them in place, without a shuffle of their side."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def save_by_key(df: DataFrame, path: str, key: str = "track_id", buckets: int | None = None) -> DataFrame:
    """``df`` as Parquet under ``path`` in ``buckets`` (default: the session's shuffle
    partitions) of ``key``, sorted within them, one file per bucket; read back."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name()
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
        "path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def load_by_key(spark: SparkSession, path: str, key: str = "track_id", buckets: int | None = None) -> DataFrame:
    """What ``save_by_key`` wrote, for a session that does not know the table: ``key`` and
    ``buckets`` must be those of the writer (a file's name carries its bucket)."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION :path", args={"path": path})
    return spark.table(name)


def _table_name() -> str:
    return f"by_key_{uuid.uuid4().hex}"
