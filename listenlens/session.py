"""SparkSession helpers.

Library functions never create sessions themselves; they take DataFrames and
use ``df.sparkSession``.  ``get_spark`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "listenlens", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("LISTENLENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we use it as
    is.  A local folder is only taken where driver and executors are one process
    (``local`` masters); elsewhere an unset folder is an error, since executors
    on other machines could not read it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("spark.checkpoint.dir must name a shared folder on a remote session") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        configured = tempfile.mkdtemp(prefix="listenlens-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return configured


def ship(spark: SparkSession) -> None:
    """Let the session's Python workers import this package: its folder goes on
    their path.  On a cluster the package must lie in the same place on every
    machine or be passed with ``--py-files``."""
    try:
        environment = spark.sparkContext.environment
    except Exception:  # a remote (Connect) session: the server sets up its workers
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_batches(df, run, schema):
    """``df.mapInArrow(run, schema)`` with workers that can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's shared folder, for tables that are written and
    read back."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Write ``df`` to the checkpoint folder and read it back (cuts lineage).

    Used where a bounded intermediate feeds several jobs (the dense core, the
    inputs of a block product): later jobs read the written table instead of
    recomputing the scan, and a lost executor does not force a rerun of the
    whole lineage.  Never a machine-local checkpoint.  With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go away when
    the DataFrame is no longer referenced.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and written tables that no plan refers to any more;
    it does so when the driver's JVM collects its garbage, which a long loop may not make it do."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # a remote (Connect) session: the server cleans up
        return


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings to size a session for a given input volume.

    Shuffle partitions follow the data (about ``target_partition_bytes`` per
    partition, at least twice the cores) so partitions fit in executor memory;
    AQE coalesces small ones and splits skewed joins at run time.  The
    broadcast threshold stays small: only sides with a proven bound should be
    broadcast, and AQE's runtime statistics decide the rest.
    """
    shuffle = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        # written intermediates are removed once no plan refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
