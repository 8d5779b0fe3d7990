"""Session helpers.

On a cluster the session is given; only ``checkpoint_dir`` reads from it.
``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "purchase_signals") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage (a folder set on the context counts
    too). Only on a ``local`` master, where it is unset in tests, a scratch
    folder is made; elsewhere each executor would write to its own disk, so
    that is an error.
    """
    sc = spark.sparkContext
    set_by = spark.conf.get("spark.checkpoint.dir", None)
    now = sc.getCheckpointDir()
    if not set_by and not now:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        set_by = tempfile.mkdtemp(prefix="ps-ckpt-")
    if not set_by:
        return os.path.dirname(now)  # the context adds a folder of its own
    if not now or os.path.dirname(now).removeprefix("file:") != set_by.rstrip("/").removeprefix("file://").removeprefix("file:"):
        sc.setCheckpointDir(set_by)
        spark.conf.set("spark.checkpoint.dir", set_by)
    return set_by


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back:
    later plans scan it with column pruning, pushed filters and file
    statistics, and a lost executor re-reads files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def session_key(spark: SparkSession) -> tuple:
    """Identity of a running session (application id and start time), for
    per-session reuse of stores; never reused by a later session."""
    sc = spark.sparkContext
    return (sc.applicationId, sc.startTime, spark.conf.get("spark.checkpoint.dir", ""))
