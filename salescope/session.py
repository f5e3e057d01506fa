"""Spark session and shared-folder helpers.

The library never picks executor counts or memory: those belong to the
cluster. It only sets SQL behaviour it relies on (UTC, AQE) and, for local
runs, a checkpoint folder when none is configured.
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL_CHECKPOINT_ROOT: str | None = None

# Compressed columns grow tenfold in memory: a task reads so much of them that its sorts fit, more input makes more
# tasks, and a table is planned for a broadcast by about the size it has in memory, not the size of its file.
ROW_GROUP_BYTES = 16 << 20
TABLE_CODEC = "zstd"           # of the tables in the shared folder, which count as disk
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


def get_session(master: str | None = None, app_name: str = "salescope",
                shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query of the library assumes, applied to any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in TASK_SIZES.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local session may fall back to a fresh folder
    under /tmp; on a cluster the setting is required.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a shared folder is required on a cluster")
    if _LOCAL_CHECKPOINT_ROOT is None:
        _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="salescope-ckpt-")
    sc.setCheckpointDir(_LOCAL_CHECKPOINT_ROOT)
    return sc.getCheckpointDir() or _LOCAL_CHECKPOINT_ROOT


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the session."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


__all__ = ["get_session", "prepare", "checkpoint_dir", "shared_path",
           "path_exists"]
