"""Write-once tables in the shared checkpoint folder.

A plan that several queries read (the fact, the landing files, the stacked
standard rows) is written once per application as Parquet and read back:
the write cuts the lineage, so a lost executor recomputes from files, not
from the whole chain of joins and parses.
"""
from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session as SS

_guard = threading.Lock()
_locks: dict[tuple[str, ...], threading.RLock] = {}
_paths: dict[tuple[str, ...], str] = {}


def _lock_for(k: tuple[str, ...]) -> threading.RLock:
    """One lock per table: the same table is written once, different tables
    may be written at the same time."""
    with _guard:
        return _locks.setdefault(k, threading.RLock())


def input_state(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of a folder's entries: what a table made from it depends on."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return ""
    return ";".join(sorted(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}"
                           for st in fs.listStatus(path)))


def _path(spark: SparkSession, kind: str, key: str) -> tuple[tuple[str, ...], str]:
    k = (spark.sparkContext.applicationId, kind, key, input_state(spark, key))
    digest = hashlib.sha1("|".join(k).encode()).hexdigest()[:16]
    return k, SS.shared_path(spark, f"{kind}-{digest}")


def written(spark: SparkSession, kind: str, key: str) -> DataFrame | None:
    """The table that :func:`materialized` wrote, if it did; nothing is built."""
    k, path = _path(spark, kind, key)
    with _lock_for(k):
        there = _paths.get(k) == path and SS.path_exists(spark, path + "/_SUCCESS")
    return spark.read.parquet(path) if there else None


def materialized(spark: SparkSession, kind: str, key: str,
                 build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once under ``<checkpoint dir>/<kind>-<digest>``, read back.

    ``key`` is the input folder; a changed listing of it is another table.
    """
    k, path = _path(spark, kind, key)
    with _lock_for(k):
        if _paths.get(k) != path or not SS.path_exists(spark, path + "/_SUCCESS"):
            (build().write.mode("overwrite").option("parquet.block.size", SS.ROW_GROUP_BYTES)
             .option("compression", SS.TABLE_CODEC).parquet(path))
            _paths[k] = path
    return spark.read.parquet(path)
