"""Helpers shared by the operators: shared-folder tables, packaging, shuffle clean-up."""
from __future__ import annotations

import os
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Sets the checkpoint folder and hands this package to the Python workers, once an application.

    Python tasks get ``TEXT_ROWS`` rows at a time where the session leaves Spark's
    default, which is meant for narrow rows, not for whole documents.
    """
    checkpoint_dir(spark)
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(TEXT_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    import tempfile  # driver-side only: Spark serves the archive to the executors
    archive = os.path.join(tempfile.mkdtemp(prefix="salescope-py-"), f"salescope-{app}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Shuffle files of the statements inside go when each statement ends."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def batch_rows(spark: SparkSession, rows: int | None):
    """Python tasks of the statements inside get at most so many rows at a time (for rows of megabytes)."""
    before = spark.conf.get(_BATCH_ROWS)
    if rows:
        spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def store(df: DataFrame, kind: str, rows_at_a_time: int | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends in files
    that outlive a lost executor."""
    spark = df.sparkSession
    path = scratch(spark, kind)
    with shuffle_cleanup(spark), batch_rows(spark, rows_at_a_time):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table made by ``store`` that no plan reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def seeded_unit(seed: int, *cols) -> F.Column:
    """A value in [0, 1) from the seed and the columns: 32 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
