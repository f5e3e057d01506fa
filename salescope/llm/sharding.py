"""Sharding by a two-pass external shuffle.

Pass one scatters every record into a memory-sized bucket chosen by a seeded
hash; pass two puts each bucket in a seeded Fisher-Yates order and writes it.
The buckets follow one another, so a record's place in the whole shuffled
corpus is the rows of the buckets before plus its place in its own, and the
shards are ``n_shards`` runs of that order whose counts differ by one at most
(the ``rows`` law).

A bucket holds ``bucket_bytes`` on average; the number of buckets follows the
data. The bucket table (one row each) is all that is ever summed in one place.

Defined cases: a null text has size 1; rows that agree in doc_id and text are
interchangeable and spread over the buckets by their row number, so repeated
rows cannot fill one bucket; a null doc_id is hashed like a value; an empty
table gives an empty result; extra columns of any name stay in the shard
files, inside the struct ``record``.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common as C

N_SHARDS = 8
SEED = 11
BUCKET_BYTES = 32 << 20
BROADCAST_BUCKETS = 100_000    # the bucket table is broadcast up to this many rows, joined by shuffle beyond


def record_size(text: str = "text"):
    """UTF-8 bytes of the text plus one."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def _fisher_yates(seed: int):
    def shuffle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys = table.column("draw").to_numpy()
        order = np.argsort(keys, kind="stable")           # a fixed start, whatever order rows arrived in
        place = np.random.default_rng([seed, bucket])
        for_each = np.arange(len(order))
        place.shuffle(for_each)                            # Fisher-Yates
        return (table.take(pa.array(order[for_each]))
                .append_column("place", pa.array(np.arange(len(order), dtype=np.int64))))
    return shuffle


def shard(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Writes the shards and returns them as read back: record, bucket, position, shard, slot.

    The files lie under ``path`` (default: a fresh folder in the shared checkpoint folder).
    """
    spark = docs.sparkSession
    C.prepare(spark)
    path = path or C.scratch(spark, "shards")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    total = rows.select(F.sum(record_size("record.text")).alias("b")).first()["b"] or 0
    n_buckets = max(C.parallelism(spark), math.ceil(total / bucket_bytes))
    drawn = F.xxhash64(F.lit(seed), "record.doc_id", "record.text")
    repeated = _repeated(rows.select(drawn.alias("draw")), n_buckets)
    scattered = rows.withColumn("draw", drawn)
    if repeated is not None:
        salt = F.xxhash64("draw", F.monotonically_increasing_id())
        scattered = (scattered.join(repeated, "draw", "left")
                     .withColumn("draw", F.when(F.col("often"), salt).otherwise(F.col("draw"))).drop("often"))
    scattered = scattered.withColumn("bucket", F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(n_buckets)).cast("int"))
    schema = scattered.withColumn("place", F.lit(0).cast("long")).schema
    buckets = (scattered.groupBy("bucket").applyInArrow(_fisher_yates(seed), schema)
               .select("bucket", "place", "record"))
    with C.shuffle_cleanup(spark):
        buckets.write.mode("overwrite").parquet(path)
    written = spark.read.schema(buckets.schema).parquet(path)
    return _numbered(written, n_shards, n_buckets <= BROADCAST_BUCKETS)


def _repeated(draws: DataFrame, n_buckets: int) -> DataFrame | None:
    """Draws that one value alone would overfill a bucket with, as a table of at most n_buckets rows."""
    counts = draws.groupBy("draw").count()
    rows = draws.count()
    often = counts.filter(F.col("count") > max(1000, rows // n_buckets)).select("draw", F.lit(True).alias("often"))
    often = C.store(often, "repeated")
    return often if often.limit(1).count() else None


def _numbered(written: DataFrame, n_shards: int, few_buckets: bool) -> DataFrame:
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("rows", F.sum("n").over(Window.partitionBy())).drop("n"))
    if few_buckets:                                        # one row a bucket, counted above
        offsets = F.broadcast(offsets)
    position = F.col("before") + F.col("place")
    numbered = written.join(offsets, "bucket").withColumn("position", position)
    # shard s holds positions from ceil(s * rows / n) on
    shard_no = F.expr(f"(position * {n_shards}) div rows")
    numbered = numbered.withColumn("shard", shard_no.cast("int"))
    first = F.expr(f"(shard * rows + {n_shards} - 1) div {n_shards}")
    return numbered.select("record", "bucket", "position", "shard", (F.col("position") - first).cast("long").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    out = shard(C.documents(spark, sf_dir))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return out.select(F.col("record.doc_id").alias("doc_id"), record_size("record.text").alias("size"),
                      F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
