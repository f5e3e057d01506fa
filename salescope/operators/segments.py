"""RFM customer segments with Spark ML KMeans (M3).

Features are recency, frequency and monetary value per customer,
standardised with the population mean and standard deviation (a constant
feature becomes 0). KMeans runs ``n_init`` times with different seeds and
the fit with the lowest training cost is kept. Clusters are summarised and
labelled by falling mean monetary value.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..functions.numeric import half_up
from .customers import rfm

FEATURES = ["recency", "frequency", "monetary"]


def standardized(r: DataFrame) -> DataFrame:
    """The features with their z-scores (population deviation; a constant feature is 0)."""
    stats = r.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                    for c in FEATURES])
    cols = []
    for c in FEATURES:
        st = stats.select(c).scalar()
        sd = F.coalesce(st["s"], F.lit(0.0))
        cols.append(F.when(sd > 0, (F.col(c).cast("double") - st["m"]) / sd)
                     .otherwise(F.lit(0.0)).alias(f"z_{c}"))
    return r.select("*", *cols)


# The features lie in partitions of about so many customers, whatever the session,
# dealt by customer and sorted inside: seeds pick rows by partition and place, so the
# start points, and with them the clusters, depend on the customers alone.
PARTITION_ROWS = 20_000


def assign_clusters(r: DataFrame, k: int = S.SEGMENT_COUNT, seed: int = S.SEGMENT_SEED,
                    n_init: int = S.SEGMENT_INITS, max_iter: int = 100) -> DataFrame | None:
    """Customers with their cluster id (``prediction``); None if there are fewer than ``k``.

    The per-customer table is cached first, so the fact is aggregated once for
    the count, the scaler statistics and the features.
    """
    vec = VectorAssembler(inputCols=[f"z_{c}" for c in FEATURES], outputCol="features")
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    data = None
    try:
        customers = r.count()
        if customers < k:
            return None
        data = vec.transform(standardized(r)).repartition(-(-customers // PARTITION_ROWS), "customer_id") \
                  .sortWithinPartitions("customer_id").persist(StorageLevel.MEMORY_AND_DISK)
        data.count()

        def fit(i: int):
            model = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=1e-4,
                           featuresCol="features").fit(data)
            return model.summary.trainingCost, i, model

        # the fits are independent Spark jobs over the same cached features; a few
        # at a time let the scheduler overlap them
        slots = max(1, r.sparkSession.sparkContext.defaultParallelism // 4)
        with ThreadPoolExecutor(max_workers=max(1, min(n_init, slots))) as pool:
            fits = list(pool.map(fit, range(n_init)))
        best = min(fits, key=lambda t: (t[0], t[1]))[2]
        # assignments written to the checkpoint folder while the features are
        # cached, so reading them later does not re-aggregate the fact
        return best.transform(data).drop("features").checkpoint(eager=True)
    finally:
        if data is not None:
            data.unpersist()
        r.unpersist()


def summarize(clustered: DataFrame) -> DataFrame:
    """Per cluster: size, mean recency / frequency / value, total value and label."""
    g = clustered.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("recency").alias("mean_recency"), F.avg("frequency").alias("mean_frequency"),
        F.avg("monetary").alias("mean_monetary"), F.sum("monetary").alias("total_monetary"))
    # one row per cluster (k rows): ranking them in one partition is bounded by k
    rank = F.row_number().over(Window.orderBy(F.desc("mean_monetary"), "prediction")) - 1
    labels = F.array(*[F.lit(x) for x in S.SEGMENT_LABELS])
    g = g.select("*", rank.alias("rank"))
    label = F.when(F.col("rank") < len(S.SEGMENT_LABELS),
                   F.element_at(labels, (F.col("rank") + 1).cast("int"))) \
             .otherwise(F.concat(F.lit("Cluster "), F.col("rank").cast("string")))
    return g.select(F.col("prediction").cast("bigint").alias("cluster"), "customers",
                    *[half_up(c).alias(c) for c in
                      ("mean_recency", "mean_frequency", "mean_monetary", "total_monetary")],
                    label.alias("label")).orderBy(F.desc("mean_monetary"))


def rfm_segments(fact: DataFrame, k: int = S.SEGMENT_COUNT, n_init: int = S.SEGMENT_INITS
                 ) -> DataFrame:
    """M3: cluster summary; empty when there are fewer customers than ``k``."""
    clustered = assign_clusters(rfm(fact), k=k, n_init=n_init)
    if clustered is None:
        schema = ("cluster bigint, customers bigint, mean_recency double, mean_frequency double, "
                  "mean_monetary double, total_monetary double, label string")
        return fact.sparkSession.createDataFrame([], schema)
    return summarize(clustered)
