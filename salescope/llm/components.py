"""Connected components of a distributed edge list (alternating large and small stars)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable, for every node with an edge.

    Each round links every larger neighbour to the smallest one (large star),
    then every smaller neighbour (small star); the rows stay at most the edges.
    Every step is an aggregate and a join, so a hub is pre-aggregated and its
    rows can be split; each round is written to the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    now, before = C.store(now, "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        old, now = now, C.store(small, "edges")
        C.drop_stored(now.sparkSession, old)
        sign = now.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
