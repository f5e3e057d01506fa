"""Mergeable coverage: exact distinct customers of many groups from one scan (A6-A9, A1's total).

Customers get numbers once, gapless within each block that is numbered
together. The state of some sales holds, per (dimension, value, bucket of
256 numbers), the exact set of their customers as a bitmap and their amount;
so small buckets keep a state within its pairs of value and customer, however many
values have few customers each.
States of different sales (months, uploads, sellers) are merged by OR and sum, so the
distinct customers of any period come from stored states without the sales:
one state serves sellers, regions, channels, months and the total, where a
report of distinct pairs shuffles its own pairs each time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import money

#: Dimensions of a state; the total is one group, of the empty text.
DIMENSIONS = ("seller", "region", "channel", "month", "total")
BUCKET = 256                   # numbers of one bitmap
BLOCK = 1 << 33                # numbers of one task of a numbering: monotonically increasing ids


def number_customers(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """customer_id, number (from 1) for every customer; those ``known`` keep theirs. Write the result before using it."""
    ids = fact.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    if known is None:
        return ids.select("customer_id", (F.monotonically_increasing_id() + 1).alias("number"))
    new = ids.join(known.select("customer_id"), "customer_id", "left_anti")
    most = known.agg((F.floor(F.max("number") / BLOCK) + 1) * BLOCK).scalar()
    return known.select("customer_id", "number").unionByName(new.select(
        "customer_id", (F.monotonically_increasing_id() + 1 + F.coalesce(most, F.lit(0))).cast("long").alias("number")))


def coverage_state(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """dimension, value, bucket, customers (bitmap), amount: the state of the given sales, from one scan of them.

    The sales are summed per customer and combination of values first; rows
    without a customer count for amounts only, rows without a value not in its
    dimension.
    """
    columns = ["seller", "region", "channel"]
    month = F.date_format(F.trunc("sale_date", "month"), "yyyy-MM-dd").alias("month")
    cells = (fact.select("customer_id", *columns, month, "amount").groupBy("customer_id", *columns, "month")
             .agg(F.sum("amount").alias("amount")))
    cells = cells.join(numbers, "customer_id", "left").withColumn("total", F.lit(""))
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS]))
    rows = cells.select("number", "amount", each.alias("g")).select("g.dimension", "g.value", "number", "amount")
    pairs = (rows.where(F.col("value").isNotNull()).groupBy("dimension", "value", "number")
             .agg(F.sum("amount").alias("amount"))
             .withColumn("bucket", F.coalesce(F.floor((F.col("number") - 1) / BUCKET) + 1, F.lit(0)).cast("long")))
    # rows of a pair are dealt before they become bitmaps: a bitmap under construction has the size of 32,768 numbers
    return pairs.repartition("dimension", "value", "bucket").groupBy("dimension", "value", "bucket").agg(
        _short(F.bitmap_construct_agg(F.pmod(F.col("number") - 1, F.lit(BUCKET)))).alias("customers"),
        F.sum("amount").alias("amount"))


def _short(bitmap):
    """The part of a bitmap that a bucket uses."""
    return F.substring(bitmap, 1, BUCKET // 8)


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all the sales of several states (each sale in one of them)."""
    out = states[0]
    for state in states[1:]:
        out = out.unionByName(state)
    return out.repartition("dimension", "value", "bucket").groupBy("dimension", "value", "bucket").agg(
        _short(F.bitmap_or_agg("customers")).alias("customers"), F.sum("amount").alias("amount"))


def coverage(state: DataFrame) -> DataFrame:
    """dimension, value, customers, amount: distinct customers and amount of every group of the state."""
    return (state.groupBy("dimension", "value").agg(
        F.sum(F.when(F.col("bucket") > 0, F.bitmap_count("customers")).otherwise(0)).alias("customers"),
        F.sum("amount").alias("_a")).select("dimension", "value", "customers", money("_a").alias("amount")))
