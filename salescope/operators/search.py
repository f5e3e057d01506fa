"""Substring search over the customer report through an index of character trigrams (F2).

The index holds, per trigram of the lower-cased search columns, the customers
whose row has it, sorted by trigram, so a search reads a few row groups of the
index instead of every customer row. A term's rows have all its trigrams;
those that have are looked up and verified by ``contains``. Terms of fewer than
three characters have no trigram and scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .customers import SEARCH_COLUMNS, customer_search

GRAM = 3
RARE_GRAMS = 3                  # trigrams of a term that are looked up: those with the fewest customers


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a text column, an empty array for shorter texts."""
    n = F.length(text) - (GRAM - 1)
    return F.array_distinct(F.when(n > 0, F.transform(
        F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>")))


class SearchIndex:
    """A customer report and its trigram index in a folder of the shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, detail: DataFrame) -> "SearchIndex":
        """Writes the report by customer and the index by trigram."""
        detail.drop("_gram").repartitionByRange("customer_id").sortWithinPartitions("customer_id").write.mode(
            "overwrite").parquet(f"{self.path}/customers")
        rows = self.customers()
        cells = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in SEARCH_COLUMNS]
        grams = rows.select("customer_id", F.explode(F.array_distinct(F.flatten(F.array(
            *[trigrams(c) for c in cells])))).alias("gram"))
        counts = grams.groupBy("gram").agg(F.count("*").alias("customers"))
        # a frequent trigram spans several files; every file holds a narrow range of trigrams
        grams.repartitionByRange("gram", "customer_id").sortWithinPartitions("gram", "customer_id").write.mode(
            "overwrite").parquet(f"{self.path}/grams")
        counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{self.path}/counts")
        return self

    def customers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/customers")

    def search(self, query: str) -> DataFrame:
        """the same rows as ``customer_search`` over the whole report."""
        term = (query or "").strip().lower()
        if len(term) < GRAM:
            return customer_search(self.customers(), term)
        wanted = sorted({term[k:k + GRAM] for k in range(len(term) - GRAM + 1)})
        counts = {r["gram"]: r["customers"] for r in
                  self.spark.read.parquet(f"{self.path}/counts").where(F.col("gram").isin(wanted)).collect()}
        if len(counts) < len(wanted):                     # a trigram that no row has
            return self.customers().limit(0)
        rare = sorted(wanted, key=lambda g: (counts[g], g))[:RARE_GRAMS]
        grams = self.spark.read.parquet(f"{self.path}/grams").where(F.col("gram").isin(rare))
        found = grams.groupBy("customer_id").agg(F.count("*").alias("n")).where(F.col("n") == len(rare))
        return customer_search(self.customers().join(found.select("customer_id"), "customer_id", "left_semi"), term)
