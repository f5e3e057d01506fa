"""The consolidated sales fact: built from the given tables, written once, read back.

``lineitem_sales`` maps the order tables onto the standard columns:
``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ supplier ⋈ part`` (inner equi
joins on their keys). The fact is that table run through the same
consolidation as any raw source (clean, dedup, canonical names), written as
Parquet to the shared checkpoint folder, and every report reads it back
with column pruning, so each report scans only the columns it uses.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import expressions as E
from ..operators import ingest
from ..operators.joins import bounded_broadcast
from .materialize import materialized, written
from .tables import read_table

LINEITEM_SOURCE = "lineitem"
SUPPLIER_ROWS = 500_000        # a key and a name each: some 30 MB in a task's memory


def lineitem_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard columns from the order tables (one row per line item).

    Join order keeps the big side narrow while it is shuffled: the line items
    meet part and supplier (sent to the tasks after a size check) as keys and
    numbers, and the customer's texts, joined to the orders before, come last,
    so the wide rows leave the joins without another shuffle.
    """
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = (read_table(spark, sf_dir, "customer")
                .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
                .join(bounded_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    orders = (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
              .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.col("l_quantity").try_cast("bigint").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = (lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
                   .join(bounded_broadcast(supplier, SUPPLIER_ROWS), F.col("l_suppkey") == F.col("s_suppkey"))
                   .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    return joined.select(
        E.normalize_text("c_name").alias("customer_name"),
        E.normalize_id(F.col("c_custkey").cast("string")).alias("customer_id"),
        E.normalize_upper("n_name").alias("region"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("sale_date"),
        F.col("p_partkey").cast("string").alias("product_code"),
        E.normalize_text("p_name").alias("product_name"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        E.normalize_upper("c_mktsegment").alias("channel"),
        F.col("s_name").alias("seller"),
        F.lit(LINEITEM_SOURCE).alias("source_file"),
        (F.col("l_orderkey") * F.lit(16) + F.col("l_linenumber")).cast("bigint").alias("_row_no"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ingest.Keep]:
    """The joined rows, which are written once, and what writes the lookups made from them."""
    key = sf_dir.rstrip("/")

    def keep(name: str, df: DataFrame) -> DataFrame:
        return materialized(spark, f"fact-{name}", key, lambda: df)

    return materialized(spark, "fact-lines", key, lambda: ingest.clean(
        ingest.union_sources([lineitem_sales(spark, sf_dir)]))), keep


def build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a plan over the joined rows, which are written once: the search for
    repeated keys, the names and the rows all read them, so the joins run once."""
    joined, keep = _lines(spark, sf_dir)
    unique = ingest.dedup_mostly_unique(joined, keep)
    return ingest.finalize(ingest.canonical_name(unique, keep))


def write_fact(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """K1: the fact table as Parquet (optionally partitioned)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Read a consolidated fact table."""
    return spark.read.parquet(path)


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact for ``sf_dir``, built and written once per application.

    The joined rows live in the shared checkpoint folder (a written table cuts
    the lineage of the five joins), so a lost executor only recomputes from
    Parquet, and every report reads pruned columns. Where no key repeats and
    every code has one name, they are the fact but for the last columns, which
    are computed as they are read: the rows are not written a second time.
    """
    there = written(spark, "fact", sf_dir.rstrip("/"))
    if there is not None:
        return there
    joined, keep = _lines(spark, sf_dir)
    if ingest.repeated_keys(joined, keep).isEmpty() and keep("names", ingest.differing_names(joined)).isEmpty():
        return ingest.finalize(joined.withColumn("product_canon", F.col("product_name")))
    return materialized(spark, "fact", sf_dir.rstrip("/"), lambda: build_fact(spark, sf_dir))
