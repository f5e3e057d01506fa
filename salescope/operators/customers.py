"""Customer reports: lifecycle, detail, RFM, top product, modes, search and sort."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.numeric import money, ratio
from .ingest import crowded
from .reports import argmax_labels


MODES = ("customer_name", "region", "channel", "seller")


def latest_date(fact: DataFrame):
    """The latest sale date of the data (reference date), as a scalar subquery."""
    return fact.agg(F.max("sale_date").alias("d")).scalar()


def _per_customer_days(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("customer_id").isNotNull())
                .groupBy("customer_id")
                .agg(F.min("sale_date").alias("first"), F.max("sale_date").alias("last"),
                     F.countDistinct("sale_date").alias("days")))


def customer_lifecycle(fact: DataFrame) -> DataFrame:
    """A10: total, new (first purchase within 7 days of the latest date,
    inclusive), recurring (>1 day), one-time (1 day), inactive (>30 days)."""
    ref = latest_date(fact)
    c = _per_customer_days(fact)
    return c.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.datediff(ref, F.col("first")) <= S.NEW_CUSTOMER_DAYS).alias("new_7d"),
        F.count_if(F.col("days") > 1).alias("recurring"),
        F.count_if(F.col("days") == 1).alias("one_time"),
        F.count_if(F.datediff(ref, F.col("last")) > S.INACTIVE_CUSTOMER_DAYS).alias("inactive_30d"),
    )


def mode_per_customer(fact: DataFrame) -> DataFrame:
    """Per customer, the most frequent name, region, channel and seller;
    ties go to the smallest value, no value gives ``""``.

    Rows are counted per (customer, value) for the four columns at once, which
    combines map-side, so neither a hot customer's rows nor a buffer of all its
    values meet in one task; the largest count per customer is kept after.
    """
    best = argmax_labels(fact, "customer_id", {c: c for c in MODES}, F.count(F.lit(1)))
    return best.select("customer_id", *[F.coalesce(c, F.lit("")).alias(c) for c in MODES])


def top_product_per_customer(fact: DataFrame) -> DataFrame:
    """Per customer, the product (canonical name) with the largest amount
    and that amount; ties go to the smallest name."""
    per = (fact.where(F.col("customer_id").isNotNull() & F.col("product_canon").isNotNull())
               .groupBy("customer_id", "product_canon").agg(F.sum("amount").alias("_v")))
    best = per.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("_v")).alias("nv"), F.col("product_canon").alias("p"))).alias("_m"))
    return best.select("customer_id", F.col("_m.p").alias("top_product"),
                       money(-F.col("_m.nv")).alias("top_product_amount"))


def customer_detail(fact: DataFrame) -> DataFrame:
    """One row per customer with modes, totals, first/last purchase,
    recency, ticket per transaction and top product; descending by amount.

    The rows of a customer meet in one partition, once for the totals, distinct
    counts and modes and once for the top product, and are counted there: no
    count is shuffled again. Customers with very many rows go by aggregates that
    combine before each shuffle (totals with distinct counts, modes, top product).
    """
    base = fact.where(F.col("customer_id").isNotNull())
    many, _ = crowded(base, "customer_id")
    out = _detail_met(base if many is None else base.where(~many))
    if many is not None:
        out = out.unionByName(_detail_combined(base.where(many)))
    return out.select(
        "customer_id", *[F.coalesce(c, F.lit("")).alias(c) for c in MODES],
        money("_a").alias("amount"), "units", "transactions", "active_days", "products",
        "first_purchase", "last_purchase",
        F.datediff(latest_date(fact), F.col("last_purchase")).cast("bigint").alias("recency_days"),
        ratio(money("_a"), "transactions").alias("ticket"), "top_product", "top_product_amount",
    ).orderBy(F.desc("amount"), "customer_id")


def _totals() -> list[Column]:
    return [F.sum("amount").alias("_a"), F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("transactions"),
            F.min("sale_date").alias("first_purchase"), F.max("sale_date").alias("last_purchase")]


def _detail_met(base: DataFrame) -> DataFrame:
    """Totals, modes and top product of customers whose rows fit into one task."""
    g = base.repartition("customer_id").groupBy("customer_id").agg(
        *_totals(), F.size(F.collect_set("sale_date")).cast("bigint").alias("active_days"),
        F.size(F.collect_set("product_code")).cast("bigint").alias("products"),
        *[F.mode(c, True).alias(c) for c in MODES])
    return g.join(top_product_per_customer(base.repartition("customer_id")), "customer_id", "left")


def _detail_combined(base: DataFrame) -> DataFrame:
    """The same, combined before every shuffle."""
    g = base.groupBy("customer_id").agg(*_totals(), F.countDistinct("sale_date").alias("active_days"),
                                        F.countDistinct("product_code").alias("products"))
    return (g.join(mode_per_customer(base), "customer_id")
             .join(top_product_per_customer(base), "customer_id", "left"))


def rfm(fact: DataFrame) -> DataFrame:
    """Recency (days since the customer's last purchase, relative to the
    latest date), frequency (distinct days) and monetary value per customer."""
    ref = latest_date(fact)
    g = (fact.where(F.col("customer_id").isNotNull())
             .groupBy("customer_id")
             .agg(F.max("sale_date").alias("_last"), F.countDistinct("sale_date").alias("frequency"),
                  F.sum("amount").alias("_a")))
    return g.select("customer_id", F.datediff(ref, F.col("_last")).cast("bigint").alias("recency"),
                    "frequency", money("_a").alias("monetary"))


SEARCH_COLUMNS = ["customer_id", "customer_name", "region", "channel", "seller", "top_product"]


def customer_search(detail: DataFrame, query: str) -> DataFrame:
    """case-insensitive substring match on any of six columns (a plain
    ``contains``, not a LIKE pattern); an empty query keeps every row."""
    q = (query or "").strip().lower()
    if not q:
        return detail
    cond = None
    for c in SEARCH_COLUMNS:
        hit = F.coalesce(F.lower(F.col(c)), F.lit("")).contains(F.lit(q))
        cond = hit if cond is None else (cond | hit)
    return detail.where(cond)


def customer_sort(detail: DataFrame, by: str = "amount",
                  limit: int | None = S.CUSTOMER_LIST_ROWS) -> DataFrame:
    """L3 + L2: sort by an allowed column (recency ascending, the others
    descending, customer id breaks ties) and keep the first ``limit`` rows."""
    if by not in S.CUSTOMER_SORT_COLUMNS:
        raise ValueError(f"sort column must be one of {S.CUSTOMER_SORT_COLUMNS}")
    key = F.asc(by) if by == "recency_days" else F.desc(by)
    out = detail.orderBy(key, "customer_id")
    return out.limit(limit) if limit else out


def customer_list(fact: DataFrame, query: str = "", by: str = "amount",
                  limit: int | None = S.CUSTOMER_LIST_ROWS) -> DataFrame:
    """F2 + L3 + L2 on the customer report: what the customer table shows."""
    return customer_sort(customer_search(customer_detail(fact), query), by, limit)
