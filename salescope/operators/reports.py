"""Group reports over the fact: KPIs, seller / channel / region / product tables,
coverage tables and highlights.

Every report is one or a few ``groupBy().agg()`` over pruned fact columns.
Sums run on ``decimal(18,2)`` (exact), ratios are computed as double from the
exact sums and rounded last. Grand totals enter as scalar subqueries, never
as a window over the whole table and never through the driver.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S
from ..functions.numeric import count_or_zero, half_up, money, ratio, share_pct


def _n() -> Column:
    return F.count(F.lit(1))


def total_amount(fact: DataFrame) -> Column:
    """The grand total of amount as a scalar subquery (exact decimal)."""
    return fact.agg(F.sum("amount").alias("t")).scalar()


def argmax_labels(fact: DataFrame, key: str, labels: dict[str, str],
                  value: Column | None = None) -> DataFrame:
    """W2 for several labels in one scan: per ``key``, for each ``label`` the
    value with the largest aggregate ``value`` (default: the summed amount;
    ties: smallest label), as column ``labels[label]``.

    One grouping-sets aggregation sums per (key, label) for every label at
    once, then one aggregation per key keeps ``min(struct(-sum, label))`` for
    each set; both steps combine map-side.
    """
    names = list(labels)
    sets = [[F.col(key), F.col(lbl)] for lbl in names]
    per = (fact.where(F.col(key).isNotNull())
               .groupingSets(sets, key, *names)
               .agg((F.sum("amount") if value is None else value).alias("_v"),
                    F.grouping_id().alias("_gid")))
    n = len(names)
    best = []
    for i, lbl in enumerate(names):
        # grouping_id has a 1 bit for every label column left out of the set
        gid = sum(1 << (n - 1 - j) for j in range(n) if j != i)
        pick = F.when((F.col("_gid") == gid) & F.col(lbl).isNotNull(),
                      F.struct((-F.col("_v")).alias("nv"), F.col(lbl).alias("lbl")))
        best.append(F.min(pick)["lbl"].alias(labels[lbl]))
    return per.groupBy(key).agg(*best)


def kpis(fact: DataFrame) -> DataFrame:
    """A1: sixteen global metrics in one row."""
    g = fact.agg(
        F.sum("amount").alias("_a"), F.sum("quantity").alias("_q"), _n().alias("_n"),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("product_code").alias("products"),
        F.countDistinct("seller").alias("sellers"),
        F.countDistinct("channel").alias("channels"),
        F.countDistinct("region").alias("regions"),
        F.countDistinct("sale_date").alias("active_days"),
    )
    a, q, n, days = money("_a"), count_or_zero("_q"), F.col("_n"), F.col("active_days")
    return g.select(
        a.alias("total_amount"), q.alias("units"),
        ratio(a, "customers").alias("ticket_customer"),
        ratio(a, n).alias("ticket_tx"),
        ratio(a, q).alias("unit_price"),
        ratio(q, n).alias("units_per_tx"),
        "customers", "products", "sellers", "channels", "regions",
        n.alias("transactions"), "active_days",
        ratio(a, days).alias("amount_per_day"),
        ratio(q, days).alias("units_per_day"),
        ratio(n, days).alias("tx_per_day"),
    )


def _group(fact: DataFrame, key: str, distinct: dict[str, str]) -> DataFrame:
    """Sums and distinct counts per ``key``; each count has an aggregate of its own, which shuffles pairs of two columns
    instead of a row of all columns a count."""
    groups = fact.where(F.col(key).isNotNull()).groupBy(key)
    out = groups.agg(F.sum("amount").alias("_a"), F.sum("quantity").alias("units"), _n().alias("transactions"))
    for name, c in distinct.items():
        out = out.join(groups.agg(F.countDistinct(c).alias(name)), key)
    return out


def by_seller(fact: DataFrame) -> DataFrame:
    """A2: per seller, with share of the grand total and its best channel,
    region and product."""
    g = _group(fact, "seller", {"customers": "customer_id", "active_days": "sale_date",
                                "products": "product_code", "regions": "region",
                                "channels": "channel"})
    out = g.select(
        "seller", money("_a").alias("amount"), "units", "customers", "transactions",
        "active_days", "products", "regions", "channels",
        ratio(money("_a"), "customers").alias("ticket"),
        ratio(money("_a"), "transactions").alias("ticket_tx"),
        ratio(money("_a"), "units").alias("unit_price"),
        share_pct("_a", total_amount(fact)).alias("share_pct"),
    )
    best = argmax_labels(fact, "seller", {"channel": "best_channel", "region": "best_region",
                                          "product_canon": "best_product"})
    return out.join(best, "seller", "left").orderBy(F.desc("amount"), "seller")


def by_channel(fact: DataFrame) -> DataFrame:
    """A3: per channel."""
    g = _group(fact, "channel", {"customers": "customer_id", "sellers": "seller",
                                 "products": "product_code", "regions": "region"})
    return g.select(
        "channel", money("_a").alias("amount"), "units", "customers", "transactions",
        "sellers", "products", "regions",
        ratio(money("_a"), "customers").alias("ticket"),
        ratio(money("_a"), "units").alias("unit_price"),
        share_pct("_a", total_amount(fact)).alias("share_pct"),
    ).orderBy(F.desc("amount"), "channel")


def by_region(fact: DataFrame) -> DataFrame:
    """A4: per region."""
    g = _group(fact, "region", {"customers": "customer_id", "sellers": "seller",
                                "products": "product_code"})
    return g.select(
        "region", money("_a").alias("amount"), "units", "customers", "transactions",
        "sellers", "products",
        ratio(money("_a"), "customers").alias("ticket"),
        ratio(money("_a"), "units").alias("unit_price"),
        share_pct("_a", total_amount(fact)).alias("share_pct"),
    ).orderBy(F.desc("amount"), "region")


def _products(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("product_code").isNotNull() & F.col("product_canon").isNotNull())


def product_table(fact: DataFrame, total: Column | None = None) -> DataFrame:
    """Per (code, canonical name): all product metrics, unsorted (``total``: the amount
    that shares are of; by default that of ``fact``)."""
    g = (_products(fact)
             .groupBy("product_code", "product_canon")
             .agg(F.sum("amount").alias("_a"), F.sum("quantity").alias("units"),
                  F.countDistinct("customer_id").alias("customers"), _n().alias("transactions"),
                  F.countDistinct("region").alias("regions"),
                  F.countDistinct("seller").alias("sellers"),
                  F.countDistinct("channel").alias("channels")))
    return g.select(
        "product_code", "product_canon", money("_a").alias("amount"), "units", "customers",
        "transactions", "regions", "sellers", "channels",
        ratio(money("_a"), "units").alias("unit_price"),
        share_pct("_a", total_amount(fact) if total is None else total).alias("share_pct"),
    )


def top_products(fact: DataFrame, n: int = S.TOP_PRODUCTS) -> DataFrame:
    """A5 + L2: the ``n`` products with the largest amount (a top-k report).

    The amounts of all products decide which they are; the distinct counts, which
    shuffle every row once a count, are then made for the rows of those alone.
    """
    def top(products: DataFrame) -> DataFrame:
        return products.orderBy(F.desc("amount"), "product_code", "product_canon").limit(n)

    key = ["product_code", "product_canon"]
    first = top(_products(fact).groupBy(*key).agg(money(F.sum("amount")).alias("amount"))).select(*key)
    return top(product_table(fact.join(F.broadcast(first), key, "left_semi"), total_amount(fact)))


def product_rank(fact: DataFrame, n: int = S.TOP_PRODUCTS) -> DataFrame:
    """The product list with its row position (1-based). The position is
    numbered on the top-``n`` list only, so the window sees ``n`` rows."""
    top = top_products(fact, n)
    order = Window.orderBy(F.desc("amount"), "product_code", "product_canon")
    return top.select(F.row_number().over(order).cast("bigint").alias("rank"), "product_code", "product_canon",
                      "amount", "share_pct")


def seller_coverage(fact: DataFrame) -> DataFrame:
    """Active customers per seller and their share of all customers."""
    all_customers = fact.agg(F.countDistinct("customer_id").alias("c")).scalar()
    g = _group(fact, "seller", {"active_customers": "customer_id", "active_days": "sale_date",
                                "regions": "region", "products": "product_code"})
    return g.select(
        "seller", "active_customers", "active_days", money("_a").alias("amount"), "units",
        "transactions", "regions", "products",
        ratio(money("_a"), "active_customers").alias("amount_per_customer"),
        ratio("units", "active_customers").alias("units_per_customer"),
        ratio("transactions", "active_customers").alias("tx_per_customer"),
        half_up(F.lit(100.0) * F.col("active_customers").cast("double")
                / F.greatest(all_customers, F.lit(1)).cast("double")).alias("portfolio_share_pct"),
    ).orderBy(F.desc("active_customers"), "seller")


def _coverage(fact: DataFrame, key: Column, name: str) -> DataFrame:
    return (fact.where(key.isNotNull())
                .groupBy(key.alias(name))
                .agg(F.countDistinct("customer_id").alias("customers"),
                     F.sum("amount").alias("_a"))
                .select(name, "customers", money("_a").alias("amount")))


def coverage_by_region(fact: DataFrame) -> DataFrame:
    """A7."""
    return _coverage(fact, F.col("region"), "region").orderBy(F.desc("customers"), "region")


def coverage_by_channel(fact: DataFrame) -> DataFrame:
    """A8."""
    return _coverage(fact, F.col("channel"), "channel").orderBy(F.desc("customers"), "channel")


def coverage_by_month(fact: DataFrame) -> DataFrame:
    """Per month start, ascending."""
    month = F.trunc("sale_date", "month")
    return _coverage(fact, month, "month").orderBy("month")


def _best(grouped: DataFrame, label: str, value: str = "_v") -> Column:
    """Scalar subquery: struct(label, value) of the largest value, smallest label on ties."""
    return (grouped.agg(F.min(F.struct((-F.col(value)).alias("nv"), F.col(label).alias("lbl")))
                        .alias("m"))
                   .select(F.struct(F.col("m.lbl").alias("label"),
                                    (-F.col("m.nv")).alias("value")).alias("s"))
                   .scalar())


def _peak(fact: DataFrame, bucket: Column) -> Column:
    """Scalar subquery: the period with the largest amount, earliest on ties."""
    g = (fact.groupBy(bucket.alias("period"))
             .agg(F.sum("amount").alias("_v"), F.sum("quantity").alias("_q")))
    return (g.agg(F.min(F.struct((-F.col("_v")).alias("nv"), F.col("period").alias("p"),
                                 F.col("_q").alias("q"))).alias("m"))
             .select(F.struct(F.col("m.p").alias("period"), (-F.col("m.nv")).alias("value"),
                              F.col("m.q").alias("units")).alias("s"))
             .scalar())


def _sum_by(fact: DataFrame, key: str) -> DataFrame:
    return fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("amount").alias("_v"))


def _top_sum(grouped: DataFrame, label: str, n: int) -> Column:
    return (grouped.orderBy(F.desc("_v"), label).limit(n)
                   .agg(F.sum("_v").alias("t")).scalar())


def highlights(fact: DataFrame) -> DataFrame:
    """A12 + W6: peak day / week / month, best seller / product / channel / region,
    top-10 concentration and top-1 shares, in one row.

    Each part is a small aggregate attached as a scalar subquery.
    """
    total = fact.agg(F.sum("amount").alias("t"))
    sellers, products = _sum_by(fact, "seller"), _sum_by(fact, "product_canon")
    channels, regions = _sum_by(fact, "channel"), _sum_by(fact, "region")
    customers = _sum_by(fact, "customer_id")
    day = _peak(fact, F.col("sale_date"))
    week = _peak(fact, F.to_date(F.date_trunc("week", "sale_date")))
    month = _peak(fact, F.trunc("sale_date", "month"))
    bs, bp = _best(sellers, "seller"), _best(products, "product_canon")
    bc, br = _best(channels, "channel"), _best(regions, "region")
    t = F.col("t")
    return total.select(
        day["period"].alias("best_day"), money(day["value"]).alias("best_day_amount"),
        count_or_zero(day["units"]).alias("best_day_units"),
        week["period"].alias("best_week"), money(week["value"]).alias("best_week_amount"),
        count_or_zero(week["units"]).alias("best_week_units"),
        month["period"].alias("best_month"), money(month["value"]).alias("best_month_amount"),
        count_or_zero(month["units"]).alias("best_month_units"),
        bs["label"].alias("best_seller"), money(bs["value"]).alias("best_seller_amount"),
        bp["label"].alias("best_product"), money(bp["value"]).alias("best_product_amount"),
        bc["label"].alias("best_channel"), money(bc["value"]).alias("best_channel_amount"),
        br["label"].alias("best_region"), money(br["value"]).alias("best_region_amount"),
        share_pct(F.coalesce(_top_sum(products, "product_canon", S.CONCENTRATION_TOP),
                             F.lit(0)), t).alias("top10_products_pct"),
        share_pct(F.coalesce(_top_sum(customers, "customer_id", S.CONCENTRATION_TOP),
                             F.lit(0)), t).alias("top10_customers_pct"),
        share_pct(F.coalesce(bs["value"], F.lit(0)), t).alias("top1_seller_pct"),
        share_pct(F.coalesce(bc["value"], F.lit(0)), t).alias("top1_channel_pct"),
        share_pct(F.coalesce(br["value"], F.lit(0)), t).alias("top1_region_pct"),
    )


def argmax_per_seller(fact: DataFrame) -> DataFrame:
    """W2 on its own: best channel, region and product per seller."""
    return argmax_labels(fact, "seller", {"channel": "best_channel", "region": "best_region",
                                          "product_canon": "best_product"})


def basic_group_reports(fact: DataFrame) -> dict[str, DataFrame]:
    """The four small reports (seller with customers, channel, region, day)."""
    def sums(key: str, extra: list[Column] | None = None) -> DataFrame:
        return (fact.where(F.col(key).isNotNull()).groupBy(key)
                    .agg(F.sum("amount").alias("_a"), F.sum("quantity").alias("units"),
                         *(extra or []))
                    .withColumn("amount", money("_a")).drop("_a"))
    return {
        "seller": sums("seller", [F.countDistinct("customer_id").alias("customers")])
                  .orderBy(F.desc("amount"), "seller"),
        "channel": sums("channel"),
        "region": sums("region"),
        "day": sums("sale_date").orderBy("sale_date"),
    }
