"""Stock cover from a real stock table.

Velocity per SKU comes from the fact; the stock table gives units on hand
per product code. Cover = units / average daily units sold; status bands
CRITICO < 15 <= BAIXO < 30 <= OK < 60 <= ALTO; no sales means cover 999.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions.numeric import half_up, money


def observed_days(fact: DataFrame) -> Column:
    """Days from the first to the last sale, inclusive (at least 1), as a scalar subquery."""
    return fact.agg(F.greatest(F.datediff(F.max("sale_date"), F.min("sale_date")) + 1,
                               F.lit(1)).alias("d")).scalar()


def sku_velocity(fact: DataFrame) -> DataFrame:
    """Per (code, canonical name): units and amount sold, unit price and
    average daily units over the observed span of the data."""
    days = observed_days(fact)
    g = (fact.where(F.col("product_code").isNotNull())
             .groupBy("product_code", "product_canon")
             .agg(F.sum("quantity").alias("units_sold"), F.sum("amount").alias("_a")))
    return g.select(
        "product_code", "product_canon", "units_sold", money("_a").alias("amount_sold"),
        F.when(F.col("units_sold") > 0, money("_a") / F.col("units_sold").cast("double"))
         .alias("unit_price"),
        (F.col("units_sold").cast("double") / F.coalesce(days, F.lit(1)).cast("double"))
         .alias("avg_daily_units"))


def status_of(cover: Column) -> Column:
    out = None
    for limit, label in S.STOCK_STATUS_BANDS:
        out = F.when(cover < limit, F.lit(label)) if out is None else out.when(cover < limit, F.lit(label))
    return out.otherwise(F.lit(S.STOCK_STATUS_TOP))


def stock_status(fact: DataFrame, stock: DataFrame) -> DataFrame:
    """M4: every SKU that was sold or is in stock, with stock value, cover
    days (1 decimal) and status; descending by stock value. Stock rows of one
    code (several warehouses) are summed first."""
    v = sku_velocity(fact)
    held = stock.groupBy("product_code").agg(F.sum("units").alias("_stock"))
    j = v.join(held, "product_code", "full")
    units = F.coalesce(F.col("_stock"), F.lit(0)).cast("bigint")
    daily = F.coalesce(F.col("avg_daily_units"), F.lit(0.0))
    cover = F.when(daily > 0, units.cast("double") / daily)
    out = j.select(
        "product_code", "product_canon",
        F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold"),
        F.coalesce("amount_sold", F.lit(0.0)).alias("amount_sold"),
        half_up("unit_price").alias("unit_price"),
        half_up(daily, 4).alias("avg_daily_units"),
        units.alias("units_in_stock"),
        half_up(units.cast("double") * F.coalesce(F.col("unit_price"), F.lit(0.0)))
         .alias("stock_value"),
        F.coalesce(half_up(cover, 1), F.lit(S.NO_SALES_COVER_DAYS)).alias("cover_days"),
        F.when(cover.isNull(), F.lit(S.STOCK_STATUS_TOP)).otherwise(status_of(cover)).alias("status"),
    )
    return out.orderBy(F.desc("stock_value"), "product_code")


def stock_summary(status: DataFrame) -> DataFrame:
    """Totals over all SKUs, count and value per status, mean cover of
    the SKUs that sell (999 left out)."""
    aggs = [F.coalesce(F.sum("units_in_stock"), F.lit(0)).cast("bigint").alias("units_total"),
            half_up(F.coalesce(F.sum("stock_value"), F.lit(0.0))).alias("value_total"),
            F.count(F.lit(1)).alias("skus")]
    for _, label in S.STOCK_STATUS_BANDS + [(None, S.STOCK_STATUS_TOP)]:
        is_label = F.col("status") == label
        aggs.append(F.count_if(is_label).alias(f"count_{label.lower()}"))
        aggs.append(half_up(F.coalesce(F.sum(F.when(is_label, F.col("stock_value"))), F.lit(0.0)))
                    .alias(f"value_{label.lower()}"))
    aggs.append(half_up(F.avg(F.when(F.col("cover_days") < S.NO_SALES_COVER_DAYS,
                                     F.col("cover_days"))), 1).alias("mean_cover_days"))
    return status.agg(*aggs)
