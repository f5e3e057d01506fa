"""Time buckets over the fact: daily, weekly (Monday start), monthly series,
their summary, the day index and the trailing mean."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S
from ..functions.numeric import count_or_zero, half_up, money, ratio


def _series(fact: DataFrame, bucket: Column) -> DataFrame:
    return (fact.where(F.col("sale_date").isNotNull())
                .groupBy(bucket.alias("period"))
                .agg(F.sum("amount").alias("_a"), F.sum("quantity").alias("units"),
                     F.count(F.lit(1)).alias("transactions"),
                     F.countDistinct("customer_id").alias("customers"))
                .select("period", money("_a").alias("amount"), "units", "transactions",
                        "customers")
                .orderBy("period"))


def week_start(col: str | Column = "sale_date") -> Column:
    """Monday of the week (weeks end on Sunday)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.date_trunc("week", c))


def month_start(col: str | Column = "sale_date") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.trunc(c, "month")


def daily_sales(fact: DataFrame) -> DataFrame:
    """Per date, ascending."""
    return _series(fact, F.col("sale_date"))


def weekly_sales(fact: DataFrame) -> DataFrame:
    """Per week, labelled by its Monday."""
    return _series(fact, week_start())


def monthly_sales(fact: DataFrame) -> DataFrame:
    """Per month start."""
    return _series(fact, month_start())


def series_summary(fact: DataFrame) -> DataFrame:
    """For each granularity, number of periods, total, mean per period,
    units and transactions; one scan of the fact."""
    g = fact.where(F.col("sale_date").isNotNull()).agg(
        F.sum("amount").alias("_a"), F.sum("quantity").alias("_q"),
        F.count(F.lit(1)).alias("_n"),
        F.countDistinct("sale_date").alias("day"),
        F.countDistinct(week_start()).alias("week"),
        F.countDistinct(month_start()).alias("month"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("granularity"), F.col(name).alias("periods"))
        for name in ("day", "week", "month")]))
    return (g.select(rows.alias("r"), "_a", "_q", "_n")
             .select(F.col("r.granularity").alias("granularity"),
                     F.col("r.periods").alias("periods"),
                     money("_a").alias("total_amount"),
                     F.when(F.col("r.periods") > 0, ratio(money("_a"), "r.periods"))
                      .otherwise(F.lit(0.0)).alias("mean_amount"),
                     count_or_zero("_q").alias("units"),
                     F.col("_n").alias("transactions")))


def daily_xy(fact: DataFrame) -> DataFrame:
    """The daily series with its ordinal ``day_index`` (0-based) and the
    amount as double.

    The global row_number runs on the daily aggregate, whose size is the
    number of selling days (bounded by the calendar span, not by the number
    of sales), so ordering it in one partition is a bounded step.
    """
    d = (fact.where(F.col("sale_date").isNotNull())
             .groupBy("sale_date").agg(F.sum("amount").alias("_a")))
    return d.select("sale_date",
                    (F.row_number().over(Window.orderBy("sale_date")) - 1).cast("bigint").alias("day_index"),
                    F.col("_a").cast("double").alias("amount"))


def day_index(fact: DataFrame) -> DataFrame:
    """W3 as a report."""
    return daily_xy(fact)


def trailing_mean(xy: DataFrame, rows: int = S.TRAILING_MEAN_ROWS) -> Column:
    """Mean amount of the last ``rows`` days, as a scalar subquery."""
    return (xy.orderBy(F.desc("sale_date")).limit(rows)
              .agg(F.avg("amount").alias("m")).scalar())


def trailing_mean_7(fact: DataFrame) -> DataFrame:
    """W4 as a one-row report (NULL without sales)."""
    xy = daily_xy(fact)
    last7 = xy.orderBy(F.desc("sale_date")).limit(S.TRAILING_MEAN_ROWS)
    return last7.agg(F.count(F.lit(1)).alias("days"),
                     half_up(F.avg("amount")).alias("moving_avg_7d"))


def peak_period(fact: DataFrame, granularity: str = "day") -> DataFrame:
    """The period with the largest amount, earliest on ties (top-1 report)."""
    bucket = {"day": F.col("sale_date"), "week": week_start(), "month": month_start()}[granularity]
    g = (fact.where(F.col("sale_date").isNotNull()).groupBy(bucket.alias("period"))
             .agg(F.sum("amount").alias("_a"), F.sum("quantity").alias("units")))
    return (g.orderBy(F.desc("_a"), "period").limit(1)
             .select(F.lit(granularity).alias("granularity"), "period",
                     money("_a").alias("amount"), "units"))
