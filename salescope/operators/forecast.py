"""Linear sales forecast on the daily series.

Least squares of the daily amount on the ordinal of selling days, fitted
with the SQL regression aggregates (``regr_slope``, ``regr_intercept``,
``regr_r2``). The horizon rows are consecutive calendar days after the last
sale date, generated with ``explode(sequence(1, h))`` from the one-row fit.
A series of fewer than 2 days has no forecast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions.numeric import half_up
from .timeseries import daily_xy, trailing_mean


def fit(fact: DataFrame) -> DataFrame:
    """One row: n, last date, slope, intercept, r2, residual sigma (population),
    mae, mape (nonzero days only) and the trailing 7-day mean. Empty if n < 2."""
    xy = daily_xy(fact)
    line = xy.agg(F.count(F.lit(1)).alias("n"), F.max("sale_date").alias("last_date"),
                  F.regr_slope("amount", "day_index").alias("slope"),
                  F.regr_intercept("amount", "day_index").alias("intercept"),
                  F.regr_r2("amount", "day_index").alias("r2"))
    slope = xy.agg(F.regr_slope("amount", "day_index")).scalar()
    intercept = xy.agg(F.regr_intercept("amount", "day_index")).scalar()
    resid = xy.select("amount", (F.col("amount") - (intercept + slope * F.col("day_index")))
                      .alias("r"))
    stats = resid.agg(
        F.struct(F.stddev_pop("r").alias("sigma"), F.avg(F.abs("r")).alias("mae"),
                 F.avg(F.when(F.col("amount") != 0, F.abs(F.col("r") / F.col("amount"))))
                  .alias("mape")).alias("s")).scalar()
    return (line.where(F.col("n") >= 2)
                .select("n", "last_date", "slope", "intercept",
                        F.coalesce("r2", F.lit(1.0)).alias("r2"),
                        stats["sigma"].alias("sigma"), stats["mae"].alias("mae"),
                        F.coalesce(stats["mape"] * F.lit(100.0), F.lit(0.0)).alias("mape"),
                        trailing_mean(xy).alias("moving_avg_7d")))


def _horizon(params: DataFrame, horizon: int) -> DataFrame:
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    rows = params.select("*", step)
    yhat = F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step")).cast("double")
    band = F.lit(S.FORECAST_BAND_SIGMAS) * F.col("sigma")
    return rows.select(
        F.date_add("last_date", F.col("step")).alias("sale_date"),
        F.greatest(yhat, F.lit(0.0)).alias("forecast"),
        F.greatest(yhat - band, F.lit(0.0)).alias("lower"),
        (yhat + band).alias("upper"),
        F.col("moving_avg_7d"),
    )


def sales_forecast(fact: DataFrame, horizon: int = S.FORECAST_HORIZON_DAYS) -> DataFrame:
    """M1: ``horizon`` future days with the forecast, its band and the 7-day mean."""
    h = _horizon(fit(fact), horizon)
    return h.select("sale_date", *[half_up(c).alias(c) for c in
                                   ("forecast", "lower", "upper", "moving_avg_7d")])


def forecast_metrics(fact: DataFrame, horizon: int = S.FORECAST_HORIZON_DAYS) -> DataFrame:
    """M2: fit quality and forecast totals in one row (no row if fewer than 2 days)."""
    p = fit(fact)
    h = _horizon(p, horizon).agg(F.count(F.lit(1)).alias("h"), F.sum("forecast").alias("t"),
                                 F.sum("lower").alias("lo"), F.sum("upper").alias("hi"))
    return p.select(
        half_up("r2", 4).alias("r2"), half_up("mae").alias("mae"),
        half_up("mape").alias("mape_pct"), half_up("slope").alias("slope"),
        half_up("intercept").alias("intercept"),
        F.lit(horizon).cast("bigint").alias("horizon_days"),
        half_up(h.select("t").scalar()).alias("total_forecast"),
        half_up(h.select(F.col("t") / F.greatest(F.col("h"), F.lit(1))).scalar())
         .alias("mean_daily_forecast"),
        half_up(h.select("lo").scalar()).alias("min_forecast"),
        half_up(h.select("hi").scalar()).alias("max_forecast"),
    )


def actual_plus_forecast(fact: DataFrame, horizon: int = S.FORECAST_HORIZON_DAYS) -> DataFrame:
    """Actual daily rows followed by the forecast rows; absent columns NULL."""
    actual = daily_xy(fact).select("sale_date", half_up("amount").alias("amount"))
    fc = sales_forecast(fact, horizon).select("sale_date", "forecast", "lower", "upper")
    return actual.unionByName(fc, allowMissingColumns=True)
