"""Fact -> every report, as in the dashboard payload."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators import customers as C
from ..operators import forecast as FC
from ..operators import reports as R
from ..operators import segments as SG
from ..operators import stock as ST
from ..operators import timeseries as TS
from ..sinks.writers import write_reports


def report_builders(stock: DataFrame | None = None) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Name -> report function of the fact (stock reports need a stock table)."""
    out: dict[str, Callable[[DataFrame], DataFrame]] = {
        "kpis": R.kpis, "highlights": R.highlights,
        "daily_sales": TS.daily_sales, "weekly_sales": TS.weekly_sales,
        "monthly_sales": TS.monthly_sales, "series_summary": TS.series_summary,
        "projection": FC.sales_forecast, "projection_metrics": FC.forecast_metrics,
        "by_seller": R.by_seller, "by_channel": R.by_channel, "by_region": R.by_region,
        "top_products": R.top_products, "seller_coverage": R.seller_coverage,
        "coverage_by_region": R.coverage_by_region, "coverage_by_channel": R.coverage_by_channel,
        "coverage_by_month": R.coverage_by_month, "customer_lifecycle": C.customer_lifecycle,
        "segments": SG.rfm_segments, "customers": C.customer_detail,
    }
    if stock is not None:
        out["stock"] = lambda fact: ST.stock_status(fact, stock).limit(S.STOCK_LIST_ROWS)
        out["stock_summary"] = lambda fact: ST.stock_summary(ST.stock_status(fact, stock))
    return out


def publish(spark: SparkSession, fact: DataFrame, out_dir: str,
            stock: DataFrame | None = None, fmt: str = "json") -> dict[str, str]:
    """Write every report of ``fact`` under ``out_dir`` (one directory each)."""
    return write_reports(spark, fact, report_builders(stock), out_dir, fmt)
