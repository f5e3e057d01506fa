"""Sinks: fact table, CSV, one directory per report, run metadata (K1-K5).

Nothing is collected to the driver: every report is written by the
executors as its own JSON (or Parquet) directory; dates are written as
``yyyy-MM-dd`` text. The run metadata is a single-row table.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..sources.fact import write_fact  # noqa: F401  (K1, re-exported)

NOTES = [
    "Seller comes from the source file (one file per distributor).",
    "Stock cover uses the given stock table (target cover 60 days).",
    "Forecast: least squares on the ordinal of selling days, band of 1.5 sigma of residuals.",
]


def write_csv(df: DataFrame, path: str) -> str:
    """K2: CSV with a header row; quotes inside quoted cells are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def dates_as_text(df: DataFrame) -> DataFrame:
    """Date and timestamp columns as ``yyyy-MM-dd`` text, like the report files."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def report_meta(spark: SparkSession, fact: DataFrame, empty: bool) -> DataFrame:
    """K5: generation time, first and last sale date, horizon and notes (one row)."""
    span = fact.agg(F.min("sale_date").alias("date_min"), F.max("sale_date").alias("date_max"))
    notes = (["No file loaded: upload files to see the figures."] if empty else NOTES)
    return span.select(
        F.lit(empty).alias("empty"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        F.date_format("date_min", "yyyy-MM-dd").alias("date_min"),
        F.date_format("date_max", "yyyy-MM-dd").alias("date_max"),
        F.lit(None if empty else S.FORECAST_HORIZON_DAYS).cast("int").alias("horizon_days"),
        F.array(*[F.lit(n) for n in notes]).alias("notes"))


def write_reports(spark: SparkSession, fact: DataFrame,
                  reports: Mapping[str, Callable[[DataFrame], DataFrame]], out_dir: str,
                  fmt: str = "json") -> dict[str, str]:
    """K3 + K4: every report to ``out_dir/<name>``; with no rows only the
    metadata (``empty = true``) is written and the reports are skipped."""
    out_dir = out_dir.rstrip("/")
    empty = fact.isEmpty()
    written = {}
    meta_path = f"{out_dir}/meta"
    report_meta(spark, fact, empty).coalesce(1).write.mode("overwrite").json(meta_path)
    written["meta"] = meta_path
    if empty:
        return written
    for name, build in reports.items():
        path = f"{out_dir}/{name}"
        df = build(fact)
        if fmt == "json":
            dates_as_text(df).write.mode("overwrite").json(path)
        else:
            df.write.mode("overwrite").parquet(path)
        written[name] = path
    return written
