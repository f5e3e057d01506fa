"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` and their
oracle SQL. ``__spark_entry__`` exposes both."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import session as SS
from ..functions import expressions as E
from ..functions.numeric import half_up
from ..operators import coverage as CV
from ..operators import customers as C
from ..operators import forecast as FC
from ..operators import ingest as IG
from ..operators import reports as R
from ..operators import search as SX
from ..operators import segments as SG
from ..operators import stock as ST
from ..operators import timeseries as TS
from ..sinks.writers import report_meta, write_csv, write_reports
from ..sources import fixtures as FX
from ..sources.fact import read_fact, sales_fact, write_fact
from ..streaming.landing import stream_supplier_files
from . import consolidate as CO
from . import incremental as IC
from . import ingest_sql as IS
from . import landing_batch as LB
from . import mapping_sql as MS
from . import report_sql as RS
from . import schema_inference as SI
from . import series_sql as QS
from . import value_forms as VF

# Search term of the registered customer-search query (any term works).
SEARCH_TERM = "building"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            SS.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run
    return deco


def _report(name: str, op: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    register(name, sql)(lambda spark, sf_dir: op(sales_fact(spark, sf_dir)))


for _name, _op, _sql in [
    ("kpis", R.kpis, RS.KPIS),
    ("by_seller", R.by_seller, RS.BY_SELLER),
    ("by_channel", R.by_channel, RS.BY_CHANNEL),
    ("by_region", R.by_region, RS.BY_REGION),
    ("top_products", R.top_products, RS.TOP_PRODUCTS),
    ("seller_coverage", R.seller_coverage, RS.SELLER_COVERAGE),
    ("coverage_by_region", R.coverage_by_region, RS.COVERAGE_BY_REGION),
    ("coverage_by_channel", R.coverage_by_channel, RS.COVERAGE_BY_CHANNEL),
    ("coverage_by_month", R.coverage_by_month, RS.COVERAGE_BY_MONTH),
    ("highlights", R.highlights, RS.HIGHLIGHTS),
    ("argmax_per_seller", R.argmax_per_seller, RS.ARGMAX_PER_SELLER),
    ("product_rank", R.product_rank, RS.PRODUCT_RANK),
    ("basic_group_reports", lambda fact: R.basic_group_reports(fact)["seller"],
     RS.BASIC_BY_SELLER),
    ("basic_by_channel", lambda fact: R.basic_group_reports(fact)["channel"], RS.basic_by("channel")),
    ("basic_by_region", lambda fact: R.basic_group_reports(fact)["region"], RS.basic_by("region")),
    ("basic_by_day", lambda fact: R.basic_group_reports(fact)["day"], RS.basic_by("sale_date")),
    ("report_meta", lambda fact: report_meta(fact.sparkSession, fact, False).drop("generated_at")
                                 .withColumn("notes", F.array_join("notes", " | ")), RS.REPORT_META),
    ("daily_sales", TS.daily_sales, QS.DAILY_SALES),
    ("weekly_sales", TS.weekly_sales, QS.WEEKLY_SALES),
    ("monthly_sales", TS.monthly_sales, QS.MONTHLY_SALES),
    ("series_summary", TS.series_summary, QS.SERIES_SUMMARY),
    ("day_index", TS.day_index, QS.DAY_INDEX),
    ("trailing_mean_7", TS.trailing_mean_7, QS.TRAILING_MEAN_7),
    ("peak_period", TS.peak_period, QS.PEAK_PERIOD),
    ("peak_week", lambda fact: TS.peak_period(fact, "week"), QS.peak_period_sql("week")),
    ("peak_month", lambda fact: TS.peak_period(fact, "month"), QS.peak_period_sql("month")),
    ("sales_forecast", FC.sales_forecast, QS.SALES_FORECAST),
    ("forecast_metrics", FC.forecast_metrics, QS.FORECAST_METRICS),
    ("actual_plus_forecast", FC.actual_plus_forecast, QS.ACTUAL_PLUS_FORECAST),
    ("customer_lifecycle", C.customer_lifecycle, QS.CUSTOMER_LIFECYCLE),
    ("customer_detail", C.customer_detail, QS.CUSTOMER_DETAIL),
    ("mode_per_customer", C.mode_per_customer, QS.MODE_PER_CUSTOMER),
    ("top_product_per_customer", C.top_product_per_customer, QS.TOP_PRODUCT_PER_CUSTOMER),
    ("rfm", C.rfm, QS.RFM),
    ("customer_search",
     lambda fact: C.customer_list(fact, SEARCH_TERM, "amount", C.S.CUSTOMER_LIST_ROWS),
     QS.customer_search_sql(SEARCH_TERM, "amount DESC", 500)),
    ("customer_sort_recency",
     lambda fact: C.customer_list(fact, "", "recency_days", C.S.CUSTOMER_LIST_ROWS),
     QS.customer_search_sql("", "recency_days ASC", 500)),
    *[(f"customer_sort_{by}",
       lambda fact, by=by: C.customer_list(fact, "", by, C.S.CUSTOMER_LIST_ROWS),
       QS.customer_search_sql("", f"{by} DESC", 500))
      for by in C.S.CUSTOMER_SORT_COLUMNS if by != "recency_days"],
]:
    _report(_name, _op, _sql)


def _ingest(name: str, sql: str | None):
    def deco(fn: Callable[[CO.Ingest], DataFrame]):
        register(name, sql)(lambda spark, sf_dir: fn(CO.Ingest(spark, sf_dir)))
        return fn
    return deco


_STD = list(IG.STANDARD_COLUMNS)
@_ingest("standardize", IS.STANDARDIZE)
def _standardize(ig: CO.Ingest) -> DataFrame:
    """Every readable supplier file mapped to the 11 standard columns."""
    out = None
    for df in ig.frames:
        df = df.select(*_STD)
        out = df if out is None else out.unionByName(df)
    return out
_ingest("union_sources", IS.UNION_SOURCES)(
    lambda ig: ig.stacked().select(*_STD, F.col("_source_rank").alias("source_rank")))
_ingest("clean", IS.CLEAN)(
    lambda ig: ig.cleaned().select(*_STD, F.col("_source_rank").alias("source_rank")))
_ingest("distinct_dedup", IS.DISTINCT_DEDUP)(
    lambda ig: ig.deduped().select(*_STD, F.col("_source_rank").alias("source_rank")))
_ingest("canonical_name", IS.CANONICAL_NAME)(lambda ig: ig.names())
_ingest("consolidate_sources", IS.CONSOLIDATE_SOURCES)(lambda ig: ig.fact())
_ingest("unit_price", IS.UNIT_PRICE)(
    lambda ig: ig.fact_once(["customer_id", "sale_date", "product_code", "amount",
                             "quantity", "unit_price"]))
_ingest("ingest_counts", IS.INGEST_COUNTS)(lambda ig: ig.counts())
_ingest("ingest_log", IS.INGEST_LOG)(lambda ig: ig.log())


@register("preview", IS.PREVIEW)
def _preview(spark, sf_dir):
    """L4: first 5 rows of the first standardised file, which is read twice, with its distinct customers."""
    std = CO.Ingest(spark, sf_dir, sources=FX.raw_sources(spark, sf_dir)).frames[0]
    customers = std.agg(F.countDistinct("customer_id")).scalar()
    return (std.orderBy("_row_no").limit(5)
               .select(*_STD, "_row_no", customers.alias("file_customers")))


@_ingest("log_for_files", IS.LOG_FOR_FILES)
def _log_for_files(ig: CO.Ingest) -> DataFrame:
    files = ig.spark.createDataFrame([(f,) for f in IS.LOG_FILES], "source_file string")
    return CO.log_for_files(ig.log(), files)


def _texts(field: str, expr) -> Callable[[CO.Ingest], DataFrame]:
    return lambda ig: (ig.raw_column(field).select("text", expr(F.col("text")).alias("value"))
                         .distinct())


_ingest("parse_mixed_date", IS.PARSE_MIXED_DATE)(_texts("sale_date", E.parse_mixed_date))
_ingest("normalize_id", IS.NORMALIZE_ID)(_texts("customer_id", E.normalize_id))
_ingest("synthetic_code", IS.SYNTHETIC_CODE)(_texts("product_name", E.synthetic_code))


register("date_forms", VF.DATE_FORMS)(VF.date_forms)
register("amount_forms", VF.AMOUNT_FORMS)(VF.amount_forms)
register("slug_forms", VF.SLUG_FORMS)(VF.slug_forms)


@register("coverage_from_state", RS.COVERAGE_FROM_STATE)
def _coverage_from_state(spark, sf_dir):
    """A6-A9 and the total: distinct customers of all groups from merged states, one a half of the sales."""
    fact = sales_fact(spark, sf_dir)
    folder = SS.shared_path(spark, f"coverage-{uuid.uuid4().hex}")
    CV.number_customers(fact).write.parquet(f"{folder}/numbers")
    numbers = spark.read.parquet(f"{folder}/numbers")
    early = F.col("sale_date") < F.lit("1998-01-01").cast("date")
    for name, half in (("early", early), ("late", ~early | F.col("sale_date").isNull())):
        CV.coverage_state(fact.where(half), numbers).write.parquet(f"{folder}/{name}")
    return CV.coverage(CV.merge_states(*[spark.read.parquet(f"{folder}/{n}") for n in ("early", "late")]))


@register("customer_search_indexed", QS.customer_search_sql(SEARCH_TERM, "amount DESC", 500))
def _customer_search_indexed(spark, sf_dir):
    """F2 + L3 + L2 through the trigram index of the customer report."""
    index = SX.SearchIndex(spark, SS.shared_path(spark, f"search-{uuid.uuid4().hex}"))
    index.build(C.customer_detail(sales_fact(spark, sf_dir)))
    return C.customer_sort(index.search(SEARCH_TERM), "amount", C.S.CUSTOMER_LIST_ROWS)


@register("sku_velocity", QS.SKU_VELOCITY)
def _sku_velocity(spark, sf_dir):
    return ST.sku_velocity(sales_fact(spark, sf_dir))


@register("stock_status", QS.STOCK_STATUS)
def _stock_status(spark, sf_dir):
    return ST.stock_status(sales_fact(spark, sf_dir), FX.stock_table(spark, sf_dir))


@register("stock_summary", QS.STOCK_SUMMARY)
def _stock_summary(spark, sf_dir):
    return ST.stock_summary(ST.stock_status(sales_fact(spark, sf_dir), FX.stock_table(spark, sf_dir)))


@register("rfm_standardized", QS.RFM_STANDARDIZED)
def _rfm_standardized(spark, sf_dir):
    """The z-scores the clusters are made of, to six digits."""
    return SG.standardized(C.rfm(sales_fact(spark, sf_dir))).select(
        "customer_id", *[half_up(f"z_{c}", 6).alias(f"z_{c}") for c in SG.FEATURES])


@register("rfm_segments")
def _rfm_segments(spark, sf_dir):
    return SG.rfm_segments(sales_fact(spark, sf_dir))


def _schema(name: str, sql: str | None = None):
    def deco(fn: Callable[[SI.SchemaInference], DataFrame]):
        register(name, sql)(lambda spark, sf_dir: fn(SI.SchemaInference(spark, sf_dir)))
        return fn
    return deco


_schema("profile_columns", IS.PROFILE_COLUMNS)(lambda si: si.profiles())
_schema("train_classifier")(lambda si: si.training_summary())
_schema("map_columns")(lambda si: si.mapping())
_schema("mapping_report")(lambda si: si.report())
_schema("mapping_accuracy")(lambda si: si.accuracy())
_schema("map_columns_by_rules", MS.MAP_COLUMNS)(lambda si: si.rule_mapping())
_schema("mapping_report_by_rules", MS.MAPPING_REPORT)(lambda si: si.rule_report())
_schema("mapping_accuracy_by_rules", MS.MAPPING_ACCURACY)(lambda si: si.rule_accuracy())
_schema("ingest_log_by_rules", MS.INGEST_LOG)(lambda si: si.rule_log())
_schema("align_columns", MS.ALIGN_COLUMNS)(lambda si: si.aligned())
_schema("training_folds", MS.TRAINING_FOLDS)(lambda si: si.folds())


@register("empty_state", RS.EMPTY_STATE)
def _empty_state(spark, sf_dir):
    """K4: the files written for a fact without rows: the metadata alone, reports skipped."""
    none = sales_fact(spark, sf_dir).where("amount < 0")
    written = write_reports(spark, none, {"by_region": R.by_region}, SS.shared_path(spark, f"reports-{uuid.uuid4().hex}"))
    meta = spark.read.schema("empty boolean, date_min string, date_max string, horizon_days int, notes array<string>").json(
        written["meta"])
    return meta.select("empty", "date_min", "date_max", "horizon_days", F.array_join("notes", " | ").alias("notes"),
                       F.lit(len(written) - 1).alias("reports"))


@_schema("consolidate_inferred", IS.CONSOLIDATE_INFERRED)
def _consolidate_inferred(si: SI.SchemaInference) -> DataFrame:
    """Upload flow: every file standardised with the mapping the classifier
    inferred (files lacking a required field are quarantined), then consolidated."""
    sources = CO.inferred_sources(si.spark, si.sf_dir, si.mapping())
    return CO.Ingest(si.spark, si.sf_dir, sources=sources, tag="inferred").fact()


@register("consolidate_incremental", IS.CONSOLIDATE_SOURCES)
def _consolidate_incremental(spark, sf_dir):
    """K1 + A18 + J1 upload by upload: the last file first, the first file twice."""
    path = SS.shared_path(spark, f"fact-store-{uuid.uuid4().hex}")
    return IC.consolidate_incremental(spark, sf_dir, path).fact()


@register("landing_stream", IS.STREAM_SOURCES)
def _landing_stream(spark, sf_dir):
    """Structured Streaming ingest of the supplier files dropped as CSV into
    landing folders, then consolidated (the part-file names aside)."""
    return stream_supplier_files(spark, sf_dir).drop("source_file")


@register("fact_round_trip", RS.FACT)
def _fact_round_trip(spark, sf_dir):
    """K1 + S1: the fact written and read back."""
    path = SS.shared_path(spark, f"fact-copy-{uuid.uuid4().hex}")
    return read_fact(spark, write_fact(sales_fact(spark, sf_dir), path))


@register("csv_round_trip", RS.basic_by("channel"))
def _csv_round_trip(spark, sf_dir):
    """K2: a report written as CSV with a header and read back."""
    report = R.basic_group_reports(sales_fact(spark, sf_dir))["channel"]
    path = write_csv(report, SS.shared_path(spark, f"report-{uuid.uuid4().hex}"))
    return spark.read.option("header", True).option("escape", '"').schema(report.schema).csv(path)


@register("report_files", RS.BY_REGION)
def _report_files(spark, sf_dir):
    """K3: reports written by ``write_reports``, one of them read back."""
    written = write_reports(spark, sales_fact(spark, sf_dir), {"by_region": R.by_region},
                            SS.shared_path(spark, f"reports-{uuid.uuid4().hex}"), fmt="parquet")
    return spark.read.parquet(written["by_region"])


register("landing_batch", IS.CONSOLIDATE_SOURCES)(LB.landing_batch)
register("landing_log", IS.LANDING_LOG)(LB.landing_log)
register("landing_layouts", IS.LANDING_LAYOUTS)(LB.landing_layouts)
register("price_rows", IS.PRICE_ROWS)(LB.price_rows)
register("rejected_rows", IS.REJECTED_ROWS)(LB.rejected_rows)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
