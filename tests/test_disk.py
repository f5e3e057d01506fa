"""What the ingest queries shuffle and write: whole rows once, no copies that nothing reads twice."""
import pytest
from pyspark.sql import functions as F

from salescope import session as SS
from salescope.operators import ingest
from salescope.plans import catalog
from salescope.sources import fixtures as FX
from salescope.sources.materialize import written
from test_few_copies import same, stacked

FILES = ("source_a.csv", "source_b.csv", "source_c.csv", "source_d.csv")
TABLES = {"nation": "1 n_nationkey, 'Acre' n_name", "part": "7 p_partkey, 'soro' p_name, 'grande' p_type",
          "supplier": "3 s_suppkey, 'Casa' s_name",
          "customer": "5 c_custkey, 'Loja' c_name, 1 c_nationkey, 'FARMA' c_mktsegment",
          "orders": "explode(array(1, 2, 3)) o_orderkey, 5 o_custkey",
          "lineitem": "explode(array(1, 2, 3)) l_orderkey, 7 l_partkey, 3 l_suppkey, 1 l_linenumber, 2.0D l_quantity, "
                      "10.5D l_extendedprice, timestamp_ntz'2024-01-02 00:00:00' l_shipdate",
          "events": "1 event_id, timestamp_ntz'2024-01-03 04:05:06' ts, 9 user_id, 'view' event_type, 3.0D value, 'p' props"}


@pytest.fixture
def tables(spark, tmp_path):
    SS.prepare(spark)
    for name, columns in TABLES.items():
        spark.sql(f"select {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("most,lookup", [(100_000, 100_000), (90, 100_000), (90, 1), (0, 100_000)])
def test_dedup_and_names_by_code_equal_the_plain_steps(spark, monkeypatch, most, lookup):
    monkeypatch.setattr(ingest, "CODE_ROWS", most)
    monkeypatch.setattr(ingest, "CODE_SHARE", 0)
    monkeypatch.setattr(ingest, "LOOKUP_ROWS", lookup)
    df = stacked(spark, 3)
    many, nulls = ingest.crowded(df, "product_code")
    assert nulls and (many is None) == (most > 400)
    want = ingest.canonical_name(ingest.distinct_dedup(df))
    assert same(ingest.dedup_and_name(df).select(*want.columns), want)


def test_no_bucket_is_crowded_by_the_mean_alone(spark, monkeypatch):
    monkeypatch.setattr(ingest, "CODE_ROWS", 0)
    monkeypatch.setattr(ingest, "CODE_BUCKETS", 1)
    assert ingest.crowded(stacked(spark, 3), "product_code")[0] is None


def test_whole_rows_are_shuffled_once_for_dedup_and_names(spark, tmp_path):
    stacked(spark, 3).where("product_code is not null").write.parquet(str(tmp_path / "rows"))
    named = ingest.dedup_and_name(spark.read.parquet(str(tmp_path / "rows")))
    plan = executed(named)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) == 1 and "ReusedExchange" in plan and "SortMergeJoin" not in plan


def test_supplier_files_and_deduplicated_rows_are_not_written_for_one_read(spark, tables):
    queries = catalog.queries()
    assert queries["distinct_dedup"](spark, tables).count() == 2
    kinds = [*(f"landing-{name}" for name in FILES), "deduped-known"]
    assert [written(spark, kind, tables) for kind in kinds] == [None] * 5
    fact = queries["consolidate_sources"](spark, tables)
    assert sorted((r["seller"], r["product_canon"]) for r in fact.collect()) == [
        ("Distribuidor A", "soro"), ("Distribuidor C", "event view")]
    assert [written(spark, kind, tables) for kind in kinds] == [None] * 5
    assert written(spark, "stacked-known", tables) is not None      # parsed once, read by both steps


def test_landing_files_are_compressed_and_whole_rows_shuffled_once(spark, tables):
    from salescope.plans import landing_batch as LB
    from salescope.sources.raw import scan_layouts
    fact = catalog.queries()["landing_batch"](spark, tables)
    plan = executed(fact)
    assert sorted((r["seller"], r["source_file"], r["product_canon"]) for r in fact.collect()) == [
        ("Distribuidor A", "source_a.csv", "soro"), ("Distribuidor C", "source_c.csv", "event view")]
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) == 1 and "ReusedExchange" in plan
    assert [written(spark, f"landing-{name}", tables) for name in FILES] == [None] * 4
    layouts, errors = scan_layouts(spark, LB.landing_folder(spark, tables))
    assert sorted(f for layout in layouts for f in layout.files) == sorted(FILES) and len(errors) == 1
    parts = [p for layout in layouts for p in layout.frame.inputFiles()]
    assert parts and all(p.endswith(".csv.gz") for p in parts)


def test_staged_rows_are_shuffled_once(spark, tmp_path):
    from salescope.streaming.landing import consolidate_staging
    stacked(spark, 3).where("product_code is not null").drop("_source_rank").withColumn(
        "_file_path", F.col("source_file")).write.parquet(str(tmp_path / "std"))
    plan = executed(consolidate_staging(spark, str(tmp_path / "std")))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) == 1 and "ReusedExchange" in plan


def fact_of(spark, rows):
    return rows.select(*ingest.STANDARD_COLUMNS, F.col("product_name").alias("product_canon"))


@pytest.mark.parametrize("most", [100_000, 20, 0])
def test_customer_detail_is_the_same_met_or_combined(spark, monkeypatch, most):
    """Ties, missing values and hot customers; where rows meet by customer, no count is shuffled again."""
    from salescope.operators import customers as C
    rows = stacked(spark, 4).withColumns({
        "region": F.when(F.col("_row_no") % 3 > 0, F.concat(F.lit("R"), (F.col("_row_no") % 7).cast("string"))),
        "channel": F.when(F.col("customer_id") != "c1", F.concat(F.lit("K"), (F.col("_row_no") % 2).cast("string"))),
        "product_code": F.when(F.col("customer_id") != "c2", F.col("product_code"))})
    fact = fact_of(spark, rows).unionByName(fact_of(spark, rows.where("customer_id = 'c0'")))
    base = fact.where("customer_id is not null")
    columns = C._detail_met(base).columns
    assert sorted(columns) == sorted(C._detail_combined(base).columns)
    want = C._detail_combined(base).select(*columns).fillna("", C.MODES)
    assert same(C._detail_met(base).select(*columns).fillna("", C.MODES), want)
    monkeypatch.setattr(ingest, "CODE_ROWS", most)
    monkeypatch.setattr(ingest, "CODE_SHARE", 0)
    detail = C.customer_detail(fact)
    got = {r["customer_id"]: r for r in detail.collect()}
    assert len(got) == want.count() == 4
    for r in want.collect():
        assert all(got[r["customer_id"]][c] == r[c] for c in columns if c != "_a")
    if most == 100_000:
        plan = executed(C.customer_detail(fact).drop("recency_days"))
        assert len([line for line in plan.splitlines() if "Exchange hashpartitioning" in line]) == 2
        assert "Expand" not in plan


def test_distinct_counts_of_a_group_shuffle_two_columns_each(spark):
    from salescope.operators import reports as R
    plan = R.by_seller(fact_of(spark, stacked(spark, 4)))._jdf.queryExecution().optimizedPlan().toString()
    # the labels of the best channel, region and product are the only grouping sets
    assert plan.count("Expand") == 1


def test_the_fact_is_written_once_where_no_row_repeats(spark, tables):
    from salescope.sources.fact import sales_fact
    twice = sales_fact(spark, tables)                     # three line items with one key
    assert twice.count() == 1 and written(spark, "fact", tables) is not None
    spark.sql("select l_orderkey, 7 l_partkey, 3 l_suppkey, 1 l_linenumber, cast(l_orderkey as double) l_quantity, 10.5D l_extendedprice, "
              "timestamp_ntz'2024-01-02 00:00:00' l_shipdate from (select explode(array(1, 2, 3)) l_orderkey)").write.mode(
        "overwrite").parquet(f"{tables}/lineitem.parquet")
    once = sales_fact(spark, tables)
    assert written(spark, "fact", tables) is None and once.columns == twice.columns and once.dtypes == twice.dtypes
    assert sorted((r["quantity"], str(r["unit_price"]), r["product_canon"]) for r in once.collect()) == [
        (1, "10.5", "soro"), (2, "5.25", "soro"), (3, "3.5", "soro")]
