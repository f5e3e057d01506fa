"""Dedup and names of rows of which few repeat: the results of the plain steps, without a shuffle of whole rows."""
import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from salescope import schema as S
from salescope.operators import ingest
from salescope.plans.consolidate import Ingest

SCHEMA = ", ".join(f"{c} string" for c in ingest.STANDARD_COLUMNS) + ", _row_no long, _source_rank int"


def stacked(spark, keys, n=400):
    rng = random.Random(5)
    rows = [(rng.choice(["n1", "n2", None]), rng.choice([None, *(f"c{k}" for k in range(keys))]), "UF",
             "2024-01-0%d 10:00:00" % rng.randrange(1, 8), rng.choice([None, "1", "2", "3"]),
             rng.choice([None, "a", "bb", "cc"]), "%d.5" % rng.randrange(1, 4), rng.choice([None, "1", "2"]), "CH",
             "s", f"f{k % 3}", k, k % 3) for k in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(*[F.col(c).cast(S.STANDARD_SCHEMA[c].dataType).alias(c) for c in ingest.STANDARD_COLUMNS],
                     "_row_no", "_source_rank").repartition(3)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def kept(spark, folder):
    def keep(name, df):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")
    return keep


@pytest.mark.parametrize("keys,limit", [(2, 100_000), (200, 100_000), (2, 3)])
def test_dedup_and_names_equal_the_plain_steps(spark, tmp_path, monkeypatch, keys, limit):
    monkeypatch.setattr(ingest, "LOOKUP_ROWS", limit)
    keep, df = kept(spark, tmp_path), stacked(spark, keys)
    want = ingest.distinct_dedup(df)
    got = ingest.dedup_mostly_unique(df, keep)
    assert same(got.select(*want.columns), want)
    want, got = ingest.canonical_name(want), ingest.canonical_name(got, keep)
    assert same(got.select(*want.columns), want)


def test_rows_without_copies_are_not_shuffled(spark, tmp_path):
    keep = kept(spark, tmp_path)
    df = keep("rows", stacked(spark, 2, 0).unionByName(stacked(spark, 9, 30)))
    unique = ingest.canonical_name(ingest.dedup_mostly_unique(df, keep), keep)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        unique.explain()
    tree = out.getvalue()
    assert "LeftAnti" in tree and "SortMergeJoin" not in tree
    # only rows whose key repeats meet an exchange: it lies above the semi join
    assert all("Broadcast" in part.split("+- ")[0] or "LeftSemi" in part
               for part in tree.split("Exchange hashpartitioning")[1:])


def test_a_fact_read_once_shuffles_only_what_is_read(spark):
    run = Ingest(spark, sources=[])
    run.frames = [df.drop("_source_rank") for df in (stacked(spark, 3), stacked(spark, 5))]
    for columns in (["source_file", "sale_date"], ["customer_id", "sale_date", "unit_price"]):
        got = run.fact_once(columns)
        assert same(got, run.fact().select(*columns))
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "channel" not in text.split("Exchange hashpartitioning")[0] and "Join" not in text


def test_top_products_count_only_the_rows_of_the_top(spark):
    from salescope.operators import reports as R
    df = stacked(spark, 5)
    fact = ingest.finalize(ingest.canonical_name(df)).withColumn("region", F.col("quantity").cast("string"))
    order = (F.desc("amount"), "product_code", "product_canon")
    for n in (1, 2, 30):
        got, want = R.top_products(fact, n), R.product_table(fact).orderBy(*order).limit(n)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    expand = got._jdf.queryExecution().optimizedPlan().toString().split("Expand")[1]
    assert "Join LeftSemi" in expand


def test_shared_tables_and_the_store_are_compressed_well(spark, tmp_path):
    from salescope.plans import incremental as I
    from salescope.sources.materialize import materialized
    rows = stacked(spark, 3).drop("_source_rank")
    I.FactStore(spark, str(tmp_path / "store")).add(I.ranked(rows, "f.csv"))
    table = materialized(spark, "codec-test", str(tmp_path), lambda: rows)
    written = [*(str(p) for p in (tmp_path / "store" / "rows").rglob("*.parquet")), *table.inputFiles()]
    assert len(written) > 1 and all(".zstd." in name for name in written)
