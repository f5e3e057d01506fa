"""Hot keys: one seller / customer and one group of copies hold a third of the rows.

Results are checked against a brute-force pandas computation, and the plans
are checked for the shapes that keep a hot key out of a single task: no
window over fact rows, partial (map-side) aggregation before every shuffle.
"""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from salescope import schema as S
from salescope.operators import customers as C
from salescope.operators import ingest
from salescope.operators import reports as R


def skewed_rows(n: int = 3000):
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        seller = "S-HOT" if hot else f"S{i % 17}"
        cust = "00000000000001" if hot else f"{i % 101:014d}"
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 40)
        code = str(100 + i % 23)
        rows.append((f"n{cust}", cust, "AM" if i % 2 else "PA", day, code, f"prod {code}",
                     Decimal(f"{(i % 50) + 1}.25"), (i % 5) + 1, "VAREJO" if i % 4 else "DIRETO",
                     seller, "f.csv", i, 0))
    # one group of copies: a third of all rows share the five dedup keys
    copy = ("copy", "00000000000777", dt.datetime(2024, 2, 1), "999", "prod 999",
            Decimal("10.00"), 1, "DIRETO")
    for j in range(n // 2):
        rank = j % 3
        rows.append((f"copy name {j}", copy[1], "RR", copy[2], copy[3], copy[4], copy[5], copy[6],
                     copy[7], f"seller {rank}", f"file{rank}.csv", 10_000 + j, rank))
    return rows


@pytest.fixture(scope="module")
def stacked(spark):
    schema = T.StructType(S.STANDARD_SCHEMA.fields + [T.StructField("_row_no", T.LongType()),
                                                      T.StructField("_source_rank", T.IntegerType())])
    return spark.createDataFrame(skewed_rows(), schema)


def test_dedup_keeps_first_of_a_huge_group(spark, stacked):
    out = ingest.distinct_dedup(ingest.clean(stacked)).collect()
    copies = [r for r in out if r.customer_id == "00000000000777"]
    assert len(copies) == 1
    # first by (source rank, row number): rank 0, smallest row number
    assert copies[0]._source_rank == 0 and copies[0]._row_no == 10_000
    assert copies[0].customer_name == "copy name 0"
    pdf = pd.DataFrame([r.asDict() for r in stacked.collect()])
    expected = pdf.drop_duplicates(ingest.DEDUP_KEYS)
    assert len(out) == len(expected)


def test_reports_on_a_hot_seller_match_brute_force(spark, stacked):
    fact = ingest.finalize(ingest.canonical_name(ingest.distinct_dedup(ingest.clean(stacked))))
    pdf = pd.DataFrame([r.asDict() for r in fact.collect()])
    pdf["amount"] = pdf["amount"].astype(float)
    got = {r.seller: r for r in R.by_seller(fact).collect()}
    for seller, grp in pdf.groupby("seller"):
        r = got[seller]
        assert r.transactions == len(grp)
        assert abs(r.amount - grp["amount"].sum()) < 1e-6
        assert r.customers == grp["customer_id"].nunique()
        assert r.active_days == grp["sale_date"].nunique()
        by_channel = grp.groupby("channel")["amount"].sum()
        best = sorted(by_channel.items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
        assert r.best_channel == best
    detail = {r.customer_id: r for r in C.customer_detail(fact).collect()}
    hot = pdf[pdf["customer_id"] == "00000000000001"]
    assert detail["00000000000001"].transactions == len(hot)
    assert detail["00000000000001"].products == hot["product_code"].nunique()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_window_over_fact_rows(spark, stacked):
    fact = ingest.finalize(ingest.canonical_name(ingest.distinct_dedup(ingest.clean(stacked))))
    for df in (ingest.distinct_dedup(stacked), R.by_seller(fact), C.customer_detail(fact),
               C.top_product_per_customer(fact), R.highlights(fact)):
        plan = _plan(df)
        assert "Window" not in plan
        # every aggregation is split into a partial (map-side) and a final step
        assert "Partial" in plan or "partial_" in plan


def test_broadcast_only_behind_a_proven_bound(spark):
    from salescope.operators.joins import bounded_broadcast, has_at_most
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    assert has_at_most(small, 10) and not has_at_most(big, 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(5000).select((F.col("id") % 1000).alias("k"))
        hinted = _plan(fact.join(bounded_broadcast(small, max_rows=10), "k"))
        unhinted = _plan(fact.join(bounded_broadcast(big, max_rows=10), "k"))
        assert "BroadcastHashJoin" in hinted
        assert "BroadcastHashJoin" not in unhinted and "SortMergeJoin" in unhinted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_modes_count_before_they_meet(spark):
    """No per-customer object buffer, no sort of fact rows: rows are counted in a hash
    aggregation before the first exchange."""
    from salescope.operators import customers as C
    rows = [(f"{k:014d}" if k % 3 else "00000000000000", f"n{k % 7}") for k in range(60)]
    fact = (spark.createDataFrame(rows, "customer_id string, customer_name string")
            .selectExpr("*", "'r' as region", "'c' as channel", "cast(null as string) as seller"))
    text = C.mode_per_customer(fact)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "ObjectHashAggregate" not in text
    deepest = text.rstrip().splitlines()
    first_exchange = max(i for i, line in enumerate(deepest) if "Exchange" in line)
    assert not any("Sort" in line for line in deepest[first_exchange + 1:])
    assert any("HashAggregate" in line and "partial_count" in line for line in deepest[first_exchange + 1:])


def test_segments_do_not_depend_on_partitioning(spark):
    """The same clusters from three partitionings of the same customers."""
    import random

    from salescope.operators import segments as SG
    rng = random.Random(3)
    rows = [(f"{k:05d}", rng.randrange(300), rng.randrange(1, 40), rng.random() * 9000) for k in range(900)]
    schema = "customer_id string, recency bigint, frequency bigint, monetary double"
    seen = set()
    for parts in (1, 5, 13):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        out = SG.assign_clusters(df, n_init=2).collect()
        groups: dict = {}
        for r in out:
            groups.setdefault(r.prediction, []).append(r.customer_id)
        seen.add(tuple(sorted(tuple(sorted(g)) for g in groups.values())))
    assert len(seen) == 1
