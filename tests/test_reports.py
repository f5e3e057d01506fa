"""Report semantics: ties, boundaries and cross-report properties."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salescope import schema as S
from salescope.operators import customers as C
from salescope.operators import forecast as FC
from salescope.operators import reports as R
from salescope.operators import timeseries as TS
from salescope.sources.fact import sales_fact

from paths import SF_SMALL


def fact_rows(spark, rows):
    """Fact rows from (customer, date, code, name, amount, qty, channel, seller, region)."""
    full = [(f"name {c}", c, reg, d, code, name, Decimal(str(a)), q, ch, sel, "f.csv", name,
             float(a) / q if q > 0 else float(a))
            for c, d, code, name, a, q, ch, sel, reg in rows]
    return spark.createDataFrame(full, S.FACT_SCHEMA)


D = dt.date


@pytest.fixture(scope="module")
def fact(spark):
    return sales_fact(spark, SF_SMALL)


def test_argmax_ties_go_to_smallest_label(spark):
    f = fact_rows(spark, [
        ("1", D(2024, 1, 1), "p1", "beta", 10, 1, "B", "s1", "AM"),
        ("1", D(2024, 1, 2), "p2", "alpha", 10, 1, "A", "s1", "PA"),
        ("2", D(2024, 1, 3), "p2", "alpha", 5, 1, "A", "s2", "PA"),
    ])
    best = {r.seller: r for r in R.argmax_per_seller(f).collect()}
    assert best["s1"].best_channel == "A" and best["s1"].best_region == "AM"
    assert best["s1"].best_product == "alpha"
    top = {r.customer_id: r for r in C.top_product_per_customer(f).collect()}
    assert top["1"].top_product == "alpha" and top["1"].top_product_amount == 10.0


def test_mode_ties_and_lifecycle_bounds(spark):
    f = fact_rows(spark, [
        ("1", D(2024, 3, 31), "p", "x", 1, 1, "B", "s", "AM"),
        ("1", D(2024, 3, 30), "p", "x", 1, 1, "A", "s", "AM"),
        ("2", D(2024, 3, 24), "p", "x", 1, 1, "A", "s", "AM"),   # first buy exactly 7 days ago
        ("3", D(2024, 3, 1), "p", "x", 1, 1, "A", "s", "AM"),    # last buy 30 days ago
        ("4", D(2024, 2, 29), "p", "x", 1, 1, "A", "s", "AM"),   # last buy 31 days ago
    ])
    modes = {r.customer_id: r for r in C.mode_per_customer(f).collect()}
    assert modes["1"].channel == "A"                       # tie -> smallest
    life = C.customer_lifecycle(f).collect()[0]
    assert life.total_customers == 4
    assert life.new_7d == 2                                # 7 days is inclusive
    assert life.inactive_30d == 1                          # 30 days is not inactive
    assert life.recurring == 1 and life.one_time == 3


def test_shares_and_series_agree(fact):
    total = R.kpis(fact).collect()[0].total_amount
    for rep in (R.by_seller(fact), R.by_channel(fact), R.by_region(fact)):
        assert abs(rep.agg(F.sum("share_pct")).collect()[0][0] - 100.0) < 0.05 * rep.count()
        assert abs(rep.agg(F.sum("amount")).collect()[0][0] - total) < 1e-6 * total
    sums = [s.agg(F.sum("amount"), F.sum("units"), F.sum("transactions")).collect()[0]
            for s in (TS.daily_sales(fact), TS.weekly_sales(fact), TS.monthly_sales(fact))]
    assert abs(sums[0][0] - sums[1][0]) < 1e-6 * total and abs(sums[0][0] - sums[2][0]) < 1e-6 * total
    assert sums[0][1] == sums[1][1] == sums[2][1] and sums[0][2] == sums[1][2] == sums[2][2]
    weeks = TS.weekly_sales(fact).select(F.dayofweek("period")).distinct().collect()
    assert [r[0] for r in weeks] == [2]                    # every week starts on Monday


def test_partitioning_does_not_change_results(spark, fact):
    a = sorted(map(tuple, R.by_seller(fact).collect()))
    b = sorted(map(tuple, R.by_seller(fact.repartition(13, "customer_id")).collect()))
    assert a == b


def test_top_products_is_a_top_k(fact):
    top = R.top_products(fact).collect()
    assert len(top) == min(S.TOP_PRODUCTS, fact.select("product_code").distinct().count())
    amounts = [r.amount for r in top]
    assert amounts == sorted(amounts, reverse=True)


def test_forecast_shapes(spark, fact):
    fc = FC.sales_forecast(fact).collect()
    assert len(fc) == S.FORECAST_HORIZON_DAYS
    last = fact.agg(F.max("sale_date")).collect()[0][0]
    assert [r.sale_date for r in fc] == [last + dt.timedelta(days=i) for i in range(1, 15)]
    assert all(r.forecast >= 0 and r.lower >= 0 and r.lower <= r.forecast <= r.upper for r in fc)
    one_day = fact_rows(spark, [("1", D(2024, 1, 1), "p", "x", 5, 1, "A", "s", "AM")])
    assert FC.sales_forecast(one_day).count() == 0          # fewer than 2 days: no forecast
    assert FC.forecast_metrics(one_day).count() == 0
    flat = fact_rows(spark, [("1", D(2024, 1, d), "p", "x", 5, 1, "A", "s", "AM")
                             for d in range(1, 6)])
    m = FC.forecast_metrics(flat).collect()[0]
    assert m.r2 == 1.0 and m.slope == 0.0 and m.mape_pct == 0.0


def test_customer_search_and_sort(fact):
    detail = C.customer_detail(fact)
    hits = C.customer_search(detail, "  BUILDING ").collect()
    assert hits and all("building" in " ".join(str(getattr(r, c) or "") for c in C.SEARCH_COLUMNS).lower()
                        for r in hits)
    assert C.customer_search(detail, "").count() == detail.count()
    rec = [r.recency_days for r in C.customer_sort(detail, "recency_days", 50).collect()]
    assert rec == sorted(rec)
    with pytest.raises(ValueError):
        C.customer_sort(detail, "customer_name")
