"""The semantic traps of SURVEY §2.14 that other tests do not pin down."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salescope import schema as S
from salescope.operators import forecast as FC
from salescope.operators import ingest
from salescope.operators import profile as P
from salescope.operators import reports as R
from salescope.operators import stock as ST
from salescope.operators import timeseries as TS

from test_reports import fact_rows

D = dt.date


def std_rows(spark, rows):
    """Standard rows (customer, timestamp, code, name, amount, qty, channel, seller)."""
    full = [(f"n{c}", c, "AM", ts, code, name, Decimal(str(a)), q, ch, sel, "f.csv", i)
            for i, (c, ts, code, name, a, q, ch, sel) in enumerate(rows)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STANDARD_SCHEMA.fields)
    return spark.createDataFrame(full, schema + ", _row_no bigint")


def test_dedup_uses_the_full_time_before_midnight(spark):
    t1, t2 = dt.datetime(2024, 1, 5, 9, 0), dt.datetime(2024, 1, 5, 17, 30)
    df = std_rows(spark, [("1", t1, "7", "a", 10, 1, "A", "s"), ("1", t2, "7", "a", 10, 1, "A", "s"),
                          ("1", t1, "7", "a", 10, 1, "A", "s")])
    fact = ingest.consolidate([df]).collect()
    assert len(fact) == 2                                   # same day, different times
    assert {r.sale_date for r in fact} == {D(2024, 1, 5)}   # midnight only after dedup


def test_missing_text_stays_null(spark):
    raw = spark.createDataFrame([(None, "123", None, "01/02/2024", "x", "5", "1", None)],
                                "cli string, doc string, uf string, dt string, prod string, "
                                "val string, qt string, canal string")
    m = {"customer_name": "cli", "customer_id": "doc", "region": "uf", "sale_date": "dt",
         "product_name": "prod", "amount": "val", "quantity": "qt", "channel": "canal"}
    r = ingest.standardize(raw, m, "s", "f").collect()[0]
    assert r.customer_name is None and r.region is None and r.channel is None
    assert r.product_code == "SYN_X"


def test_null_group_keys_are_left_out(spark):
    f = fact_rows(spark, [("1", D(2024, 1, 1), "p", "x", 5, 1, None, "s", "AM"),
                          ("2", D(2024, 1, 2), "p", "x", 7, 1, "A", "s", "AM")])
    chans = R.by_channel(f).collect()
    assert [r.channel for r in chans] == ["A"]
    assert chans[0].share_pct == round(100 * 7 / 12, 2)     # the total keeps every row


def test_forecast_regresses_on_selling_day_ordinals(spark):
    days = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 10), D(2024, 2, 1)]
    f = fact_rows(spark, [("1", d, "p", "x", 10 * (i + 1), 1, "A", "s", "AM")
                          for i, d in enumerate(days)])
    idx = [r.day_index for r in TS.day_index(f).orderBy("sale_date").collect()]
    assert idx == [0, 1, 2, 3]                               # gaps vanish
    m = FC.forecast_metrics(f).collect()[0]
    assert m.slope == 10.0 and m.intercept == 10.0 and m.r2 == 1.0
    fc = FC.sales_forecast(f).collect()
    assert fc[0].sale_date == D(2024, 2, 2)                  # calendar days after the last
    assert fc[0].forecast == 50.0 and fc[0].lower == fc[0].upper == 50.0


def test_portfolio_share_is_not_normalised(spark):
    f = fact_rows(spark, [("1", D(2024, 1, 1), "p", "x", 5, 1, "A", "s1", "AM"),
                          ("1", D(2024, 1, 2), "p", "x", 5, 1, "A", "s2", "AM")])
    shares = [r.portfolio_share_pct for r in R.seller_coverage(f).collect()]
    assert shares == [100.0, 100.0]                          # one customer buys from both


def test_header_tokens_of_one_letter_do_not_match(spark):
    df = spark.createDataFrame([("Cód Barras",), ("C D",), ("UN ",), ("Descrição",)], "column string")
    got = df.select(P.header_flag(F.col("column"), S.HEADER_KEYWORDS["product_code"]).alias("ean"),
                    P.header_flag(F.col("column"), S.HEADER_KEYWORDS["quantity"]).alias("qtd"),
                    P.header_flag(F.col("column"), S.HEADER_KEYWORDS["product_name"]).alias("prod")
                    ).collect()
    assert [r.ean for r in got] == [1.0, 0.0, 0.0, 0.0]
    assert got[2].qtd == 1.0 and got[1].qtd == 0.0
    assert got[3].prod == 1.0                                # "descri" is part of "descricao"


def test_stock_without_sales_and_mean_cover(spark):
    f = fact_rows(spark, [("1", D(2024, 1, 1), "p1", "x", 10, 2, "A", "s", "AM"),
                          ("1", D(2024, 1, 10), "p1", "x", 10, 2, "A", "s", "AM")])
    stock = spark.createDataFrame([("p1", 4), ("p2", 9)], "product_code string, units bigint")
    rows = {r.product_code: r for r in ST.stock_status(f, stock).collect()}
    # p1: 4 units sold over 10 days -> 0.4 a day; 4 in stock -> 10 days of cover
    assert rows["p1"].cover_days == 10.0 and rows["p1"].status == "CRITICO"
    assert rows["p1"].stock_value == 20.0                    # 4 units at 5.00
    assert rows["p2"].cover_days == S.NO_SALES_COVER_DAYS and rows["p2"].status == "ALTO"
    assert rows["p2"].unit_price is None and rows["p2"].stock_value == 0.0
    summ = ST.stock_summary(ST.stock_status(f, stock)).collect()[0]
    assert summ.mean_cover_days == 10.0                      # 999 left out
    assert summ.count_critico == 1 and summ.count_alto == 1 and summ.skus == 2
