"""Ingest operators on hand-written raw tables."""
from __future__ import annotations

import pytest

from salescope import schema as S
from salescope.operators import ingest
from salescope.plans.consolidate import Ingest, empty_fact

A_MAP = {"customer_name": "Cli", "customer_id": "Doc", "region": "UF", "sale_date": "Dt",
         "product_code": "EAN", "product_name": "Prod", "amount": "Val", "quantity": "Qt",
         "channel": "Canal"}
C_MAP = {"customer_id": "Doc", "sale_date": "Dt", "product_name": "Prod", "amount": "Val",
         "quantity": "Qt"}


def raw(spark, rows, cols):
    """An all-text table with its row order in ``_row_no``."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                                 ", ".join(f"`{c}` string" for c in cols) + ", _row_no long")


@pytest.fixture()
def sources(spark):
    cols_a = ["Cli", "Doc", "UF", "Dt", "EAN", "Prod", "Val", "Qt", "Canal"]
    a = raw(spark, [
        (" Farmacia X ", "12.345-6", " am ", "15/03/2024", "789", "Dipirona", "10.00", "2", " varejo "),
        ("Farmacia X", "123456", "AM", "15/03/2024", "789", "Dipirona", "10.00", "2", "VAREJO"),
        ("Farmacia Y", "999", "PA", "sem data", "790", "Soro", "5.00", "1", "VAREJO"),
        ("Farmacia Y", "999", "PA", "16/03/2024", "790", "Soro", "0", "1", "VAREJO"),
        ("Farmacia Y", "999", "PA", "16/03/2024", "790", "Soro", "x", "1", "VAREJO"),
    ], cols_a)
    b = raw(spark, [
        ("Farmacia X", "123456", "AM", "2024-03-15", "789", "Dipirona", "10.00", "2", "DIRETO"),
        ("Farmacia X", "123456", "AM", "2024-03-18", "789", "Dipirona Sodica 500mg", "20.00", "4", "DIRETO"),
        ("Farmacia Z", "777", "RO", "2024-03-17", "abc", "Vitamina C", "3.50", "0", "DIRETO"),
    ], cols_a)
    c = raw(spark, [("555", "45370", "Kit Teste", "8.00", "1")], ["Doc", "Dt", "Prod", "Val", "Qt"])
    d = raw(spark, [("a", "b")], ["Tipo", "Detalhe"])
    return [("a.csv", "Seller A", A_MAP, a), ("b.csv", "Seller B", A_MAP, b),
            ("c.csv", "Seller C", C_MAP, c), ("d.csv", "Seller D", {"channel": "Tipo"}, d)]


def test_standardize_fallbacks(spark, sources):
    _, _, m, c = sources[2]
    row = ingest.standardize(c, m, "Seller C", "c.csv").collect()[0]
    assert row.customer_name == "555"               # falls back to the raw id
    assert row.customer_id == "00000000000555"
    assert row.region == S.UNKNOWN_REGION
    assert row.channel == S.UNKNOWN_CHANNEL
    assert row.product_code == "SYN_KIT_TESTE"
    assert str(row.sale_date.date()) == "2024-03-19"  # Excel serial


def test_quarantine_and_log(spark, sources):
    ig = Ingest(spark, sources=sources)
    log = {r.source_file: r for r in ig.log().collect()}
    assert log["d.csv"].status == "error" and "customer_id" in log["d.csv"].error
    assert log["d.csv"].rows is None
    assert log["a.csv"].status == "ok" and log["a.csv"].rows == 5
    assert len(ig.frames) == 3


def test_consolidate_semantics(spark, sources):
    ig = Ingest(spark, sources=sources)
    fact = ig.fact()
    assert fact.columns == S.FACT_COLUMNS
    rows = fact.orderBy("customer_id", "sale_date").collect()
    # clean drops no-date, zero and unreadable amounts; dedup keeps the first file's copy
    x = [r for r in rows if r.customer_id == "00000000123456"]
    assert len(x) == 2
    assert x[0].seller == "Seller A" and x[0].source_file == "a.csv"
    assert x[0].channel == "VAREJO" and x[0].region == "AM"
    # the canonical name is the longest name of the code among the kept rows
    assert {r.product_canon for r in x} == {"Dipirona Sodica 500mg"}
    # a non-numeric code becomes the synthetic code; quantity 0 -> unit price = amount
    z = [r for r in rows if r.customer_id == "00000000000777"][0]
    assert z.product_code == "SYN_VITAMINA_C" and z.unit_price == 3.5
    assert {r.customer_id for r in rows} == {"00000000123456", "00000000000777",
                                             "00000000000555"}


def test_dedup_idempotent_and_order_free(spark, sources):
    ig = Ingest(spark, sources=sources)
    once = ig.deduped()
    twice = ingest.distinct_dedup(once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    shuffled = ingest.distinct_dedup(ig.cleaned().repartition(7))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, shuffled.collect()))


def test_empty_fact_schema(spark):
    df = empty_fact(spark)
    assert df.count() == 0 and df.schema == S.FACT_SCHEMA
