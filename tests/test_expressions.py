"""Unit tests of the standardising expressions on hand-written rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salescope.functions import expressions as E
from salescope.functions.numeric import half_up, ratio, share_pct


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_normalize_id_digits_and_zero_fill(spark):
    got = one_col(spark, ["12.345.678/0001-90", "123", "", None, "123456789012345678"],
                  E.normalize_id)
    # longer ids stay whole (zero-fill does not truncate); no digits -> all zeros
    assert got == ["12345678000190", "00000000000123", "00000000000000", None,
                   "123456789012345678"]


def test_parse_mixed_date_serial_bounds_and_text(spark):
    got = one_col(spark, ["35000", "35000.5", "20000", "80000", "5", "15/03/1998",
                          "1/2/2003 10:30", "15-03-1998 10:30:15", "15.03.1998",
                          "1998-03-15", "2024-01-01 00:00:07", "sem data", "", None],
                  E.parse_mixed_date)
    assert got[0] == dt.datetime(1995, 10, 28)
    assert got[1] == dt.datetime(1995, 10, 28, 12, 0)       # fraction of a day kept
    assert got[2] is None and got[3] is None                  # bounds are exclusive
    assert got[4] is None                                     # other numbers are NULL
    assert got[5] == dt.datetime(1998, 3, 15)
    assert got[6] == dt.datetime(2003, 2, 1, 10, 30)          # day first
    assert got[7] == dt.datetime(1998, 3, 15, 10, 30, 15)
    assert got[8] == dt.datetime(1998, 3, 15)
    assert got[9] == dt.datetime(1998, 3, 15)
    assert got[10] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got[11:] == [None, None, None]


def test_synthetic_code(spark):
    got = one_col(spark, ["Dipirona Sódica 500mg — caixa c/ 10 comprimidos", "  __a--b__ ",
                          None, "Ação"], E.synthetic_code)
    assert got[0] == "SYN_DIPIRONA_SODICA_500MG_CA"  # 24 characters of the slug
    assert len(got[0]) == 4 + 24
    assert got[1] == "SYN_A_B"
    assert got[2] == "SYN_"
    assert got[3] == "SYN_ACAO"


def test_numeric_code(spark):
    assert one_col(spark, ["7891234567890", " 123.0 ", "abc", None], E.numeric_code) == \
        ["7891234567890", "123", None, None]


def test_coerce_amount_and_quantity(spark):
    amounts = one_col(spark, ["10.5", "x", "", "-1", None], E.coerce_amount)
    assert [float(a) for a in amounts] == [10.5, 0.0, 0.0, -1.0, 0.0]
    # quantity truncates toward zero
    assert one_col(spark, ["3.9", "-2.7", "x", None], E.coerce_quantity) == [3, -2, 0, 0]


def test_unit_price_guard(spark):
    df = spark.createDataFrame([(10.0, 4), (7.0, 0), (5.0, -1)], "amount double, quantity long")
    got = [r[0] for r in df.select(E.unit_price()).collect()]
    assert got == [2.5, 7.0, 5.0]


def test_half_up_rounding_and_guards(spark):
    df = spark.createDataFrame([(2.675, 0), (1.005, 2), (10.0, 3)], "x double, d long")
    got = df.select(half_up("x").alias("r"), ratio("x", "d").alias("q"),
                    share_pct("x", F.lit(0.0)).alias("s")).collect()
    # half up on the binary product: 2.675 * 100 is exactly 267.5, 1.005 * 100 is below
    assert [r.r for r in got] == [2.68, 1.0, 10.0]
    assert got[0].q == got[0].r            # divisor 0 counts as 1
    assert got[2].q == 3.33
    assert got[2].s == 1000.0              # zero total counts as 1
