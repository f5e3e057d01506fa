"""Written forms of dates, amounts and product names, made from the given tables.

Every order or part is written in one of many forms (chosen by its key) and
read back by the library's rules. The oracle never parses: it takes the value
from the table and states what each form must give.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions import expressions as E
from ..sources.tables import read_table


def _pick(key: Column, forms: list[Column]) -> Column:
    out = F.when(key == 0, forms[0])
    for k, form in enumerate(forms[1:], 1):
        out = out.when(key == k, form)
    return out


# Portuguese month names.
MONTH_NAMES = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro",
               "novembro", "dezembro"]


def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 on twenty written forms of the order dates."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))

    def written(fmt: str) -> Column:
        return F.date_format("d", fmt)

    serial = F.datediff("d", F.lit(S.EXCEL_EPOCH).cast("date")).cast("string")
    text = _pick(F.col("o_orderkey") % 20, [
        written("dd/MM/yy"), written("yyyy/MM/dd"), written("yyyyMMdd"),
        F.concat(written("yyyy-MM-dd"), F.lit("T10:00:00Z")),
        F.concat(written("yyyy-MM-dd"), F.lit(" 10:00:00+03:00")),
        F.lower(written("dd-MMM-yyyy")), F.lower(written("dd MMM yyyy")), written("MM/dd/yyyy"),
        F.concat(written("dd/MM/yyyy"), F.lit(" 10:00:00.123")),
        F.concat(written("dd/MM/yyyy"), F.lit(" 2:00 PM")), written("yyyy-MM"), F.lit("sem data"),
        F.concat(serial, F.lit(".5")),
        written("MMM d, yyyy"), written("MMMM dd yyyy"), F.concat(written("EEE, "), written("d MMM yyyy")),
        F.concat(written("yyyyMMdd"), F.lit(" 10:30")), written("yyyy MMM dd"),
        F.concat(written("dd"), F.lit(" de "), F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month("d")), F.lit(" de "), written("yyyy")),
        F.concat(F.lit("seg, "), written("dd/MM/yyyy"), F.lit(" 9:05"))])
    return orders.select("o_orderkey", text.alias("text")).select(
        "o_orderkey", "text", E.parse_mixed_date("text").alias("value"))


DATE_FORMS = f"""
SELECT o_orderkey,
  CASE o_orderkey % 20 WHEN 0 THEN strftime(d, '%d/%m/%y') WHEN 1 THEN strftime(d, '%Y/%m/%d')
    WHEN 2 THEN strftime(d, '%Y%m%d') WHEN 3 THEN strftime(d, '%Y-%m-%d') || 'T10:00:00Z'
    WHEN 4 THEN strftime(d, '%Y-%m-%d') || ' 10:00:00+03:00' WHEN 5 THEN lower(strftime(d, '%d-%b-%Y'))
    WHEN 6 THEN lower(strftime(d, '%d %b %Y')) WHEN 7 THEN strftime(d, '%m/%d/%Y')
    WHEN 8 THEN strftime(d, '%d/%m/%Y') || ' 10:00:00.123' WHEN 9 THEN strftime(d, '%d/%m/%Y') || ' 2:00 PM'
    WHEN 10 THEN strftime(d, '%Y-%m') WHEN 11 THEN 'sem data'
    WHEN 12 THEN CAST(date_diff('day', DATE '1899-12-30', d) AS VARCHAR) || '.5'
    WHEN 13 THEN strftime(d, '%b %-d, %Y') WHEN 14 THEN strftime(d, '%B %d %Y') WHEN 15 THEN strftime(d, '%a, %-d %b %Y')
    WHEN 16 THEN strftime(d, '%Y%m%d') || ' 10:30' WHEN 17 THEN strftime(d, '%Y %b %d')
    WHEN 18 THEN strftime(d, '%d') || ' de ' || {MONTH_NAMES}[month(d)] || ' de ' || strftime(d, '%Y')
    ELSE 'seg, ' || strftime(d, '%d/%m/%Y') || ' 9:05' END AS text,
  CASE o_orderkey % 20 WHEN 3 THEN d + INTERVAL 10 HOUR WHEN 4 THEN d + INTERVAL 10 HOUR
    WHEN 7 THEN CASE WHEN day(d) > 12 THEN CAST(d AS TIMESTAMP)
                ELSE CAST(make_date(year(d), day(d), month(d)) AS TIMESTAMP) END
    WHEN 8 THEN d + INTERVAL 36000123 MILLISECOND WHEN 9 THEN d + INTERVAL 14 HOUR
    WHEN 10 THEN CAST(date_trunc('month', d) AS TIMESTAMP) WHEN 11 THEN NULL
    WHEN 12 THEN d + INTERVAL 12 HOUR WHEN 16 THEN d + INTERVAL 630 MINUTE WHEN 19 THEN d + INTERVAL 545 MINUTE
    ELSE CAST(d AS TIMESTAMP) END AS value
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
"""


def amount_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 on written forms of the order totals, very large and very small ones too."""
    plain = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = _pick(F.col("o_orderkey") % 7, [
        plain, F.lit("1e17"), F.lit("99999999999999999.99"), F.lit("0.004"), F.lit("x"),
        F.concat(F.lit(" "), plain, F.lit(" ")), F.concat(F.lit("-"), plain)])
    return (read_table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
            .select("o_orderkey", "text", E.coerce_amount("text").alias("value")))


AMOUNT_FORMS = """
SELECT o_orderkey,
  CASE o_orderkey % 7 WHEN 1 THEN '1e17' WHEN 2 THEN '99999999999999999.99' WHEN 3 THEN '0.004' WHEN 4 THEN 'x'
    WHEN 5 THEN ' ' || CAST(p AS VARCHAR) || ' ' WHEN 6 THEN '-' || CAST(p AS VARCHAR) ELSE CAST(p AS VARCHAR) END AS text,
  CAST(CASE o_orderkey % 7 WHEN 1 THEN CAST('100000000000000000' AS DECIMAL(38,6))
    WHEN 2 THEN CAST('99999999999999999.99' AS DECIMAL(38,6)) WHEN 3 THEN CAST('0.004' AS DECIMAL(38,6))
    WHEN 4 THEN CAST(0 AS DECIMAL(38,6)) WHEN 6 THEN -CAST(p AS DECIMAL(38,6)) ELSE CAST(p AS DECIMAL(38,6)) END
    AS DECIMAL(38,6)) AS value
FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)
"""

# Written beginning of a product name and the ASCII it stands for.
NAME_FORMS = [("", ""), ("ﬁlme ", "filme "), ("São ½ ﬂor ", "Sao 12 flor "), ("㎏ ", "kg "), ("ﬃ", "ffi"), ("𝐀ção ", "Acao ")]


def slug_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 on product names that begin with ligatures, fractions, unit signs and mathematical letters."""
    begin = _pick(F.col("p_partkey") % len(NAME_FORMS), [F.lit(written) for written, _ in NAME_FORMS])
    text = F.concat(begin, F.col("p_name"))
    return (read_table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
            .select("p_partkey", "text", E.synthetic_code("text").alias("value")))


def _cases(side: int) -> str:
    return " ".join(f"WHEN {k} THEN '{form[side]}'" for k, form in enumerate(NAME_FORMS))


SLUG_FORMS = f"""
SELECT p_partkey, written || p_name AS text,
  'SYN_' || substr(upper(regexp_replace(regexp_replace(plain || p_name, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')),
                   1, 24) AS value
FROM (SELECT p_partkey, p_name, CASE p_partkey % {len(NAME_FORMS)} {_cases(0)} END AS written,
             CASE p_partkey % {len(NAME_FORMS)} {_cases(1)} END AS plain FROM part)
"""
