"""Oracle SQL: each registered query as plain ANSI SQL (DuckDB dialect) over the
given tables, for side-by-side checks. Same column names as the Spark side.

``ROUND2(x)`` in the text stands for the library's rounding
(``floor(x * 100 + 0.5) / 100`` on doubles), expanded by :func:`_r`. With six
digits, where ids of 14 digits leave the range of exact doubles, a value
without such a digit stays as it is.
"""
from __future__ import annotations

import re

# Consolidation of a stacked standard table ``std`` (columns customer_name,
# customer_id, region, sale_ts, product_code, product_name, amount, quantity,
# channel, seller, source_file, source_rank, row_no): clean, dedup on
# (customer, date-time, code, amount, quantity) keeping the first row in
# (source, row) order, canonical name, unit price.
CONSOLIDATE_CTE = """
valid AS (SELECT * FROM std WHERE sale_ts IS NOT NULL AND amount > 0),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY customer_id, sale_ts, product_code, amount, quantity
      ORDER BY source_rank, row_no NULLS FIRST, customer_name NULLS FIRST, region NULLS FIRST,
               product_name NULLS FIRST, channel NULLS FIRST, seller NULLS FIRST,
               source_file NULLS FIRST) AS rn
    FROM valid) WHERE rn = 1
),
canon AS (
  SELECT product_code,
         first(product_name ORDER BY length(product_name) DESC, product_name DESC) AS product_canon
  FROM dedup WHERE product_code IS NOT NULL AND product_name IS NOT NULL
  GROUP BY product_code
),
fact AS (
  SELECT d.customer_name, d.customer_id, d.region, CAST(d.sale_ts AS DATE) AS sale_date,
         d.product_code, d.product_name, d.amount, d.quantity, d.channel, d.seller,
         d.source_file, coalesce(k.product_canon, d.product_name) AS product_canon,
         CASE WHEN d.quantity > 0 THEN CAST(CAST(d.amount AS VARCHAR) AS DOUBLE) / d.quantity
              ELSE CAST(CAST(d.amount AS VARCHAR) AS DOUBLE) END AS unit_price
  FROM dedup d LEFT JOIN canon k ON d.product_code = k.product_code
)"""


def sql_norm_id(x: str) -> str:
    d = f"regexp_replace(CAST({x} AS VARCHAR), '\\D', '', 'g')"
    return f"(CASE WHEN length({d}) < 14 THEN lpad({d}, 14, '0') ELSE {d} END)"


# The fact table from the order tables (FIXTURES §3), consolidated.
FACT_CTE = f"""
std AS (
  SELECT trim(c.c_name) AS customer_name,
         {sql_norm_id('c.c_custkey')} AS customer_id,
         upper(trim(n.n_name)) AS region,
         CAST(l.l_shipdate AS TIMESTAMP) AS sale_ts,
         CAST(p.p_partkey AS VARCHAR) AS product_code,
         trim(p.p_name) AS product_name,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(trunc(l.l_quantity) AS BIGINT) AS quantity,
         upper(trim(c.c_mktsegment)) AS channel,
         s.s_name AS seller,
         'lineitem' AS source_file,
         0 AS source_rank,
         l.l_orderkey * 16 + l.l_linenumber AS row_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),{CONSOLIDATE_CTE}"""


def _r(sql: str) -> str:
    """Expand ROUNDn(x) into the library's half-up rounding on doubles."""
    out = []
    i = 0
    pat = re.compile(r"ROUND(\d)\(")
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            break
        out.append(sql[i:m.start()])
        depth, j = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        inner = _r(sql[m.end():j - 1])
        scale = f"{10 ** int(m.group(1))}.0"
        if m.group(1) == "6":
            out.append(f"(list_transform([CAST({inner} AS DOUBLE)], lambda v: CASE WHEN abs(v * {scale}) < {2 ** 52}.0 "
                       f"THEN floor(v * {scale} + 0.5) / {scale} ELSE v END)[1])")
        else:
            out.append(f"(floor(CAST({inner} AS DOUBLE) * {scale} + 0.5) / {scale})")
        i = j
    return "".join(out)


def with_fact(body: str) -> str:
    return _r(f"WITH {FACT_CTE}\n{body}")
