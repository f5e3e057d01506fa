"""Oracle SQL of the group reports (see :mod:`salescope.plans.oracle`)."""
from __future__ import annotations

from .oracle import with_fact

TOTAL = ("(SELECT CASE WHEN t = 0 OR t IS NULL THEN 1.0::DOUBLE ELSE t END "
         "FROM (SELECT CAST(sum(amount) AS DOUBLE) AS t FROM fact))")


def argmax_sql(key: str, label: str, out: str) -> str:
    return f"""(SELECT {key}, {label} AS {out} FROM (
      SELECT {key}, {label}, row_number() OVER (
        PARTITION BY {key} ORDER BY sum(amount) DESC, {label}) AS rn
      FROM fact WHERE {key} IS NOT NULL AND {label} IS NOT NULL
      GROUP BY {key}, {label}) WHERE rn = 1)"""


def _group(key: str, distinct: dict[str, str]) -> str:
    d = ", ".join(f"count(DISTINCT {c}) AS {n}" for n, c in distinct.items())
    return (f"(SELECT {key}, sum(amount) AS a, CAST(sum(quantity) AS BIGINT) AS units, "
            f"count(*) AS transactions, {d} FROM fact WHERE {key} IS NOT NULL GROUP BY {key})")


A = "CAST(g.a AS DOUBLE)"


def _ratio(num: str, den: str) -> str:
    return f"ROUND2(CAST({num} AS DOUBLE) / CAST(greatest({den}, 1) AS DOUBLE))"


def _share(part: str) -> str:
    return f"ROUND2(100.0::DOUBLE * CAST({part} AS DOUBLE) / {TOTAL})"


KPIS = with_fact(f"""
SELECT CAST(coalesce(a, 0) AS DOUBLE) AS total_amount, coalesce(q, 0) AS units,
       {_ratio('coalesce(a,0)', 'customers')} AS ticket_customer,
       {_ratio('coalesce(a,0)', 'n')} AS ticket_tx,
       {_ratio('coalesce(a,0)', 'coalesce(q,0)')} AS unit_price,
       {_ratio('coalesce(q,0)', 'n')} AS units_per_tx,
       customers, products, sellers, channels, regions, n AS transactions, active_days,
       {_ratio('coalesce(a,0)', 'active_days')} AS amount_per_day,
       {_ratio('coalesce(q,0)', 'active_days')} AS units_per_day,
       {_ratio('n', 'active_days')} AS tx_per_day
FROM (SELECT sum(amount) AS a, CAST(sum(quantity) AS BIGINT) AS q, count(*) AS n,
             count(DISTINCT customer_id) AS customers, count(DISTINCT product_code) AS products,
             count(DISTINCT seller) AS sellers, count(DISTINCT channel) AS channels,
             count(DISTINCT region) AS regions, count(DISTINCT sale_date) AS active_days
      FROM fact)
""")

BY_SELLER = with_fact(f"""
SELECT g.seller, {A} AS amount, g.units, g.customers, g.transactions, g.active_days,
       g.products, g.regions, g.channels,
       {_ratio(A, 'g.customers')} AS ticket,
       {_ratio(A, 'g.transactions')} AS ticket_tx,
       {_ratio(A, 'g.units')} AS unit_price,
       {_share('g.a')} AS share_pct,
       bc.best_channel, br.best_region, bp.best_product
FROM {_group('seller', {'customers': 'customer_id', 'active_days': 'sale_date',
                        'products': 'product_code', 'regions': 'region', 'channels': 'channel'})} g
LEFT JOIN {argmax_sql('seller', 'channel', 'best_channel')} bc ON g.seller = bc.seller
LEFT JOIN {argmax_sql('seller', 'region', 'best_region')} br ON g.seller = br.seller
LEFT JOIN {argmax_sql('seller', 'product_canon', 'best_product')} bp ON g.seller = bp.seller
""")

BY_CHANNEL = with_fact(f"""
SELECT g.channel, {A} AS amount, g.units, g.customers, g.transactions, g.sellers,
       g.products, g.regions,
       {_ratio(A, 'g.customers')} AS ticket, {_ratio(A, 'g.units')} AS unit_price,
       {_share('g.a')} AS share_pct
FROM {_group('channel', {'customers': 'customer_id', 'sellers': 'seller',
                         'products': 'product_code', 'regions': 'region'})} g
""")

BY_REGION = with_fact(f"""
SELECT g.region, {A} AS amount, g.units, g.customers, g.transactions, g.sellers, g.products,
       {_ratio(A, 'g.customers')} AS ticket, {_ratio(A, 'g.units')} AS unit_price,
       {_share('g.a')} AS share_pct
FROM {_group('region', {'customers': 'customer_id', 'sellers': 'seller',
                        'products': 'product_code'})} g
""")

TOP_PRODUCTS = with_fact(f"""
SELECT g.product_code, g.product_canon, {A} AS amount, g.units, g.customers, g.transactions,
       g.regions, g.sellers, g.channels, {_ratio(A, 'g.units')} AS unit_price,
       {_share('g.a')} AS share_pct
FROM (SELECT product_code, product_canon, sum(amount) AS a,
             CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT customer_id) AS customers,
             count(*) AS transactions, count(DISTINCT region) AS regions,
             count(DISTINCT seller) AS sellers, count(DISTINCT channel) AS channels
      FROM fact WHERE product_code IS NOT NULL AND product_canon IS NOT NULL
      GROUP BY product_code, product_canon) g
ORDER BY g.a DESC, g.product_code, g.product_canon
LIMIT 30
""")

SELLER_COVERAGE = with_fact(f"""
SELECT g.seller, g.active_customers, g.active_days, {A} AS amount, g.units, g.transactions,
       g.regions, g.products,
       {_ratio(A, 'g.active_customers')} AS amount_per_customer,
       {_ratio('g.units', 'g.active_customers')} AS units_per_customer,
       {_ratio('g.transactions', 'g.active_customers')} AS tx_per_customer,
       ROUND2(100.0::DOUBLE * CAST(g.active_customers AS DOUBLE) /
              CAST(greatest((SELECT count(DISTINCT customer_id) FROM fact), 1) AS DOUBLE))
         AS portfolio_share_pct
FROM {_group('seller', {'active_customers': 'customer_id', 'active_days': 'sale_date',
                        'regions': 'region', 'products': 'product_code'})} g
""")


def _coverage(key_expr: str, name: str) -> str:
    return with_fact(f"""
SELECT {key_expr} AS {name}, count(DISTINCT customer_id) AS customers,
       CAST(sum(amount) AS DOUBLE) AS amount
FROM fact WHERE {key_expr} IS NOT NULL GROUP BY 1
""")


COVERAGE_BY_REGION = _coverage("region", "region")
COVERAGE_BY_CHANNEL = _coverage("channel", "channel")
COVERAGE_BY_MONTH = _coverage("CAST(date_trunc('month', sale_date) AS DATE)", "month")


def _peak(bucket: str, name: str) -> str:
    return f"""(SELECT {bucket} AS p, sum(amount) AS v, CAST(sum(quantity) AS BIGINT) AS q
      FROM fact GROUP BY 1 ORDER BY v DESC, p LIMIT 1) {name}"""


def _best(key: str, name: str) -> str:
    return f"""(SELECT {key} AS lbl, sum(amount) AS v FROM fact WHERE {key} IS NOT NULL
      GROUP BY 1 ORDER BY v DESC, lbl LIMIT 1) {name}"""


def _top(key: str) -> str:
    return f"""coalesce((SELECT sum(v) FROM (SELECT sum(amount) AS v FROM fact
      WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY v DESC, {key} LIMIT 10)), 0)"""


HIGHLIGHTS = with_fact(f"""
SELECT d.p AS best_day, CAST(d.v AS DOUBLE) AS best_day_amount, d.q AS best_day_units,
       w.p AS best_week, CAST(w.v AS DOUBLE) AS best_week_amount, w.q AS best_week_units,
       m.p AS best_month, CAST(m.v AS DOUBLE) AS best_month_amount, m.q AS best_month_units,
       bs.lbl AS best_seller, CAST(bs.v AS DOUBLE) AS best_seller_amount,
       bp.lbl AS best_product, CAST(bp.v AS DOUBLE) AS best_product_amount,
       bc.lbl AS best_channel, CAST(bc.v AS DOUBLE) AS best_channel_amount,
       br.lbl AS best_region, CAST(br.v AS DOUBLE) AS best_region_amount,
       {_share(_top('product_canon'))} AS top10_products_pct,
       {_share(_top('customer_id'))} AS top10_customers_pct,
       {_share('bs.v')} AS top1_seller_pct,
       {_share('bc.v')} AS top1_channel_pct,
       {_share('br.v')} AS top1_region_pct
FROM {_peak('sale_date', 'd')},
     {_peak("CAST(date_trunc('week', sale_date) AS DATE)", 'w')},
     {_peak("CAST(date_trunc('month', sale_date) AS DATE)", 'm')},
     {_best('seller', 'bs')}, {_best('product_canon', 'bp')},
     {_best('channel', 'bc')}, {_best('region', 'br')}
""")

ARGMAX_PER_SELLER = with_fact(f"""
SELECT s.seller, a.best_channel, b.best_region, c.best_product
FROM (SELECT DISTINCT seller FROM fact WHERE seller IS NOT NULL) s
LEFT JOIN {argmax_sql('seller', 'channel', 'best_channel')} a ON s.seller = a.seller
LEFT JOIN {argmax_sql('seller', 'region', 'best_region')} b ON s.seller = b.seller
LEFT JOIN {argmax_sql('seller', 'product_canon', 'best_product')} c ON s.seller = c.seller
""")


PRODUCT_RANK = with_fact(f"""
SELECT row_number() OVER (ORDER BY amount DESC, product_code, product_canon) AS rank,
       product_code, product_canon, amount, share_pct
FROM (SELECT g.product_code, g.product_canon, {A} AS amount, {_share('g.a')} AS share_pct
      FROM (SELECT product_code, product_canon, sum(amount) AS a FROM fact
            WHERE product_code IS NOT NULL AND product_canon IS NOT NULL
            GROUP BY product_code, product_canon) g
      ORDER BY g.a DESC, g.product_code, g.product_canon LIMIT 30)
""")

BASIC_BY_SELLER = with_fact("""
SELECT seller, CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT customer_id) AS customers,
       CAST(sum(amount) AS DOUBLE) AS amount
FROM fact WHERE seller IS NOT NULL GROUP BY seller
""")



def basic_by(key: str) -> str:
    return with_fact(f"""
SELECT {key}, CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(amount) AS DOUBLE) AS amount
FROM fact WHERE {key} IS NOT NULL GROUP BY {key}
""")


FACT = with_fact("SELECT * FROM fact")

REPORT_META = with_fact("""
SELECT false AS empty, strftime(min(sale_date), '%Y-%m-%d') AS date_min,
       strftime(max(sale_date), '%Y-%m-%d') AS date_max, 14 AS horizon_days,
       'Seller comes from the source file (one file per distributor). | '
       || 'Stock cover uses the given stock table (target cover 60 days). | '
       || 'Forecast: least squares on the ordinal of selling days, band of 1.5 sigma of residuals.' AS notes
FROM fact
""")


# A fact without rows: the metadata says so, and no report is written.
EMPTY_STATE = """
SELECT count(*) = 0 AS empty, CAST(min(l_shipdate) AS VARCHAR) AS date_min, CAST(max(l_shipdate) AS VARCHAR) AS date_max,
       CAST(NULL AS INTEGER) AS horizon_days, 'No file loaded: upload files to see the figures.' AS notes,
       CAST(count(*) AS INTEGER) AS reports
FROM lineitem WHERE l_extendedprice < 0
"""


# Distinct customers and amounts of every seller, region, channel, month and of all, each from the fact.
COVERAGE_FROM_STATE = with_fact("\nUNION ALL ".join(
    f"""SELECT '{name}' AS dimension, {key} AS value, count(DISTINCT customer_id) AS customers,
       CAST(CAST(sum(amount) AS VARCHAR) AS DOUBLE) AS amount FROM fact WHERE {key} IS NOT NULL GROUP BY 2"""
    for name, key in [("seller", "seller"), ("region", "region"), ("channel", "channel"),
                      ("month", "strftime(date_trunc('month', sale_date), '%Y-%m-%d')"), ("total", "''")]))
