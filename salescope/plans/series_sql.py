"""Oracle SQL of the time series, forecast and customer reports."""
from __future__ import annotations

from .oracle import with_fact


def _series(bucket: str) -> str:
    return with_fact(f"""
SELECT {bucket} AS period, CAST(sum(amount) AS DOUBLE) AS amount,
       CAST(sum(quantity) AS BIGINT) AS units, count(*) AS transactions,
       count(DISTINCT customer_id) AS customers
FROM fact WHERE sale_date IS NOT NULL GROUP BY 1
""")


WEEK = "CAST(date_trunc('week', sale_date) AS DATE)"
MONTH = "CAST(date_trunc('month', sale_date) AS DATE)"
DAILY_SALES = _series("sale_date")
WEEKLY_SALES = _series(WEEK)
MONTHLY_SALES = _series(MONTH)

SERIES_SUMMARY = with_fact(f"""
SELECT r.granularity, r.periods, CAST(coalesce(a, 0) AS DOUBLE) AS total_amount,
       CASE WHEN r.periods > 0 THEN
         ROUND2(CAST(coalesce(a, 0) AS DOUBLE) / CAST(greatest(r.periods, 1) AS DOUBLE))
       ELSE 0.0::DOUBLE END AS mean_amount,
       coalesce(q, 0) AS units, n AS transactions
FROM (SELECT sum(amount) AS a, CAST(sum(quantity) AS BIGINT) AS q, count(*) AS n,
             count(DISTINCT sale_date) AS d, count(DISTINCT {WEEK}) AS w,
             count(DISTINCT {MONTH}) AS m
      FROM fact WHERE sale_date IS NOT NULL) g,
     LATERAL (VALUES ('day', g.d), ('week', g.w), ('month', g.m)) r(granularity, periods)
""")

XY = """xy AS (
  SELECT sale_date, row_number() OVER (ORDER BY sale_date) - 1 AS day_index,
         CAST(sum(amount) AS DOUBLE) AS amount
  FROM fact WHERE sale_date IS NOT NULL GROUP BY sale_date)"""

DAY_INDEX = with_fact(f", {XY}\nSELECT sale_date, day_index, amount FROM xy")

TRAILING_MEAN_7 = with_fact(f""", {XY}
SELECT count(*) AS days, ROUND2(avg(amount)) AS moving_avg_7d
FROM (SELECT amount FROM xy ORDER BY sale_date DESC LIMIT 7)
""")


def peak_period_sql(granularity: str = "day") -> str:
    period = "sale_date" if granularity == "day" else f"CAST(date_trunc('{granularity}', sale_date) AS DATE)"
    return with_fact(f"""
SELECT '{granularity}' AS granularity, {period} AS period, CAST(sum(amount) AS DOUBLE) AS amount,
       CAST(sum(quantity) AS BIGINT) AS units
FROM fact WHERE sale_date IS NOT NULL GROUP BY {period}
ORDER BY sum(amount) DESC, {period} LIMIT 1
""")


PEAK_PERIOD = peak_period_sql()

FIT = f""", {XY},
line AS (
  SELECT count(*) AS n, max(sale_date) AS last_date,
         regr_slope(amount, day_index) AS slope, regr_intercept(amount, day_index) AS intercept,
         coalesce(regr_r2(amount, day_index), 1.0) AS r2
  FROM xy),
res AS (SELECT x.amount, x.amount - (l.intercept + l.slope * x.day_index) AS r
        FROM xy x, line l),
st AS (SELECT stddev_pop(r) AS sigma, avg(abs(r)) AS mae,
              coalesce(avg(CASE WHEN amount <> 0 THEN abs(r / amount) END) * 100.0::DOUBLE,
                       0.0::DOUBLE) AS mape
       FROM res),
ma AS (SELECT avg(amount) AS moving_avg_7d
       FROM (SELECT amount FROM xy ORDER BY sale_date DESC LIMIT 7)),
p AS (SELECT * FROM line, st, ma WHERE n >= 2),
h AS (
  SELECT CAST(p.last_date + CAST(s.step AS INTEGER) AS DATE) AS sale_date,
         greatest(p.intercept + p.slope * CAST(p.n - 1 + s.step AS DOUBLE), 0.0) AS forecast,
         greatest(p.intercept + p.slope * CAST(p.n - 1 + s.step AS DOUBLE)
                  - 1.5 * p.sigma, 0.0) AS lower,
         p.intercept + p.slope * CAST(p.n - 1 + s.step AS DOUBLE) + 1.5 * p.sigma AS upper,
         p.moving_avg_7d
  FROM p, range(1, 15) s(step))"""

SALES_FORECAST = with_fact(FIT + """
SELECT sale_date, ROUND2(forecast) AS forecast, ROUND2(lower) AS lower,
       ROUND2(upper) AS upper, ROUND2(moving_avg_7d) AS moving_avg_7d
FROM h
""")

FORECAST_METRICS = with_fact(FIT + """
SELECT ROUND4(p.r2) AS r2, ROUND2(p.mae) AS mae, ROUND2(p.mape) AS mape_pct,
       ROUND2(p.slope) AS slope, ROUND2(p.intercept) AS intercept,
       CAST(14 AS BIGINT) AS horizon_days,
       ROUND2((SELECT sum(forecast) FROM h)) AS total_forecast,
       ROUND2((SELECT sum(forecast) / greatest(count(*), 1) FROM h)) AS mean_daily_forecast,
       ROUND2((SELECT sum(lower) FROM h)) AS min_forecast,
       ROUND2((SELECT sum(upper) FROM h)) AS max_forecast
FROM p
""")

ACTUAL_PLUS_FORECAST = with_fact(FIT + """
SELECT sale_date, ROUND2(amount) AS amount, NULL::DOUBLE AS forecast, NULL::DOUBLE AS lower,
       NULL::DOUBLE AS upper FROM xy
UNION ALL
SELECT sale_date, NULL::DOUBLE, ROUND2(forecast), ROUND2(lower), ROUND2(upper) FROM h
""")

# ---------------------------------------------------------------- customers

REF = "(SELECT max(sale_date) FROM fact)"

CUSTOMER_LIFECYCLE = with_fact(f"""
SELECT count(*) AS total_customers,
       count(*) FILTER (WHERE date_diff('day', first, {REF}) <= 7) AS new_7d,
       count(*) FILTER (WHERE days > 1) AS recurring,
       count(*) FILTER (WHERE days = 1) AS one_time,
       count(*) FILTER (WHERE date_diff('day', last, {REF}) > 30) AS inactive_30d
FROM (SELECT customer_id, min(sale_date) AS first, max(sale_date) AS last,
             count(DISTINCT sale_date) AS days
      FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id)
""")


def _mode(col: str) -> str:
    return f"""(SELECT customer_id, v AS {col} FROM (
      SELECT customer_id, {col} AS v, row_number() OVER (
        PARTITION BY customer_id ORDER BY count(*) DESC, {col}) AS rn
      FROM fact WHERE customer_id IS NOT NULL AND {col} IS NOT NULL
      GROUP BY customer_id, {col}) WHERE rn = 1)"""


TOP_PRODUCT = """(SELECT customer_id, product_canon AS top_product,
        CAST(v AS DOUBLE) AS top_product_amount FROM (
      SELECT customer_id, product_canon, sum(amount) AS v, row_number() OVER (
        PARTITION BY customer_id ORDER BY sum(amount) DESC, product_canon) AS rn
      FROM fact WHERE customer_id IS NOT NULL AND product_canon IS NOT NULL
      GROUP BY customer_id, product_canon) WHERE rn = 1)"""

MODE_COLS = ["customer_name", "region", "channel", "seller"]
_MODE_JOINS = "\n".join(f"LEFT JOIN {_mode(c)} m_{c} ON g.customer_id = m_{c}.customer_id"
                        for c in MODE_COLS)
_MODE_SELECT = ", ".join(f"coalesce(m_{c}.{c}, '') AS {c}" for c in MODE_COLS)

DETAIL_BODY = f"""
detail AS (
SELECT g.customer_id, {_MODE_SELECT},
       CAST(g.a AS DOUBLE) AS amount, g.units, g.transactions, g.active_days, g.products,
       g.first_purchase, g.last_purchase,
       date_diff('day', g.last_purchase, {REF}) AS recency_days,
       ROUND2(CAST(g.a AS DOUBLE) / CAST(greatest(g.transactions, 1) AS DOUBLE)) AS ticket,
       t.top_product, t.top_product_amount
FROM (SELECT customer_id, sum(amount) AS a, CAST(sum(quantity) AS BIGINT) AS units,
             count(*) AS transactions, count(DISTINCT sale_date) AS active_days,
             count(DISTINCT product_code) AS products, min(sale_date) AS first_purchase,
             max(sale_date) AS last_purchase
      FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id) g
{_MODE_JOINS}
LEFT JOIN {TOP_PRODUCT} t ON g.customer_id = t.customer_id)"""

CUSTOMER_DETAIL = with_fact(f", {DETAIL_BODY}\nSELECT * FROM detail")

MODE_PER_CUSTOMER = with_fact(f"""
SELECT g.customer_id, {_MODE_SELECT}
FROM (SELECT DISTINCT customer_id FROM fact WHERE customer_id IS NOT NULL) g
{_MODE_JOINS}
""")

TOP_PRODUCT_PER_CUSTOMER = with_fact(f"SELECT * FROM {TOP_PRODUCT}")

RFM = with_fact(f"""
SELECT customer_id, date_diff('day', max(sale_date), {REF}) AS recency,
       count(DISTINCT sale_date) AS frequency, CAST(sum(amount) AS DOUBLE) AS monetary
FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id
""")


def _z(c: str) -> str:
    return (f"ROUND6(CASE WHEN (SELECT stddev_pop({c}) FROM rfm) > 0 THEN "
            f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM rfm)) / (SELECT stddev_pop({c}) FROM rfm) "
            f"ELSE 0.0 END) AS z_{c}")


RFM_STANDARDIZED = with_fact(f""", rfm AS (
SELECT customer_id, date_diff('day', max(sale_date), {REF}) AS recency,
       count(DISTINCT sale_date) AS frequency, CAST(sum(amount) AS DOUBLE) AS monetary
FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT customer_id, {", ".join(_z(c) for c in ("recency", "frequency", "monetary"))} FROM rfm
""")


def customer_search_sql(query: str, order: str = "amount DESC", limit: int = 500) -> str:
    q = query.strip().lower().replace("'", "''")
    cols = ["customer_id", "customer_name", "region", "channel", "seller", "top_product"]
    cond = " OR ".join(f"contains(lower(coalesce({c}, '')), '{q}')" for c in cols)
    return with_fact(f""", {DETAIL_BODY}
SELECT * FROM detail WHERE {cond} ORDER BY {order}, customer_id LIMIT {limit}
""")

# -------------------------------------------------------------------- stock

STOCK_CTE = """,
days AS (SELECT greatest(date_diff('day', min(sale_date), max(sale_date)) + 1, 1) AS d FROM fact),
v AS (
  SELECT product_code, product_canon, CAST(sum(quantity) AS BIGINT) AS units_sold,
         CAST(sum(amount) AS DOUBLE) AS amount_sold,
         CASE WHEN sum(quantity) > 0
              THEN CAST(sum(amount) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) END AS unit_price,
         CAST(sum(quantity) AS DOUBLE) / CAST((SELECT coalesce(d, 1) FROM days) AS DOUBLE)
           AS avg_daily_units
  FROM fact WHERE product_code IS NOT NULL GROUP BY product_code, product_canon),
stock AS (SELECT CAST(p_partkey AS VARCHAR) AS product_code, CAST(p_size AS BIGINT) AS units
          FROM part),
j AS (
  SELECT coalesce(v.product_code, s.product_code) AS product_code, v.product_canon,
         coalesce(v.units_sold, 0) AS units_sold, coalesce(v.amount_sold, 0.0) AS amount_sold,
         v.unit_price, coalesce(v.avg_daily_units, 0.0) AS daily,
         CAST(coalesce(s.units, 0) AS BIGINT) AS u
  FROM v FULL JOIN stock s ON v.product_code = s.product_code),
st AS (
  SELECT product_code, product_canon, units_sold, amount_sold, ROUND2(unit_price) AS unit_price,
         ROUND4(daily) AS avg_daily_units, u AS units_in_stock,
         ROUND2(CAST(u AS DOUBLE) * coalesce(unit_price, 0.0)) AS stock_value,
         coalesce(ROUND1(CASE WHEN daily > 0 THEN CAST(u AS DOUBLE) / daily END), 999.0)
           AS cover_days,
         CASE WHEN NOT daily > 0 THEN 'ALTO'
              WHEN CAST(u AS DOUBLE) / daily < 15 THEN 'CRITICO'
              WHEN CAST(u AS DOUBLE) / daily < 30 THEN 'BAIXO'
              WHEN CAST(u AS DOUBLE) / daily < 60 THEN 'OK'
              ELSE 'ALTO' END AS status
  FROM j)"""

SKU_VELOCITY = with_fact(STOCK_CTE + "\nSELECT * FROM v")
STOCK_STATUS = with_fact(STOCK_CTE + "\nSELECT * FROM st")


def _status_aggs() -> str:
    parts = []
    for label in ("CRITICO", "BAIXO", "OK", "ALTO"):
        parts.append(f"count(*) FILTER (WHERE status = '{label}') AS count_{label.lower()}")
        parts.append(f"ROUND2(coalesce(sum(stock_value) FILTER (WHERE status = '{label}'), 0.0))"
                     f" AS value_{label.lower()}")
    return ", ".join(parts)


STOCK_SUMMARY = with_fact(STOCK_CTE + f"""
SELECT CAST(coalesce(sum(units_in_stock), 0) AS BIGINT) AS units_total,
       ROUND2(coalesce(sum(stock_value), 0.0)) AS value_total, count(*) AS skus,
       {_status_aggs()},
       ROUND1(avg(CASE WHEN cover_days < 999.0 THEN cover_days END)) AS mean_cover_days
FROM st
""")
