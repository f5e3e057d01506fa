"""Oracle SQL of the ingest path: the same raw supplier tables rebuilt in SQL,
standardised with the same rules, then consolidated."""
from __future__ import annotations

from ..sources import fixtures as FX
from .consolidate import mapping_json
from .oracle import CONSOLIDATE_CTE, _r, sql_norm_id


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sql_parse_date(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    num = f"TRY_CAST({t} AS DOUBLE)"
    fmts = [f"%d{sep}%m{sep}%Y{tm}" for sep in ("/", "-", ".")
            for tm in (" %H:%M:%S", " %H:%M", "")]
    parsed = ", ".join([f"try_strptime({t}, '{f}')" for f in fmts] + [f"TRY_CAST({t} AS TIMESTAMP)"])
    return (f"(CASE WHEN {t} IS NULL OR {t} = '' THEN NULL "
            f"WHEN {num} IS NOT NULL THEN CASE WHEN {num} > 20000 AND {num} < 80000 THEN "
            f"make_timestamp(CAST(floor(({num} - 25569.0) * 86400000000.0 + 0.5) AS BIGINT)) END "
            f"ELSE coalesce({parsed}) END)")


def sql_slug(x: str) -> str:
    s = f"strip_accents(CAST({x} AS VARCHAR))"
    s = f"regexp_replace({s}, '[^\\x00-\\x7F]', '', 'g')"
    s = f"regexp_replace({s}, '[^A-Za-z0-9]+', '_', 'g')"
    return f"upper(regexp_replace({s}, '^_+|_+$', '', 'g'))"


def sql_synthetic(x: str) -> str:
    return f"('SYN_' || substr(coalesce({sql_slug(x)}, ''), 1, 24))"


def sql_numeric_code(x: str) -> str:
    return f"CAST(TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DECIMAL(20,0)) AS VARCHAR)"


def sql_amount(x: str) -> str:
    return f"coalesce(TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DECIMAL(38,6)), CAST(0 AS DECIMAL(38,6)))"


def sql_quantity(x: str) -> str:
    return (f"coalesce(TRY_CAST(trunc(TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE)) AS BIGINT), "
            f"CAST(0 AS BIGINT))")


def _pid() -> str:
    return f"lpad(CAST({FX.ID_BASE} + CAST(c_custkey AS BIGINT) * {FX.ID_STEP} AS VARCHAR), 14, '0')"


A, B, C = FX.SOURCE_A_HEADERS, FX.SOURCE_B_HEADERS, FX.SOURCE_C_HEADERS
RAW_CTE = f"""
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_shipdate, c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, p.p_partkey,
         p.p_name, p.p_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey),
raw_a AS (
  SELECT c_name AS {q(A['customer_name'])},
         substr({_pid()},1,2) || '.' || substr({_pid()},3,3) || '.' || substr({_pid()},6,3)
           || '/' || substr({_pid()},9,4) || '-' || substr({_pid()},13,2) AS {q(A['customer_id'])},
         ' ' || lower(n_name) || ' ' AS {q(A['region'])},
         CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN 'sem data'
              WHEN l_orderkey % 3 = 1
                THEN CAST(date_diff('day', DATE '1899-12-30', CAST(l_shipdate AS DATE)) AS VARCHAR)
              ELSE strftime(l_shipdate, '%d/%m/%Y') END AS {q(A['sale_date'])},
         CAST(p_partkey AS VARCHAR) AS {q(A['product_code'])},
         p_name AS {q(A['product_name'])},
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS {q(A['amount'])},
         CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS {q(A['quantity'])},
         c_mktsegment AS {q(A['channel'])},
         l_orderkey * 16 + l_linenumber AS row_no
  FROM lines WHERE l_orderkey % 3 <> 0),
raw_b AS (
  SELECT c_name AS {q(B['customer_name'])}, {_pid()} AS {q(B['customer_id'])},
         n_name AS {q(B['region'])},
         CASE WHEN l_orderkey % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
              ELSE strftime(l_shipdate, '%d/%m/%Y') END AS {q(B['sale_date'])},
         CAST(p_partkey AS VARCHAR) AS {q(B['product_code'])},
         concat_ws(' ', p_name, p_type) AS {q(B['product_name'])},
         CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 1 THEN '0'
              WHEN l_orderkey % 5 = 0 AND l_linenumber = 2 THEN '-1'
              WHEN l_orderkey % 5 = 0 AND l_linenumber = 3 THEN 'x'
              WHEN l_orderkey % 25 = 0 AND l_linenumber = 4 THEN '0.004'
              WHEN l_orderkey % 25 = 0 AND l_linenumber = 5 THEN '1e17'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS {q(B['amount'])},
         CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS {q(B['quantity'])},
         c_mktsegment AS {q(B['channel'])},
         l_orderkey * 16 + l_linenumber AS row_no
  FROM lines WHERE l_orderkey % 3 <> 1),
raw_c AS (
  SELECT CAST(user_id AS VARCHAR) AS {q(C['customer_id'])},
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS {q(C['sale_date'])},
         'event ' || event_type AS {q(C['product_name'])},
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS {q(C['amount'])},
         '1' AS {q(C['quantity'])},
         event_id AS row_no
  FROM events)"""


def _std(raw: str, m: dict, seller: str, source: str, rank: int) -> str:
    def c(f):
        return q(m[f])
    name = f"trim({c('customer_name')})" if "customer_name" in m else f"CAST({c('customer_id')} AS VARCHAR)"
    region = f"upper(trim({c('region')}))" if "region" in m else "'??'"
    code = (f"coalesce({sql_numeric_code(c('product_code'))}, {sql_synthetic(c('product_name'))})"
            if "product_code" in m else sql_synthetic(c("product_name")))
    channel = f"upper(trim({c('channel')}))" if "channel" in m else "'NAO INFORMADO'"
    return f"""SELECT {name} AS customer_name, {sql_norm_id(c('customer_id'))} AS customer_id,
         {region} AS region, {sql_parse_date(c('sale_date'))} AS sale_ts,
         {code} AS product_code, trim({c('product_name')}) AS product_name,
         {sql_amount(c('amount'))} AS amount, {sql_quantity(c('quantity'))} AS quantity,
         {channel} AS channel, '{seller}' AS seller, '{source}' AS source_file,
         {rank} AS source_rank, row_no FROM {raw}"""


def _std_cte(sellers: tuple[str, str, str]) -> str:
    std_a = _std("raw_a", A, sellers[0], "source_a.csv", 0)
    std_b = _std("raw_b", B, sellers[1], "source_b.csv", 1)
    std_c = _std("raw_c", C, sellers[2], "source_c.csv", 2)
    return f""",
std_a AS ({std_a}),
std AS ({std_a}
  UNION ALL {std_b}
  UNION ALL {std_c}),"""


STD_CTE = _std_cte(("Distribuidor A", "Distribuidor B", "Distribuidor C"))
INGEST_WITH = f"WITH {RAW_CTE}{STD_CTE}{CONSOLIDATE_CTE}\n"

STD_COLS = ("customer_name, customer_id, region, sale_ts AS sale_date, product_code, "
            "product_name, amount, quantity, channel, seller, source_file")


def _sql(body: str) -> str:
    return _r(INGEST_WITH + body)


STANDARDIZE = _sql(f"SELECT {STD_COLS} FROM std")
UNION_SOURCES = _sql(f"SELECT {STD_COLS}, source_rank FROM std")
CLEAN = _sql(f"SELECT {STD_COLS}, source_rank FROM valid")
DISTINCT_DEDUP = _sql(f"SELECT {STD_COLS}, source_rank FROM dedup")
CANONICAL_NAME = _sql("SELECT product_code, product_canon FROM canon")
CONSOLIDATE_SOURCES = _sql("SELECT * FROM fact")
UNIT_PRICE = _sql("SELECT customer_id, sale_date, product_code, amount, quantity, unit_price FROM fact")


def _distinct_texts(field: str, expr) -> str:
    parts = []
    for raw, m in (("raw_a", A), ("raw_b", B), ("raw_c", C)):
        if field in m:
            parts.append(f"SELECT CAST({q(m[field])} AS VARCHAR) AS text FROM {raw}")
    return f"SELECT DISTINCT text, {expr('text')} AS value FROM ({' UNION ALL '.join(parts)})"


PARSE_MIXED_DATE = _sql(_distinct_texts("sale_date", sql_parse_date))
NORMALIZE_ID = _sql(_distinct_texts("customer_id", sql_norm_id))
SYNTHETIC_CODE = _sql(_distinct_texts("product_name", sql_synthetic))

INGEST_COUNTS = _sql("""
SELECT r.source_file, r.rows_read, r.rows_valid, coalesce(k.rows_kept, 0) AS rows_kept,
       k.first_date, k.last_date
FROM (SELECT source_file, count(*) AS rows_read,
             count(*) FILTER (WHERE sale_ts IS NOT NULL AND amount > 0) AS rows_valid
      FROM std GROUP BY source_file) r
LEFT JOIN (SELECT source_file, count(*) AS rows_kept, min(sale_date) AS first_date,
                  max(sale_date) AS last_date FROM fact GROUP BY source_file) k
  ON r.source_file = k.source_file
""")


def _log_rows() -> str:
    rows = []
    for name, seller, headers in FX.SOURCES:
        missing = [f for f in ("customer_id", "sale_date", "product_name", "amount", "quantity")
                   if f not in headers]
        status = "error" if missing else "ok"
        msg = f"required fields not found: {missing}".replace("'", "''")
        err = f"'{msg}'" if missing else "NULL"
        mj = mapping_json(headers).replace("'", "''")
        rows.append(f"('{name}', '{seller}', '{status}', '{mj}', {err})")
    return ", ".join(rows)


INGEST_LOG_BODY = f"""
log AS (SELECT * FROM (VALUES {_log_rows()}) v(source_file, seller, status, mapping, error)),
logged AS (
SELECT l.source_file, l.seller, l.status, c.rows, l.mapping, CAST(l.error AS VARCHAR) AS error
FROM log l LEFT JOIN (SELECT source_file, count(*) AS rows FROM std GROUP BY source_file) c
  ON l.source_file = c.source_file)"""

INGEST_LOG = _sql(f",{INGEST_LOG_BODY}\nSELECT * FROM logged")
LOG_FILES = ["source_b.csv", "source_d.csv"]
LOG_FOR_FILES = _sql(
    f",{INGEST_LOG_BODY}\nSELECT * FROM logged WHERE source_file IN "
    f"({', '.join(repr(f) for f in LOG_FILES)})")

PREVIEW = _sql(f"""
SELECT {STD_COLS}, row_no AS _row_no,
       (SELECT count(DISTINCT customer_id) FROM std_a) AS file_customers
FROM std_a ORDER BY row_no LIMIT 5
""")

# ------------------------------------------------------------ column profiles

NUMBER_SHAPE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def sql_text_date(t: str) -> str:
    """Day-first or ISO text to a timestamp, by the text's shape (as the Spark side)."""
    branches = []
    for sep, rx_sep in (("/", "/"), ("-", "-"), (".", "[.]")):
        for fmt, rx_time in ((" %H:%M:%S", " [0-9]{1,2}:[0-9]{2}:[0-9]{2}"),
                             (" %H:%M", " [0-9]{1,2}:[0-9]{2}"), ("", "")):
            shape = f"^[0-9]{{1,2}}{rx_sep}[0-9]{{1,2}}{rx_sep}[0-9]{{4}}{rx_time}$"
            branches.append(f"WHEN regexp_matches({t}, '{shape}') "
                            f"THEN try_strptime({t}, '%d{sep}%m{sep}%Y{fmt}')")
    iso = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
    branches.append(f"WHEN regexp_matches({t}, '{iso}') THEN TRY_CAST({t} AS TIMESTAMP)")
    return (f"(CASE WHEN regexp_matches({t}, '^[0-9]{{1,4}}[-/.][0-9]') THEN "
            f"(CASE {' '.join(branches)} END) END)")


def _renamed_b() -> list[tuple[str, str]]:
    out = []
    for i, (field, col) in enumerate(B.items()):
        bank = FX.RENAME_BANK[field]
        out.append((col, bank[i % len(bank)]))
    return list(reversed(out))


def _profile_tables() -> list[tuple[str, str, list[tuple[str, str]]]]:
    d = FX.SOURCE_D_HEADERS
    return [
        ("source_a.csv", "raw_a", [(c, c) for c in A.values()]),
        ("source_b.csv", "raw_b", [(c, c) for c in B.values()]),
        ("source_c.csv", "raw_c", [(c, c) for c in C.values()]),
        ("source_d.csv", "raw_d", [(c, c) for c in d.values()]),
        ("source_b_renamed.csv", "raw_b", _renamed_b()),
    ]


def _header_flag(col: str, kws: list[str]) -> str:
    tokens = f"string_split(trim(regexp_replace(lower({col}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    kin = " OR ".join(f"contains(t, '{k}')" for k in kws)
    tin = " OR ".join(f"contains('{k}', t)" for k in kws)
    return (f"CASE WHEN len(list_filter({tokens}, lambda t: ({kin}) OR "
            f"(length(t) >= 2 AND ({tin})))) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


def _nine(x: str) -> str:
    """A numeric feature to six decimals, large ones to nine digits."""
    v = f"coalesce(CASE WHEN NOT isnan({x}) THEN {x} END, 0.0)"
    unit = f"pow(10.0::DOUBLE, floor(log10(abs({v}))) - 8)"
    return f"CASE WHEN abs({v}) >= 1e9 THEN floor({v} / {unit} + 0.5) * {unit} ELSE ROUND6({v}) END"


def _profile_sql() -> str:
    from .. import schema as S
    d = FX.SOURCE_D_HEADERS
    raw_d = (f"raw_d AS (SELECT event_type AS {q(d['channel'])}, props AS {q(d['product_name'])}"
             f" FROM events)")
    cells = " UNION ALL ".join(
        f"SELECT '{name}' AS source_file, '{new.replace(chr(39), chr(39) * 2)}' AS \"column\", "
        f"CAST({q(old)} AS VARCHAR) AS value FROM {cte}"
        for name, cte, cols in _profile_tables() for old, new in cols)
    kw = " OR ".join(f"contains(up, '{k}')" for k in S.CHANNEL_KEYWORDS)
    ufs = ", ".join(f"'{u}'" for u in S.REGION_CODES)
    feat = f"""
cells AS ({cells}),
cell_feats AS (
  SELECT source_file, "column", value, num, up,
         (num IS NOT NULL AND NOT isnan(num)) AS is_num,
         (num IS NOT NULL AND NOT isnan(num) AND num % 1.0 = 0) AS is_int,
         CASE WHEN num = 0 THEN 1 ELSE floor(log10(abs(num))) + 1
              + CASE WHEN num < 0 THEN 1 ELSE 0 END END AS digits,
         {sql_text_date('t')} AS dt
  FROM (SELECT *, CASE WHEN regexp_matches(t, '{NUMBER_SHAPE}') THEN TRY_CAST(t AS DOUBLE) END AS num,
               upper(t) AS up
        FROM (SELECT *, trim(value) AS t FROM cells))),
agg AS (
  SELECT source_file, "column", count(value) AS nn,
         count(*) FILTER (WHERE is_num) AS nnum, count(*) FILTER (WHERE is_int) AS nint,
         avg(CASE WHEN is_num THEN num END) AS mean, stddev_samp(CASE WHEN is_num THEN num END) AS sd,
         max(CASE WHEN is_num THEN num END) AS mx, min(CASE WHEN is_num THEN num END) AS mn,
         count(*) FILTER (WHERE is_int AND digits = 14) AS l14,
         count(*) FILTER (WHERE is_int AND digits BETWEEN 12 AND 13) AS l1213,
         count(*) FILTER (WHERE is_int AND digits BETWEEN 8 AND 14) AS l814,
         count(*) FILTER (WHERE is_num AND num BETWEEN 30000 AND 80000) AS ser,
         count(*) FILTER (WHERE value IS NOT NULL AND NOT is_num AND dt IS NOT NULL) AS ndate,
         avg(length(value)) AS mlen, max(length(value)) AS xlen,
         count(DISTINCT value) AS dist,
         count(*) FILTER (WHERE up IN ({ufs})) AS nuf,
         count(*) FILTER (WHERE value IS NOT NULL AND ({kw})) AS nkw
  FROM cell_feats GROUP BY source_file, "column"),
prof AS (
  SELECT source_file, "column",
         {', '.join(f"ROUND6({_header_flag(chr(34) + 'column' + chr(34), S.HEADER_KEYWORDS[f])}) AS hdr_{f}" for f in S.FIELDS)},
         ROUND6(nnum / CAST(greatest(nn, 1) AS DOUBLE)) AS pct_num,
         ROUND6(nint / CAST(greatest(nnum, 1) AS DOUBLE)) AS pct_int,
         {_nine('mean')} AS num_mean,
         {_nine('sd')} AS num_std,
         {_nine('mx')} AS num_max,
         {_nine('mn')} AS num_min,
         ROUND6(l14 / CAST(greatest(nint, 1) AS DOUBLE)) AS pct_len14,
         ROUND6(l1213 / CAST(greatest(nint, 1) AS DOUBLE)) AS pct_len12_13,
         ROUND6(l814 / CAST(greatest(nint, 1) AS DOUBLE)) AS pct_len8_14,
         ROUND6(ser / CAST(greatest(nn, 1) AS DOUBLE)) AS pct_excel_serial,
         ROUND6(ndate / CAST(greatest(nn, 1) AS DOUBLE)) AS pct_date,
         ROUND6(coalesce(mlen, 0.0)) AS mean_len,
         ROUND6(CAST(coalesce(xlen, 0) AS DOUBLE)) AS max_len,
         ROUND6(dist / CAST(greatest(nn, 1) AS DOUBLE)) AS distinct_ratio,
         ROUND6(nuf / CAST(greatest(nn, 1) AS DOUBLE)) AS pct_uf,
         ROUND6(nkw / CAST(greatest(nn, 1) AS DOUBLE)) AS pct_canal_kw
  FROM agg)
SELECT *, CASE WHEN pct_num > 0.9 AND pct_int < 0.5 AND num_mean > 1 AND num_mean < 100000
               THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS money_like,
          CASE WHEN mean_len > 18 AND distinct_ratio > 0.05
               THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product_like
FROM prof"""
    return _r(f"WITH {RAW_CTE},\n{raw_d},{feat}")


PROFILE_COLUMNS = _profile_sql()

# The same consolidation when every file's mapping is inferred (sellers get
# the default "Auto · <file stem>"): equal to the known-mapping result only if
# the classifier maps every field of every readable file right.
CONSOLIDATE_INFERRED = _r(
    f"WITH {RAW_CTE}{_std_cte(('Auto · source_a', 'Auto · source_b', 'Auto · source_c'))}"
    f"{CONSOLIDATE_CTE}\nSELECT * FROM fact")

# Every readable supplier file, consolidated (the streaming ingest of their
# CSV files); the file name column is left out, the stream sees Spark's
# part-file names.
STREAM_SOURCES = _sql("SELECT * EXCLUDE (source_file) FROM fact")

# The landing folder's log: the four supplier files and an empty one.
LANDING_LOG = _sql("""
SELECT l.source_file, l.status, c.rows, c.no_date, c.no_amount, l.error
FROM (VALUES ('source_a.csv', 'ok', NULL), ('source_b.csv', 'ok', NULL), ('source_c.csv', 'ok', NULL),
  ('source_d.csv', 'error',
   'required fields not found: [''customer_id'', ''sale_date'', ''amount'', ''quantity'']'),
  ('source_empty.csv', 'error', 'empty file: no header line')) l(source_file, status, error)
LEFT JOIN (SELECT source_file, count(*) AS rows, count(*) FILTER (WHERE sale_ts IS NULL) AS no_date,
                  count(*) FILTER (WHERE amount <= 0) AS no_amount FROM std GROUP BY source_file) c
  ON c.source_file = l.source_file
""")


# The price lists of plans/landing_batch.py: what every part's line must come back as.
_PRICES = """
WITH prices AS (
  SELECT CASE p_partkey % 3 WHEN 0 THEN 'lista_simples.csv' WHEN 1 THEN 'lista_ponto_e_virgula.csv'
              ELSE 'lista_com_quebras.csv' END AS source_file,
         CASE p_partkey % 3 WHEN 1 THEN ';' ELSE ',' END AS sep, p_partkey % 11 AS kind, p_name,
         CAST(p_partkey AS VARCHAR) AS codigo, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS valor,
         CAST(p_size AS VARCHAR) AS qtd, p_partkey % 3 = 2 AS breaks FROM part)
"""
PRICE_ROWS = _PRICES + """
SELECT source_file, codigo, CASE WHEN kind = 2 THEN p_name || ' 1/2"' || sep || ' "x"' WHEN kind = 4 THEN p_name || ' 3" tubo'
       WHEN kind = 5 AND breaks THEN p_name || chr(10) || 'segunda linha, "y"' ELSE p_name END AS produto, valor, qtd
FROM prices WHERE kind > 1
"""
REJECTED_ROWS = _PRICES + """
SELECT source_file, CASE WHEN kind = 1 THEN codigo || sep || p_name ELSE concat_ws(sep, codigo, p_name,
         CASE WHEN sep = ';' THEN replace(valor, '.', ',') ELSE valor END, qtd, 'sobra') END AS line,
       CASE WHEN kind = 1 THEN 'fewer cells than the header: 2 of 4' ELSE 'more cells than the header: 5 of 4' END AS reason
FROM prices WHERE kind <= 1
"""
LANDING_LAYOUTS = """
SELECT source_file, separator, header FROM (VALUES
  ('lista_simples.csv', ',', 'codigo|produto|valor|qtd'), ('lista_com_quebras.csv', ',', 'codigo|produto|valor|qtd'),
  ('lista_ponto_e_virgula.csv', ';', 'codigo|produto|valor|qtd'),
""" + ",\n".join(f"  ('{name}', ',', '{'|'.join(h.values())}')" for name, _, h in FX.SOURCES) + """
) t(source_file, separator, header)
"""
