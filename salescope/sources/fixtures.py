"""Raw supplier tables derived from the given tables (all text, messy on purpose).

Three sources with different header layouts, as supplier spreadsheets have:

* ``source_a.csv`` — line items whose order key is not a multiple of 3; ids
  with punctuation, padded lower-case regions, dates as Excel serials or
  ``dd/MM/yyyy`` (a few unreadable), numeric product codes.
* ``source_b.csv`` — line items whose order key is not ``1 mod 3``, so a
  third of the rows repeat source A (dedup must keep A's copy); ISO or
  ``dd/MM/yyyy`` dates, longer product names (canonical name must pick
  them), and some zero, negative or unreadable amounts.
* ``source_c.csv`` — the ``events`` table: no customer name, region, code or
  channel columns (fallbacks apply), timestamps with a time of day.
* ``source_d.csv`` — ``events`` with only two columns; required fields are
  missing, so it is quarantined.

Every row of the inputs reaches a source; nothing is sampled.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import bounded_broadcast
from .materialize import materialized, written
from .tables import read_table

# --- fixed values: header layouts of the supplier files (field -> header) ---
SOURCE_A_HEADERS = {
    "customer_name": "RAZAOSOCIAL", "customer_id": "CNPJ", "region": "UF",
    "sale_date": "DATAVENDA", "product_code": "EAN", "product_name": "descrição",
    "amount": "VALOR_VENDA", "quantity": "QTDE_VENDA", "channel": "painel",
}
SOURCE_B_HEADERS = {
    "customer_name": "Cliente", "customer_id": "CNPJ CPF", "region": "Estado",
    "sale_date": "Data Dia", "product_code": "Cód Barras Compra", "product_name": "Produto",
    "amount": "VALOR", "quantity": "UN ", "channel": "PAINEL",
}
SOURCE_C_HEADERS = {
    "customer_id": "CNPJ CLIENTE", "sale_date": "DATA VENDA", "product_name": "PRODUTO",
    "amount": "VL TOTAL VENDA", "quantity": "QTD TOTAL VENDA",
}
SOURCE_D_HEADERS = {"channel": "TIPO", "product_name": "DETALHE"}
# Header names never seen in training, per field (generalisation check).
RENAME_BANK = {
    "customer_name": ["Loja", "Estabelecimento", "Nome do PDV"],
    "customer_id": ["Inscricao", "DocFiscal", "ID Fiscal"],
    "region": ["Sigla", "Regiao UF", "ST"],
    "sale_date": ["Competencia", "Emissao NF", "Dt Movto"],
    "product_code": ["GTIN", "SKU Code", "Cod Item"],
    "product_name": ["Mercadoria", "Item Descricao", "Descricao SKU"],
    "amount": ["Receita", "Faturado", "Vlr Bruto"],
    "quantity": ["Volume", "Pecas", "Qtd Itens"],
    "channel": ["Tipo de Cliente", "Segmento PDV", "Modalidade"],
}
# Further known layouts, used only to train the column classifier.
TRAINING_LAYOUTS = [
    ("training_e.csv", "source_b.csv", {
        "customer_name": "Cliente", "customer_id": "CNPJ_CLIENTE", "region": "UF",
        "sale_date": "Data", "product_code": "EAN", "product_name": "Produto",
        "amount": "Valor Total Nota", "quantity": "Qtd", "channel": "painel"}),
    ("training_f.csv", "source_a.csv", {
        "customer_id": "CNPJ CLIENTE", "region": "UF", "sale_date": "DATA VENDA",
        "product_name": "PRODUTO", "amount": "VL TOTAL VENDA", "quantity": "QTD TOTAL VENDA",
        "channel": "PAINEL "}),
]
SOURCES = [
    ("source_a.csv", "Distribuidor A", SOURCE_A_HEADERS),
    ("source_b.csv", "Distribuidor B", SOURCE_B_HEADERS),
    ("source_c.csv", "Distribuidor C", SOURCE_C_HEADERS),
    ("source_d.csv", "Distribuidor D", SOURCE_D_HEADERS),
]
# --- end of fixed values ---


# Company ids of 14 digits, one per customer key.
ID_BASE, ID_STEP = 10_000_000_000_000, 6_700_417


def _company_id():
    return F.lpad((F.lit(ID_BASE) + F.col("c_custkey").cast("bigint") * ID_STEP).cast("string"), 14, "0")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their texts; they meet the parts first, while they are narrow, and the wide rows leave the
    last join without another shuffle."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = (read_table(spark, sf_dir, "customer")
                .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
                .join(bounded_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    orders = (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
              .join(customer, F.col("o_custkey") == F.col("c_custkey")))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (read_table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"),
                    F.col("l_quantity").try_cast("bigint").alias("l_quantity"),
                    F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


def _money_text(col: str):
    return F.col(col).cast("decimal(18,2)").cast("string")


def _qty_text(col: str):
    return F.col(col).try_cast("bigint").cast("string")


def _serial_text(col: str):
    return F.datediff(F.to_date(F.col(col)), F.lit("1899-12-30").cast("date")).cast("string")


def raw_source_a(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    h = SOURCE_A_HEADERS
    li = (lines if lines is not None else _lines(spark, sf_dir)).where(F.col("l_orderkey") % 3 != 0)
    pid = _company_id()
    punct = F.concat(F.substring(pid, 1, 2), F.lit("."), F.substring(pid, 3, 3), F.lit("."),
                     F.substring(pid, 6, 3), F.lit("/"), F.substring(pid, 9, 4), F.lit("-"),
                     F.substring(pid, 13, 2))
    date_text = (F.when((F.col("l_orderkey") % 97 == 0) & (F.col("l_linenumber") == 1),
                        F.lit("sem data"))
                  .when(F.col("l_orderkey") % 3 == 1, _serial_text("l_shipdate"))
                  .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")))
    return li.select(
        F.col("c_name").alias(h["customer_name"]), punct.alias(h["customer_id"]),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias(h["region"]),
        date_text.alias(h["sale_date"]),
        F.col("p_partkey").cast("string").alias(h["product_code"]),
        F.col("p_name").alias(h["product_name"]),
        _money_text("l_extendedprice").alias(h["amount"]),
        _qty_text("l_quantity").alias(h["quantity"]),
        F.col("c_mktsegment").alias(h["channel"]),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("bigint").alias("_row_no"))


def raw_source_b(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    h = SOURCE_B_HEADERS
    li = (lines if lines is not None else _lines(spark, sf_dir)).where(F.col("l_orderkey") % 3 != 1)
    date_text = (F.when(F.col("l_orderkey") % 3 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
                  .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")))
    bad = F.col("l_orderkey") % 5 == 0
    amount = (F.when(bad & (F.col("l_linenumber") == 1), F.lit("0"))
               .when(bad & (F.col("l_linenumber") == 2), F.lit("-1"))
               .when(bad & (F.col("l_linenumber") == 3), F.lit("x"))
               .when((F.col("l_orderkey") % 25 == 0) & (F.col("l_linenumber") == 4), F.lit("0.004"))
               .when((F.col("l_orderkey") % 25 == 0) & (F.col("l_linenumber") == 5), F.lit("1e17"))
               .otherwise(_money_text("l_extendedprice")))
    return li.select(
        F.col("c_name").alias(h["customer_name"]),
        _company_id().alias(h["customer_id"]),
        F.col("n_name").alias(h["region"]), date_text.alias(h["sale_date"]),
        F.col("p_partkey").cast("string").alias(h["product_code"]),
        F.concat_ws(" ", "p_name", "p_type").alias(h["product_name"]),
        amount.alias(h["amount"]), _qty_text("l_quantity").alias(h["quantity"]),
        F.col("c_mktsegment").alias(h["channel"]),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("bigint").alias("_row_no"))


def raw_source_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = SOURCE_C_HEADERS
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias(h["customer_id"]),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias(h["sale_date"]),
        F.concat(F.lit("event "), F.col("event_type")).alias(h["product_name"]),
        _money_text("value").alias(h["amount"]),
        F.lit("1").alias(h["quantity"]),
        F.col("event_id").cast("bigint").alias("_row_no"))


def raw_source_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = SOURCE_D_HEADERS
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias(h["channel"]),
                     F.col("props").alias(h["product_name"]),
                     F.col("event_id").cast("bigint").alias("_row_no"))


RAW_BUILDERS = {
    "source_a.csv": raw_source_a, "source_b.csv": raw_source_b,
    "source_c.csv": raw_source_c, "source_d.csv": raw_source_d,
}


def landing_file(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplier file as written to the landing folder (all-text Parquet,
    written once per application in the shared checkpoint folder)."""
    return materialized(spark, f"landing-{name}", sf_dir.rstrip("/"),
                        lambda: RAW_BUILDERS[name](spark, sf_dir))


def supplier_file(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows for a query that reads them once: from the landing file if
    another query had it written, else as they are built, without a copy."""
    there = written(spark, f"landing-{name}", sf_dir.rstrip("/"))
    return there if there is not None else RAW_BUILDERS[name](spark, sf_dir)


def write_csv(raw: DataFrame, path: str) -> None:
    """A supplier file as it is dropped into a landing folder: CSV, each part compressed."""
    (raw.drop("_row_no").write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip").csv(path))


def write_landing(spark: SparkSession, sf_dir: str) -> None:
    """Write every supplier file once; the files are independent jobs, submitted
    together so the scheduler can run them side by side. (Caching the
    order-table join shared by the two line-item files was measured slower
    than computing it per file.)"""
    with ThreadPoolExecutor(max_workers=len(SOURCES)) as pool:
        list(pool.map(lambda s: landing_file(spark, sf_dir, s[0]), SOURCES))


def raw_sources(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, dict, DataFrame]]:
    """``(file name, seller, known mapping, raw frame)`` for every supplier file, in file order."""
    write_landing(spark, sf_dir)
    return [(name, seller, dict(headers), landing_file(spark, sf_dir, name))
            for name, seller, headers in SOURCES]


def supplier_sources(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, dict, DataFrame]]:
    """The same for a query that reads every file once."""
    return [(name, seller, dict(headers), supplier_file(spark, sf_dir, name)) for name, seller, headers in SOURCES]


def renamed_headers(name: str = "source_b.csv") -> dict[str, str]:
    """Old header -> unseen header for every mapped column of a source."""
    _, _, headers = next(s for s in SOURCES if s[0] == name)
    return {col: RENAME_BANK[field][i % len(RENAME_BANK[field])]
            for i, (field, col) in enumerate(headers.items())}


def renamed_source(spark: SparkSession, sf_dir: str, name: str = "source_b.csv"
                   ) -> tuple[DataFrame, dict]:
    """A source with every mapped header swapped for an unseen name and the
    columns in reverse order; returns the frame and its true mapping."""
    _, _, headers = next(s for s in SOURCES if s[0] == name)
    raw = landing_file(spark, sf_dir, name)
    new = renamed_headers(name)
    truth = {field: new[col] for field, col in headers.items()}
    cols = [F.col(f"`{col}`").alias(new[col]) for col in headers.values()]
    cols.reverse()
    return raw.select(*cols, "_row_no"), truth


def relabelled(raw: DataFrame, headers: dict, layout: dict) -> DataFrame:
    """The columns of ``raw`` (mapped by ``headers``) under the header names of
    ``layout``; fields the layout lacks are left out."""
    return raw.select(*[F.col(f"`{headers[f]}`").alias(col) for f, col in layout.items()],
                      "_row_no")


def training_tables(spark: SparkSession, sf_dir: str) -> list[tuple[str, dict, DataFrame]]:
    """Tables with a known mapping for training: the readable sources and the
    further layouts."""
    out = [(name, dict(h), landing_file(spark, sf_dir, name))
           for name, _, h in SOURCES if name != "source_d.csv"]
    base = {name: (h, raw) for name, h, raw in out}
    for name, src, layout in TRAINING_LAYOUTS:
        h, raw = base[src]
        out.append((name, dict(layout), relabelled(raw, h, layout)))
    return out


def stock_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units in stock per product code (``p_size`` of the part table)."""
    return (read_table(spark, sf_dir, "part")
            .select(F.col("p_partkey").cast("string").alias("product_code"),
                    F.col("p_size").cast("bigint").alias("units")))
