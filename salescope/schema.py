"""Fixed schemas and constants of the sales model."""
from __future__ import annotations

from pyspark.sql import types as T

# Canonical fields a raw table is mapped to, in their fixed order.
FIELDS = ["customer_name", "customer_id", "region", "sale_date", "product_code",
          "product_name", "amount", "quantity", "channel"]

# Fields a raw table must provide; a file lacking one is quarantined.
REQUIRED_FIELDS = ["customer_id", "sale_date", "product_name", "amount", "quantity"]

# Amounts of raw files keep six digits after the point: rounding to cents would
# turn small amounts into 0 and merge rows that differ below a cent.
RAW_AMOUNT_TYPE = T.DecimalType(38, 6)

# Standardised table: the nine fields plus seller and source file.
STANDARD_SCHEMA = T.StructType([
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("sale_date", T.TimestampNTZType()),
    T.StructField("product_code", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("amount", RAW_AMOUNT_TYPE),
    T.StructField("quantity", T.LongType()),
    T.StructField("channel", T.StringType()),
    T.StructField("seller", T.StringType()),
    T.StructField("source_file", T.StringType()),
])

# Consolidated fact table: standard columns (date at midnight) + 2 derived.
FACT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.DateType() if f.name == "sale_date" else f.dataType)
     for f in STANDARD_SCHEMA.fields]
    + [T.StructField("product_canon", T.StringType()),
       T.StructField("unit_price", T.DoubleType())]
)
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# --- fixed values that must equal the reference for the same results ---
# Excel serial dates count days from this epoch; a bare number is a serial
# date only strictly inside (20000, 80000) when parsing.
EXCEL_EPOCH = "1899-12-30"
SERIAL_MIN_EXCLUSIVE = 20000
SERIAL_MAX_EXCLUSIVE = 80000
# Profiling counts a value as serial-like in the closed range [30000, 80000].
PROFILE_SERIAL_MIN = 30000
PROFILE_SERIAL_MAX = 80000
# Fallbacks of optional fields.
UNKNOWN_REGION = "??"
UNKNOWN_CHANNEL = "NAO INFORMADO"
SYNTHETIC_PREFIX = "SYN_"
SYNTHETIC_SLUG_LENGTH = 24
ID_WIDTH = 14
# Forecast horizon in days and band width in residual standard deviations.
FORECAST_HORIZON_DAYS = 14
FORECAST_BAND_SIGMAS = 1.5
TRAILING_MEAN_ROWS = 7
# Lifecycle windows (days before the latest sale date).
NEW_CUSTOMER_DAYS = 7        # inclusive
INACTIVE_CUSTOMER_DAYS = 30  # strict
# Stock cover bands (days) and their labels; 999 stands for "no sales".
STOCK_STATUS_BANDS = [(15, "CRITICO"), (30, "BAIXO"), (60, "OK")]
STOCK_STATUS_TOP = "ALTO"
NO_SALES_COVER_DAYS = 999.0
# Segment labels by falling mean monetary value; further clusters are "Cluster i".
SEGMENT_LABELS = ["Campeões", "Leais", "Em desenvolvimento", "Em risco"]
SEGMENT_COUNT = 4
SEGMENT_SEED = 42
SEGMENT_INITS = 10
# Top-n sizes of the reports.
TOP_PRODUCTS = 30
CONCENTRATION_TOP = 10
STOCK_LIST_ROWS = 50
CUSTOMER_LIST_ROWS = 500
# Column-mapping confidence threshold and the bands shown for it.
MAPPING_THRESHOLD = 0.20
CONFIDENCE_HIGH = 0.7
CONFIDENCE_MEDIUM = 0.4
# Customer-table sort options; recency sorts ascending, the others descending.
CUSTOMER_SORT_COLUMNS = ["amount", "units", "transactions", "products", "recency_days"]
# Region codes recognised when profiling (the 27 Brazilian states).
REGION_CODES = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS",
                "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC",
                "SE", "SP", "TO"]
# Channel keywords recognised when profiling (substring of the upper-cased value).
CHANNEL_KEYWORDS = ["VAREJO", "DIRETO", "INDIRETO", "ATACADO", "ECOMM", "DISTRIBUI", "FARMA "]
# Header keywords per canonical field, matched against header tokens.
HEADER_KEYWORDS = {
    "customer_name": ["cliente", "razao", "social", "nome", "fantasia", "loja"],
    "customer_id": ["cnpj", "cpf", "documento", "doc"],
    "region": ["uf", "estado", "est"],
    "sale_date": ["data", "dt", "dia", "emissao"],
    "product_code": ["ean", "barras", "barra", "codigo", "cod"],
    "product_name": ["produto", "descricao", "descrição", "desc", "item", "mercadoria"],
    "amount": ["valor", "vlr", "total", "preco", "faturamento"],
    "quantity": ["qtd", "quant", "un", "unid", "volume", "vol"],
    "channel": ["canal", "painel", "segmento"],
}
# --- end of fixed values ---
