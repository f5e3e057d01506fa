"""Batch ingest of landing folders: the supplier files as CSV, one of them empty, and price lists as
spreadsheets export them, with rows that do not fit their header."""
from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import session as SS
from ..operators import ingest
from ..sources import fixtures as FX
from ..sources.materialize import materialized
from ..sources.raw import Layout, list_files, rejected_rows as rejected_of, scan_layouts
from ..sources.tables import read_table
from . import consolidate as CO

EMPTY_FILE = "source_empty.csv"
_folders: dict[tuple[str, str], str] = {}


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """All four supplier files as compressed CSV and an empty file, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _folders:
        folder = SS.shared_path(spark, f"landing-batch-{uuid.uuid4().hex[:12]}")

        def write(name: str) -> None:
            FX.write_csv(FX.supplier_file(spark, sf_dir, name), f"{folder}/{name}")

        with ThreadPoolExecutor(max_workers=len(FX.SOURCES)) as pool:
            list(pool.map(write, [name for name, _, _ in FX.SOURCES]))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{EMPTY_FILE}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()
        _folders[key] = folder
    return _folders[key]


def known_mapping(layout: Layout) -> dict[str, str]:
    """The mapping of the supplier whose headers the layout has."""
    return next((h for _, _, h in FX.SOURCES if set(h.values()) == set(layout.headers)), {})


def _seller(file: str):
    names = {name: seller for name, seller, _ in FX.SOURCES}
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col(file))


def _stacked(spark: SparkSession, sf_dir: str):
    layouts, errors = scan_layouts(spark, landing_folder(spark, sf_dir))
    stacked, more = CO.stack_layouts(layouts, known_mapping, _seller("source_file"))
    return stacked, errors + more


def landing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder -> layouts -> standard rows -> fact. The standard rows are written once (parsing happens once); their file
    is their rank and tells the seller, so both are put back after the rows were shuffled."""
    stacked = materialized(spark, "stacked-landing", sf_dir.rstrip("/"), lambda: _stacked(spark, sf_dir)[0])
    rows = ingest.dedup_and_name(ingest.clean(stacked).drop("source_file", "seller"))
    return ingest.finalize(rows.withColumns({"source_file": F.col("_source_rank"), "seller": _seller("_source_rank")}))


def landing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacked, errors = _stacked(spark, sf_dir)
    files = [p.rsplit("/", 1)[-1] for p in list_files(spark, landing_folder(spark, sf_dir))]
    return CO.landing_log(spark, files, errors, stacked)


# Price lists of the parts, one line a part, in the ways spreadsheets write them (layout -> file, separator).
PRICE_HEADER = ["codigo", "produto", "valor", "qtd"]
PRICE_FILES = {0: ("lista_simples.csv", ","), 1: ("lista_ponto_e_virgula.csv", ";"), 2: ("lista_com_quebras.csv", ",")}


def price_lines(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    """The lines of one price list: by the part's key a row is plain, or has quotes doubled in a quoted cell, a
    quote inside a plain cell, a line break in a cell (third list), a cell too many, or cells too few."""
    separator = PRICE_FILES[which][1]
    part = read_table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 == which)
    kind = F.col("p_partkey") % 11
    price = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    price = F.translate(price, ".", ",") if separator == ";" else price
    name = (F.when(kind == 2, F.concat(F.lit('"'), "p_name", F.lit(' 1/2""' + separator + ' ""x"""')))
             .when(kind == 4, F.concat("p_name", F.lit(' 3" tubo')))
             .when((kind == 5) & F.lit(which == 2), F.concat(F.lit('"'), "p_name", F.lit('\nsegunda linha, ""y"""')))
             .otherwise(F.col("p_name")))
    cells = F.concat_ws(separator, F.col("p_partkey").cast("string"), name, price, F.col("p_size").cast("string"))
    return part.select(F.when(kind == 0, F.concat(cells, F.lit(separator + "sobra")))
                        .when(kind == 1, F.concat_ws(separator, F.col("p_partkey").cast("string"), "p_name"))
                        .otherwise(cells).alias("value"))


def price_folder(spark: SparkSession, sf_dir: str) -> str:
    """The three price lists, written once per application, every part of them with its header line."""
    key = (spark.sparkContext.applicationId, "prices", sf_dir.rstrip("/"))
    if key not in _folders:
        folder = SS.shared_path(spark, f"landing-prices-{uuid.uuid4().hex[:12]}")
        for which, (name, separator) in PRICE_FILES.items():
            header = separator.join(PRICE_HEADER)

            def headed(batches, header=header):
                import pyarrow as pa
                yield pa.RecordBatch.from_pydict({"value": [header]})
                for batch in batches:
                    yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

            price_lines(spark, sf_dir, which).mapInArrow(headed, "value string").write.text(f"{folder}/{name}")
        _folders[key] = folder
    return _folders[key]


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all price lists that fit their header."""
    layouts, _ = scan_layouts(spark, price_folder(spark, sf_dir))
    out = None
    for layout in layouts:
        rows = layout.frame.select("source_file", *PRICE_HEADER)
        out = rows if out is None else out.unionByName(rows)
    return out


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all price lists that do not fit, and why."""
    return rejected_of(spark, scan_layouts(spark, price_folder(spark, sf_dir))[0])


def landing_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: file, separator and header of every file of both landing folders."""
    found = [(f, layout.separator, "|".join(layout.headers))
             for folder in (landing_folder(spark, sf_dir), price_folder(spark, sf_dir))
             for layout in scan_layouts(spark, folder)[0] for f in layout.files]
    return spark.createDataFrame(found, "source_file string, separator string, header string")
