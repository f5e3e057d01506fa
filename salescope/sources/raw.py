"""Raw supplier files (S2, S3): tabular text files read with all-string columns.

Files in one landing folder may have different headers and separators. One
scan over the folder's lines finds the first line of every file and whether
any quoted cell of it runs over a line break; each layout (same header, same
separator) is then one ``spark.read.csv`` over its files, so a folder of many
files makes as many reads as it has layouts (two where some of its files have
cells with line breaks, which cannot be split at lines). ``source_file`` comes
from the file's path; ``_row_no`` keeps the row order within a file.

Cells follow RFC 4180: quoted where they hold a separator, a quote (doubled)
or a line break; a quote inside an unquoted cell is a character. Rows that do
not have the header's number of cells, and rows with a quoted cell that has
swallowed the rows after it, are not guessed at: they go to ``rejected`` with
their text and the reason. In files separated by ``;`` a
number may have a decimal comma.
"""
from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SEPARATORS = ",;\t|"
REJECTED = "_rejected_line"
_OPEN_COST, _SPLIT_BYTES = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"


@dataclass
class Layout:
    """Files with the same header and separator, the one frame that reads them all, and the rows left out of it."""
    headers: tuple[str, ...]
    files: list[str]
    frame: DataFrame
    rejected: DataFrame
    separator: str = ","


def _file_path() -> Column:
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _entry_name() -> Column:
    """The file's name, or that of the ``.csv`` folder Spark wrote it into.

    This runs on every row, so it is cut out at the last slashes, without a pattern; only names with escaped
    characters are decoded.
    """
    path = F.col("_metadata.file_path")
    last = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    name = F.when(F.startswith(last, F.lit("part-")) & F.endswith(folder, F.lit(".csv")), folder).otherwise(last)
    return F.when(name.contains("%"), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def entry_of(path: str) -> str:
    return re.search(r"([^/]+?)(?:(?<=\.csv)/part-[^/]*)?$", path).group(1)


def _literal(path: str) -> str:
    """A path whose characters have no meaning as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """S3: files of a folder with the given suffix, in sorted order (the file
    order decides which copy dedup keeps). Listing only: no data is read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    names = [st.getPath().toString() for st in fs.listStatus(path)
             if st.getPath().getName().lower().endswith(suffix)]
    return sorted(names)


@contextmanager
def _one_file_a_task(spark: SparkSession):
    """Scans inside never pack two files into one task."""
    before = spark.conf.get(_OPEN_COST, None)
    spark.conf.set(_OPEN_COST, spark.conf.get(_SPLIT_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_COST)
        else:
            spark.conf.set(_OPEN_COST, before)


def _runs_on(line: Column, separator: str) -> Column:
    """Whether a line that begins outside a cell ends inside a quoted one."""
    s = re.escape(separator)
    inside = r'[^"]*+(?:""[^"]*+)*+'
    pattern = rf'^(?:(?:"{inside}"|[^"{s}][^{s}]*+|){s})*+"{inside}$'
    return line.contains('"') & line.rlike(pattern)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, header, runs_on (under each separator) of every non-empty file: one scan, one row a file.

    With one file to a task the first row of a task that begins at byte 0 is
    the file's first line, so no sort or shuffle of lines is needed; only
    first lines and lines that end inside a quoted cell go on.
    """
    lines = spark.read.text([_literal(p) for p in paths]).select(
        "value", _file_path().alias("path"),
        ((F.col("_metadata.file_block_start") == 0)
         & (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)).alias("first"))
    marks = [_runs_on(F.col("value"), s).alias(f"s{k}") for k, s in enumerate(SEPARATORS)]
    some = lines.select("path", F.when(F.col("first"), F.col("value")).alias("header"), *marks)
    some = some.where(" or ".join(["header is not null", *[f"s{k}" for k in range(len(SEPARATORS))]]))
    return some.groupBy("path").agg(F.max("header").alias("header"), *[
        F.max(f"s{k}").alias(f"s{k}") for k in range(len(SEPARATORS))])


def split_header(line: str) -> tuple[str, tuple[str, ...]]:
    """(separator, column names) of a header line; raises ValueError where it is none.

    The separator is the one that occurs most outside quotes (a header without any has one column). Columns without a
    name and repeated names get names of their own.
    """
    line = line.lstrip("\ufeff")
    bare = re.sub('"[^"]*"', "", line)
    separator = max(SEPARATORS, key=bare.count)
    if not line.strip():
        raise ValueError("empty header line")
    try:
        names = next(csv.reader([line], delimiter=separator, strict=True))
    except csv.Error as e:
        raise ValueError(f"unreadable header line: {e}") from None
    out: list[str] = []
    taken: set[str] = {REJECTED, "source_file", "_row_no"}
    for k, name in enumerate(names):
        name = name or f"_c{k}"
        while name.lower() in taken:
            name = f"{name}_{k}"
        taken.add(name.lower())
        out.append(name)
    return separator, tuple(out)


def _read_csv(spark: SparkSession, paths: Sequence[str], headers: Sequence[str], separator: str,
              line_breaks: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*headers, REJECTED)])
    rows = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("sep", separator).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
            .option("columnPruning", False)               # cells are counted whatever the query selects
            .csv([_literal(p) for p in paths]))
    if line_breaks:
        # a quoted cell without an end runs on over the rows after it: what holds whole rows is not a cell
        s, cells = re.escape(separator), [F.col(f"`{c}`") for c in headers]
        row_inside = rf"[\r\n](?:[^{s}\r\n]*+{s}){{{len(headers) - 1}}}[^{s}\r\n]*+(?:[\r\n]|$)"
        text = F.concat_ws(separator, *cells)
        swallowed = reduce(Column.__or__, [F.coalesce(c.rlike(row_inside), F.lit(False)) for c in cells])
        rows = rows.withColumn(REJECTED, F.coalesce(REJECTED, F.when(swallowed, text)))
    return rows.select("*", _entry_name().alias("source_file"), F.monotonically_increasing_id().alias("_row_no"))


_COMMA_NUMBER = r"^\s*[+-]?(?:[0-9]{1,3}(?:[.][0-9]{3})+|[0-9]+),[0-9]+\s*$"


def _plain_number(cell: Column) -> Column:
    """``1.234,50`` as ``1234.50``; other cells as they are."""
    return F.when(cell.rlike(_COMMA_NUMBER), F.translate(cell, ",.", ".")).otherwise(cell)


def why_rejected(line: Column, cells: int, separator: str) -> Column:
    """The reason why a line does not have the header's number of cells."""
    bare = F.regexp_replace(line, '"[^"]*+"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
    told = F.concat(F.lit(" cells than the header: "), found.cast("string"), F.lit(f" of {cells}"))
    return (F.when((found < cells) & F.startswith(F.ltrim(F.regexp_extract(bare, '[^' + re.escape(separator) + ']*$', 0)),
                                                  F.lit('"')), "quoted cell without an end")
            .when(found < cells, F.concat(F.lit("fewer"), told)).when(found > cells, F.concat(F.lit("more"), told))
            .otherwise("quoted cell that holds whole rows"))


def read_layout(spark: SparkSession, headers: Sequence[str], plain: Sequence[str], line_breaks: Sequence[str] = (),
                separator: str = ",") -> Layout:
    """One layout's files: those that can be split at lines and those with line breaks inside cells."""
    rows = reduce(DataFrame.unionByName, [_read_csv(spark, paths, headers, separator, multi)
                                          for paths, multi in ((plain, False), (line_breaks, True)) if paths])
    # always true: Spark reads the rejected line only together with some cell, whatever the query selects
    with_cells = F.length(F.coalesce(F.col(f"`{headers[0]}`"), F.lit(""))) >= 0
    kept = rows.where(F.col(REJECTED).isNull() & with_cells)
    cells = [F.col(f"`{c}`") for c in headers]
    if separator == ";":
        cells = [_plain_number(cell).alias(c) for cell, c in zip(cells, headers)]
    bad = rows.where(F.col(REJECTED).isNotNull() & with_cells).select(
        "source_file", "_row_no", F.col(REJECTED).alias("line"),
        why_rejected(F.col(REJECTED), len(headers), separator).alias("reason"))
    names = sorted({entry_of(p) for p in (*plain, *line_breaks)})
    return Layout(tuple(headers), names, kept.select(*cells, "source_file", "_row_no"), bad, separator)


def scan_files(spark: SparkSession, paths: Sequence[str]) -> tuple[list[Layout], list[tuple[str, str]]]:
    """The layouts of the given files or ``.csv`` folders, and ``(file, error)`` for those that have none.

    One row a file comes back from the scan: names and headers, no data.
    """
    if not paths:
        return [], []
    try:
        with _one_file_a_task(spark):
            found = first_lines(spark, paths).collect()
    except Exception:
        if len(paths) == 1:
            raise
        found = None
    if found is None:                                     # some file cannot be read at all: find out which
        layouts, errors = [], []
        half = len(paths) // 2
        for part in (paths[:half], paths[half:]):
            try:
                some, bad = scan_files(spark, part)
            except Exception as e:  # noqa: BLE001 - one unreadable file must not stop the others
                some, bad = [], [(entry_of(part[0]), str(e).splitlines()[0][:300])]
            layouts += some
            errors += bad
        return layouts, errors
    groups: dict[tuple[str, tuple[str, ...]], tuple[list[str], list[str]]] = {}
    errors, known = [], set()
    for row in sorted(found, key=lambda r: r["path"]):
        known.add(entry_of(row["path"]))
        try:
            separator, headers = split_header(row["header"])
        except ValueError as e:
            errors.append((entry_of(row["path"]), str(e)))
            continue
        group = groups.setdefault((separator, headers), ([], []))
        group[bool(row[f"s{SEPARATORS.index(separator)}"])].append(row["path"])
    errors += [(entry_of(p), "empty file: no header line") for p in paths if entry_of(p) not in known]
    return [read_layout(spark, headers, plain, broken, separator)
            for (separator, headers), (plain, broken) in groups.items()], errors


def scan_layouts(spark: SparkSession, folder: str) -> tuple[list[Layout], list[tuple[str, str]]]:
    """S3: the layouts of a folder's CSV files, and ``(file, error)`` for those that have none."""
    return scan_files(spark, list_files(spark, folder))


def rejected_rows(spark: SparkSession, layouts: Sequence[Layout]) -> DataFrame:
    """source_file, line, reason of every row that does not fit its file's header."""
    out = spark.createDataFrame([], "source_file string, _row_no long, line string, reason string")
    return reduce(DataFrame.unionByName, [l.rejected for l in layouts], out).select("source_file", "line", "reason")


def read_raw(spark: SparkSession, paths: str | list[str], fmt: str = "csv") -> DataFrame:
    """Read files with one header row; every column as string, plus
    ``source_file`` and ``_row_no``. Rows that do not fit are left out (``scan_files`` tells them)."""
    paths = [paths] if isinstance(paths, str) else paths
    if fmt == "csv":
        layouts, errors = scan_files(spark, paths)
        if errors or len(layouts) != 1:
            raise ValueError(f"not one header: {errors or [l.headers for l in layouts]}")
        return layouts[0].frame
    if fmt != "parquet":
        raise ValueError(f"unsupported raw format: {fmt}")
    df = spark.read.parquet(*paths)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns],
                     _entry_name().alias("source_file"), F.monotonically_increasing_id().alias("_row_no"))


def scan_landing(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    """S3: ``(file name, raw frame)`` for every readable CSV file of ``folder``, in sorted order
    (for a handful of files; :func:`scan_layouts` reads many). One scan finds all headers."""
    layouts, _ = scan_layouts(spark, folder)
    return sorted(((name, layout.frame.where(F.col("source_file") == name).drop("source_file"))
                   for layout in layouts for name in layout.files), key=lambda x: x[0])
