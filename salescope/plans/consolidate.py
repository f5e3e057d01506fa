"""Raw supplier tables -> standardised tables -> consolidated fact, with an
ingest log (S4) that records each file's mapping, row count or error.

A file whose mapping lacks a required field is quarantined: it gets an
``error`` row in the log and the other files go on.
"""
from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..operators import ingest
from ..sources import fixtures
from ..sources.materialize import materialized
from ..sources.raw import Layout

LOG_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("seller", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("mapping", T.StringType()),
    T.StructField("error", T.StringType()),
])


def mapping_json(mapping: Mapping[str, str | None]) -> str:
    """Mapping as JSON in the fixed field order (unmapped fields left out)."""
    return json.dumps({f: mapping[f] for f in S.FIELDS if mapping.get(f)}, ensure_ascii=False)


def standardize_all(sources: Sequence[tuple[str, str, Mapping, DataFrame]]
                    ) -> tuple[list[DataFrame], list[tuple]]:
    """Standardise every source that has its required fields; return the
    frames in file order and one metadata tuple per file for the log."""
    frames, meta = [], []
    for name, seller, mapping, raw in sources:
        missing = ingest.missing_required(mapping)
        if missing:
            meta.append((name, seller, "error", mapping_json(mapping),
                         f"required fields not found: {missing}"))
            continue
        frames.append(ingest.standardize(raw, mapping, seller, name))
        meta.append((name, seller, "ok", mapping_json(mapping), None))
    return frames, meta


def ingest_log(spark: SparkSession, stacked: DataFrame | None, meta: list[tuple]) -> DataFrame:
    """One row per file with status, mapping, rows standardised and error.

    The per-file metadata is a handful of rows (one per file); the row
    counts come from the data and are reduced to one row per file before the
    join.
    """
    log = spark.createDataFrame(meta, LOG_SCHEMA)
    if stacked is None:
        return log.withColumn("rows", F.lit(None).cast("bigint"))
    counts = stacked.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    return (log.join(counts, "source_file", "left")
               .select("source_file", "seller", "status", "rows", "mapping", "error"))


def log_for_files(log: DataFrame, files: DataFrame) -> DataFrame:
    """The log restricted to the files of one upload (left semi join)."""
    return log.join(files.select("source_file"), "source_file", "left_semi")


def stack_layouts(layouts: Sequence[Layout], mapping_of: Callable[[Layout], Mapping[str, str | None]],
                  seller: Column) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """U1 over the layouts of a landing folder: one standardised branch a layout, whatever
    the number of files; files rank by name. Also ``(file, error)`` of the files left out."""
    frames, errors = [], []
    for layout in layouts:
        mapping = mapping_of(layout)
        missing = ingest.missing_required(mapping)
        if missing:
            errors += [(f, f"required fields not found: {missing}") for f in layout.files]
        else:
            frames.append(ingest.standardize(layout.frame, mapping, seller, F.col("source_file"))
                          .withColumn("_source_rank", F.col("source_file")))
    return (reduce(DataFrame.unionByName, frames) if frames else None), errors


def landing_log(spark: SparkSession, files: Sequence[str], errors: Sequence[tuple[str, str]],
                stacked: DataFrame | None) -> DataFrame:
    """S4 for a landing folder: per file its status, the rows read, those without a date and
    without an amount (both are left out of the fact), and the error of a file that was not read."""
    failed = dict(errors)
    log = spark.createDataFrame([(f, "error" if f in failed else "ok", failed.get(f)) for f in files],
                                "source_file string, status string, error string")
    if stacked is None:
        return log.select("source_file", "status", *[F.lit(None).cast("bigint").alias(c)
                                                     for c in ("rows", "no_date", "no_amount")], "error")
    counts = stacked.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("sale_date").isNull()).alias("no_date"),
        F.count_if(F.col("amount") <= 0).alias("no_amount"))
    return log.join(counts, "source_file", "left").select(
        "source_file", "status", "rows", "no_date", "no_amount", "error")


class Ingest:
    """The ingest plan over the supplier files of one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, sources=None,
                 tag: str = "known"):
        self.spark, self.sf_dir, self.tag = spark, sf_dir, tag
        self.sources = sources if sources is not None else fixtures.supplier_sources(spark, sf_dir)
        self.frames, self.meta = standardize_all(self.sources)

    def stacked(self) -> DataFrame:
        """U1 over the standardised files. For the given tables the stacked rows
        are written once (parsing happens once) and read back."""
        if self.sf_dir is None:
            return ingest.union_sources(self.frames)
        return materialized(self.spark, f"stacked-{self.tag}", self.sf_dir.rstrip("/"),
                            lambda: ingest.union_sources(self.frames))

    def cleaned(self) -> DataFrame:
        return ingest.clean(self.stacked())

    def _by_rank(self, steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``steps`` over the clean rows; for the given tables without the columns that are one value a file, which its
        rank puts back."""
        if self.sf_dir is None:
            return steps(self.cleaned())
        per_file = {"seller": 1, "source_file": 0}
        ranks = enumerate(m for m in self.meta if m[2] == "ok")
        ranks = [(F.lit(rank), m) for rank, m in ranks]
        out = steps(self.cleaned().drop(*per_file))
        return out.select("*", *[F.element_at(F.create_map(*[x for rank, m in ranks for x in (rank, F.lit(m[k]))]),
                                              F.col("_source_rank")).alias(c) for c, k in per_file.items()])

    def deduped(self) -> DataFrame:
        """A18 in the plan of the query, which reads the rows once: nothing but its result is written."""
        return self._by_rank(ingest.distinct_dedup).select(
            *ingest.DEDUP_KEYS, "_source_rank", "_row_no",
            *[c for c in ingest.STANDARD_COLUMNS if c not in ingest.DEDUP_KEYS])

    def fact(self) -> DataFrame:
        if self.sf_dir is None:
            return ingest.finalize(ingest.canonical_name(self.deduped()))
        return ingest.finalize(self._by_rank(ingest.dedup_and_name))

    def names(self) -> DataFrame:
        """J1 (lookup side): the dedup shuffles only its keys, the order and the names."""
        return ingest.canonical_names(ingest.distinct_dedup(self.cleaned().select(
            *ingest.DEDUP_KEYS, "_source_rank", "_row_no", "product_name")))

    def fact_once(self, columns: Sequence[str]) -> DataFrame:
        """Some columns of the fact for a query that reads it once: the dedup is part of its plan, so only the
        columns it needs are shuffled and nothing is written. Besides the keys, the names are always there."""
        rows = [*ingest.DEDUP_KEYS, "_source_rank", "_row_no", "product_name",
                *[c for c in columns if c in ingest.STANDARD_COLUMNS]]
        rows = [c for c in self.stacked().columns if c in rows]
        deduped = ingest.distinct_dedup(self.cleaned().select(*rows))
        return ingest.finalize(ingest.canonical_name(deduped)).select(*columns)

    def log(self) -> DataFrame:
        return ingest_log(self.spark, self.stacked() if self.frames else None, self.meta)

    def counts(self) -> DataFrame:
        return ingest.ingest_counts(self.stacked(), self.fact_once(["source_file", "sale_date"]))

    def raw_column(self, field: str) -> DataFrame:
        """(source_file, text) of one canonical field over every mapped source."""
        out = None
        for name, _, mapping, raw in self.sources:
            if not mapping.get(field) or ingest.missing_required(mapping):
                continue
            df = raw.select(F.lit(name).alias("source_file"),
                            F.col(f"`{mapping[field]}`").cast("string").alias("text"))
            out = df if out is None else out.unionByName(df)
        return out


AUTO_SELLER_PREFIX = "Auto · "  # fixed value: seller of a file whose mapping was inferred


def auto_seller(file_name: str) -> str:
    """Default seller of an uploaded file: the prefix and the file name without extension."""
    return AUTO_SELLER_PREFIX + file_name.rsplit(".", 1)[0]


def inferred_sources(spark: SparkSession, sf_dir: str, mapping: DataFrame
                     ) -> list[tuple[str, str, dict, DataFrame]]:
    """The supplier files with the column mapping the classifier inferred
    (``mapping``: source_file, field, column, confidence). The mapping has at
    most nine rows per file, so it is read back as metadata."""
    inferred: dict[str, dict[str, str]] = {}
    for r in mapping.select("source_file", "field", "column").collect():
        inferred.setdefault(r["source_file"], {})[r["field"]] = r["column"]
    return [(name, auto_seller(name), inferred.get(name, {}), raw)
            for name, _, _, raw in fixtures.raw_sources(spark, sf_dir)]


def empty_fact(spark: SparkSession) -> DataFrame:
    """K4: a fact table with no rows and the fixed 13-column schema."""
    return spark.createDataFrame([], S.FACT_SCHEMA)


def inferred_log(files: DataFrame, mapping: DataFrame, rows: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """S4 for files whose mapping was inferred: per file its status, rows read and rejected, the mapping and its
    confidences as JSON in field order, and the error of a file that lacks required fields.

    ``files``: source_file; ``mapping``: source_file, field, column, confidence (at most nine rows a file);
    ``rows`` and ``rejected``: any rows with source_file, counted here.
    """
    order = F.array_position(F.array(*[F.lit(f) for f in S.FIELDS]), F.col("field"))
    found = mapping.groupBy("source_file").agg(F.array_sort(F.collect_list(
        F.struct(order.alias("at"), "field", "column", "confidence"))).alias("found"))
    counts = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    out = files.select("source_file").distinct().join(found, "source_file", "left").join(counts, "source_file", "left")
    if rejected is None:
        out = out.withColumn("rejected", F.lit(0).cast("bigint"))
    else:
        out = out.join(rejected.groupBy("source_file").agg(F.count(F.lit(1)).alias("rejected")), "source_file", "left")
    fields = F.coalesce(F.col("found.field"), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(f) for f in S.REQUIRED_FIELDS]), fields)
    none = F.lit("{}")
    return out.select(
        "source_file", F.when(F.size(missing) > 0, "error").otherwise("ok").alias("status"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        F.coalesce("rejected", F.lit(0).cast("bigint")).alias("rejected"),
        F.coalesce(F.to_json(F.map_from_arrays("found.field", "found.column")), none).alias("mapping"),
        F.coalesce(F.to_json(F.map_from_arrays("found.field", "found.confidence")), none).alias("confidences"),
        F.when(F.size(missing) > 0, F.concat(F.lit("required fields not found: "), F.array_join(missing, ", "))).alias("error"))
