"""Ingest operators: standardise raw tables, stack, clean, dedup, canonicalise.

A raw table is an all-string DataFrame with arbitrary headers plus a
``_row_no`` column (its row order). A mapping is ``{field: column}`` for the
canonical fields of :data:`salescope.schema.FIELDS`.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions import expressions as E
from .joins import bounded_broadcast, has_at_most

DEDUP_KEYS = ["customer_id", "sale_date", "product_code", "amount", "quantity"]
STANDARD_COLUMNS = [f.name for f in S.STANDARD_SCHEMA.fields]


def missing_required(mapping: Mapping[str, str | None]) -> list[str]:
    """required fields a mapping does not provide."""
    return [f for f in S.REQUIRED_FIELDS if not mapping.get(f)]


def standardize(raw: DataFrame, mapping: Mapping[str, str | None], seller: str | Column,
                source_file: str | Column, carry: Sequence[str] = ()) -> DataFrame:
    """One ``select`` from raw text columns to the 11 standard columns.

    Optional fields fall back: customer name to the raw id, region to
    ``??``, product code to the synthetic code, channel to ``NAO INFORMADO``.
    ``_row_no`` is carried along when present so dedup can keep file order, and
    so are the columns ``carry``.
    """
    missing = missing_required(mapping)
    if missing:
        raise ValueError(f"{source_file}: required fields not mapped: {missing}")
    m = {k: v for k, v in mapping.items() if v}

    def col(field: str) -> Column:
        return F.col(f"`{m[field]}`").cast("string")

    product = E.normalize_text(col("product_name"))
    synthetic = E.synthetic_code(col("product_name"))
    if "product_code" in m:
        code = F.coalesce(E.numeric_code(col("product_code")), synthetic)
    else:
        code = synthetic
    out = [
        (E.normalize_text(col("customer_name")) if "customer_name" in m
         else col("customer_id")).alias("customer_name"),
        E.normalize_id(col("customer_id")).alias("customer_id"),
        (E.normalize_upper(col("region")) if "region" in m
         else F.lit(S.UNKNOWN_REGION)).alias("region"),
        E.parse_mixed_date(col("sale_date")).alias("sale_date"),
        code.alias("product_code"),
        product.alias("product_name"),
        E.coerce_amount(col("amount")).alias("amount"),
        E.coerce_quantity(col("quantity")).alias("quantity"),
        (E.normalize_upper(col("channel")) if "channel" in m
         else F.lit(S.UNKNOWN_CHANNEL)).alias("channel"),
        (seller if isinstance(seller, Column) else F.lit(seller)).alias("seller"),
        (source_file if isinstance(source_file, Column) else F.lit(source_file))
        .alias("source_file"),
    ]
    if "_row_no" in raw.columns:
        out.append(F.col("_row_no").cast("bigint").alias("_row_no"))
    return raw.select(*out, *carry)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack standardised tables by name; ``_source_rank`` keeps their order.

    Every table must bring ``_row_no``, the row order within its file: dedup
    keeps the first row, and without the order that would be any row.
    """
    ranked = []
    for rank, df in enumerate(frames):
        if "_row_no" not in df.columns:
            raise ValueError("a standardised table needs _row_no, its row order")
        ranked.append(df.select(*STANDARD_COLUMNS, "_row_no",
                                F.lit(rank).alias("_source_rank")))
    out = ranked[0]
    for df in ranked[1:]:
        out = out.unionByName(df)
    return out


def clean(df: DataFrame) -> DataFrame:
    """keep rows with a date and a positive amount."""
    return df.where(F.col("sale_date").isNotNull() & (F.col("amount") > 0))


def distinct_dedup(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """One row per key, the first in (source order, row order).

    Written as an aggregation of ``min(struct(order, payload))`` instead of a
    window: map-side partial aggregation collapses a hot group of copies in
    every task before the shuffle, so no single task receives all copies.
    The payload is part of the struct, so ties in row order stay deterministic.
    """
    order_cols = [c for c in ("_source_rank", "_row_no") if c in df.columns]
    payload = [c for c in df.columns if c not in keys and c not in order_cols]
    first = F.min(F.struct(*[F.col(c) for c in order_cols + payload])).alias("_first")
    return (df.groupBy(*keys).agg(first)
              .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_cols + payload]))


# Writes a table under a name and reads it back.
Keep = Callable[[str, DataFrame], DataFrame]
# Keys that occur more than once and codes with several names go to every task up to so many.
LOOKUP_ROWS = 100_000
# Codes are counted in so many buckets of their hashes; the rows of a bucket meet in one task up to so many, or up to
# so many times the mean.
CODE_BUCKETS, CODE_ROWS, CODE_SHARE = 1 << 14, 100_000, 4


def repeated_keys(df: DataFrame, keep: Keep, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Hashes of the keys that more than one row has (or, by an odd chance, more than one key), written by ``keep``."""
    return keep("repeated", df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select("_hash"))


def dedup_mostly_unique(df: DataFrame, keep: Keep, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """A18 for rows that are read from a table and of which few repeat.

    Hashes of the keys are counted first: a row whose hash occurs once has no
    copy and stays where it is; only rows whose hash repeats (copies, and the
    odd chance collision) are shuffled whole and deduplicated by their keys.
    ``keep`` writes the repeated hashes, so they are counted once. Where they
    are too many for every task, all rows are deduplicated.
    """
    key_hash, repeated = F.xxhash64(*keys), repeated_keys(df, keep, keys)
    if not has_at_most(repeated, LOOKUP_ROWS):
        return distinct_dedup(df, keys)
    repeated, same = F.broadcast(repeated), key_hash == F.col("_hash")
    copies = distinct_dedup(df.join(repeated, same, "left_semi"), keys)
    return df.join(repeated, same, "left_anti").unionByName(copies)


def canonical_names(df: DataFrame) -> DataFrame:
    """J1 (lookup side): per code, the longest product name (ties: greatest).

    The different (code, name) pairs come first: a hash aggregation that
    shrinks map-side, so the sort-based maximum sees few rows per code.
    """
    return (df.where(F.col("product_code").isNotNull() & F.col("product_name").isNotNull())
              .select("product_code", "product_name").distinct()
              .groupBy("product_code")
              .agg(F.max(F.struct(F.length("product_name").alias("n"),
                                  F.col("product_name").alias("name"))).alias("_m"))
              .select("product_code", F.col("_m.name").alias("product_canon")))


def differing_names(df: DataFrame) -> DataFrame:
    """J1 for the codes of which some row has another name than the longest, or none."""
    return (df.where(F.col("product_code").isNotNull())
              .select("product_code", "product_name").distinct()
              .groupBy("product_code")
              .agg(F.max(F.when(F.col("product_name").isNotNull(), F.struct(
                  F.length("product_name").alias("n"), F.col("product_name").alias("name")))).alias("_m"),
                   F.count(F.lit(1)).alias("_names"))
              .where("_names > 1").select("product_code", F.col("_m.name").alias("product_canon")))


def crowded(df: DataFrame, key: str) -> tuple[Column | None, bool]:
    """Whether the ``key`` of a row is in a bucket of hashes with so many rows that they should not meet in one task
    (None where no bucket has), and whether any row has no key. At most ``CODE_BUCKETS`` counts come back."""
    bucket = F.pmod(F.xxhash64(key), F.lit(CODE_BUCKETS)).cast("int")
    counts = {r["bucket"]: r["n"] for r in df.groupBy(F.when(F.col(key).isNotNull(), bucket).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    nulls = counts.pop(None, 0)
    most = max(CODE_ROWS, CODE_SHARE * sum(counts.values()) // CODE_BUCKETS)
    many = sorted(b for b, n in counts.items() if n > most)
    return (bucket.isin(many) if many else None), nulls > 0


def dedup_and_name(df: DataFrame) -> DataFrame:
    """A18 and J1 for rows that are read from a table: whole rows are shuffled once.

    Copies of a row have one product code, as have the rows that share a
    canonical name: dealt by the code, both steps find their rows in the same
    partition. Rows of crowded codes go by all keys, copies collapsing before the
    shuffle, so that no task receives them all; their names are a small lookup.
    So do rows without a code, which keep their names. (Rows with and without are
    kept apart for a second reason: the names' side filters by the code, and only
    below the same filter is the shuffle of the rows used by both sides.)
    """
    many, nulls = crowded(df, "product_code")
    coded = df.where(F.col("product_code").isNotNull())
    first = distinct_dedup((coded if many is None else coded.where(~many)).repartition("product_code"))
    out = canonical_name(first, names=first)
    if many is not None:
        few_codes = has_at_most(coded.where(many).select("product_code").distinct(), LOOKUP_ROWS)
        first = distinct_dedup(coded.where(many))
        out = out.unionByName(canonical_name(first, names=first, few_codes=few_codes))
    if nulls:
        first = distinct_dedup(df.where(F.col("product_code").isNull()))
        out = out.unionByName(first.withColumn("product_canon", F.col("product_name")))
    return out


def canonical_name(df: DataFrame, keep: Keep | None = None, names: DataFrame | None = None,
                   few_codes: bool = False) -> DataFrame:
    """Attach ``product_canon``; rows without a match keep their own name.

    The lookup has one row per product; the join is left on the code, and
    AQE turns it into a broadcast at run time when the lookup is small. With
    ``keep`` the lookup, which then has only the codes that have several names,
    is written first: where it is small, the rows are not shuffled at all.
    ``names`` are the same rows with only the columns that the lookup needs:
    where the rows cost a shuffle and are read twice, the second time is narrow.
    Its codes, each of which comes once, then go into a hash table for each
    part, so the wide rows are not sorted; ``few_codes``, a proven bound, sends
    them to every task instead.
    """
    if names is not None:
        canon = canonical_names(names)
        canon = F.broadcast(canon) if few_codes else canon.hint("shuffle_hash")
    elif keep is None:
        canon = canonical_names(df)
    else:
        canon = bounded_broadcast(keep("names", differing_names(df)), LOOKUP_ROWS)
    return (df.join(canon, "product_code", "left")
              .withColumn("product_canon",
                          F.coalesce(F.col("product_canon"), F.col("product_name"))))


def finalize(df: DataFrame) -> DataFrame:
    """P10 + P9: date at midnight, unit price; the 13 fact columns in order (those that ``df`` has)."""
    return df.select(
        *[E.to_midnight("sale_date").alias("sale_date") if c == "sale_date" else F.col(c)
          for c in STANDARD_COLUMNS if c in df.columns],
        F.col("product_canon"),
        E.unit_price("amount", "quantity").alias("unit_price"),
    )


def consolidate(frames: Sequence[DataFrame],
                keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Standardised tables -> fact: union, clean, dedup, canonicalise, finalise.

    The deduplicated rows are read twice (names, then rows); ``keep`` may write
    them once and give them back.
    """
    return finalize(canonical_name(keep(distinct_dedup(clean(union_sources(frames))))))


def ingest_counts(stacked: DataFrame, fact: DataFrame) -> DataFrame:
    """Per source file, rows read, rows valid, rows kept and date span.

    ``stacked`` is the union of standardised tables, ``fact`` the
    consolidated result. Both sides are reduced to one row per file before
    the join.
    """
    read = (stacked.groupBy("source_file")
                   .agg(F.count(F.lit(1)).alias("rows_read"),
                        F.count_if(F.col("sale_date").isNotNull() & (F.col("amount") > 0))
                         .alias("rows_valid")))
    kept = (fact.groupBy("source_file")
                .agg(F.count(F.lit(1)).alias("rows_kept"),
                     F.min("sale_date").alias("first_date"),
                     F.max("sale_date").alias("last_date")))
    return (read.join(kept, "source_file", "left")
                .select("source_file", "rows_read", "rows_valid",
                        F.coalesce("rows_kept", F.lit(0).cast("bigint")).alias("rows_kept"),
                        "first_date", "last_date"))
