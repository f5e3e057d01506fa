"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; a document's expected copies are
``target / source_size``. Within a source the documents are put in a fixed
order (size, then a seeded hash), their expected copies are prefix-summed,
one random offset per source is added, and a document is emitted once for
each integer boundary its interval crosses. Sorting by size stratifies the
draw, so a source's taken words differ from its target by about one
document.

The prefix sum is distributed: rows are range-partitioned by
(source, size, hash), ranked inside their partition, and shifted by the
partition totals, so a source that holds most rows is spread over many tasks.

Defined cases: null or blank text has size 0 and takes 0 words; the null
source is a source of its own, last in order; an empty table gives an empty
result; documents of size 0 are still drawn (they take no words); rows
equal in every column are interchangeable and share their copies; extra
columns of any name are carried untouched by ``mix_documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from . import common as C

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = 20
COPIES_A_TASK = 1000           # equal rows written out together


def source_targets(sized: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT,
                   most_copies: int = MOST_COPIES) -> DataFrame:
    """One row per source: size, weight, target.

    Weights repeat over the sources in code-point order, null last. A target
    stops at ``most_copies`` times the source; what that leaves over is shared
    again by weight. With the sources in order of cap / weight the shared level
    is the largest of ``(total - caps before) / weights from here``.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    at = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (at + 1).cast("int")).cast("long")
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_copies)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * share_percent / F.lit(100.0)
    level = (total - before) / left
    return (ranked.withColumn("level", level)
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target")))


def mix(sized: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """(doc_id, source, size[, key]) -> the same rows with source_size, target and copies."""
    spark = sized.sparkSession
    C.prepare(spark)
    keys = [c for c in ("key",) if c in sized.columns]
    # ties are interchangeable rows; the row number only spreads them over partitions
    # written first: drawing the bounds of the ranges reads the sizes once more, and they cost a pass over the texts
    sized = C.store(sized.withColumn("_tie", F.monotonically_increasing_id()), "sized")
    ranged = (sized.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"))))
              .repartitionByRange(C.parallelism(spark), "source", "size", "_draw", "_tie")
              .withColumn("_part", F.spark_partition_id()))
    ranged = C.store(ranged, "mix")
    parts = ranged.groupBy("_part", "source").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", "source", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part", "source").orderBy("size", "_draw", "doc_id", "_tie")
    ranked = ranged.withColumn("_rank", F.row_number().over(within))
    targets = source_targets(sized=ranged, **options)
    o, t = offsets.alias("o"), targets.alias("t")
    joined = (ranked.alias("r")
              .join(o, (F.col("r._part") == F.col("o._part")) & F.col("r.source").eqNullSafe(F.col("o.source")))
              .join(t, F.col("r.source").eqNullSafe(F.col("t.source"))))
    rate = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    rank = (F.col("r._rank") + F.col("o._before")).cast("double")
    offset = C.seeded_unit(seed, "r.source")
    copies = F.floor(rank * rate + offset) - F.floor((rank - 1) * rate + offset)
    return joined.select("r.doc_id", "r.source", "r.size", *[f"r.{k}" for k in keys],
                         "t.source_size", "t.target", copies.cast("long").alias("copies"))


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mixed corpus itself: whole rows of ``docs``, each repeated as often as drawn."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = rows.withColumn("key", F.concat_ws(
        "|", F.xxhash64("row").cast("string"), F.col("row.doc_id").cast("string")))
    sized = keyed.select("key", F.col("row.doc_id").alias("doc_id"),
                         F.col("row.source").alias("source"), word_count("row.text").alias("size"))
    drawn = (mix(sized, seed, **options).groupBy("key")
             .agg(F.sum("copies").alias("n"), F.count("*").alias("rows")).filter("n > 0"))
    joined = keyed.join(drawn, "key")
    once = joined.filter("rows = 1").unionByName(joined.filter("rows > 1").dropDuplicates(["key"]))
    # a row with many equal ones is written out in many tasks, a few copies in each
    many = F.col("n") > COPIES_A_TASK
    parts = (once.filter(many).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(
        (F.col("n") - 1) / COPIES_A_TASK)))).repartition(C.parallelism(docs.sparkSession), "key", "part")
        .withColumn("n", F.least(F.lit(COPIES_A_TASK), F.col("n") - F.col("part") * COPIES_A_TASK)).drop("part"))
    return (once.filter(~many).unionByName(parts)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    mixed = mix(docs.select("doc_id", "source", word_count().alias("size")))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100.0::DOUBLE
             - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight::DOUBLE, source IS NULL, source)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target,
         ('0x' || substr(md5('20|' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM levels),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, md5(concat_ws('|', '20', s.doc_id::VARCHAR)), s.doc_id)::DOUBLE AS n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(n * rate + u) - floor((n - 1) * rate + u))::BIGINT AS taken FROM ranked
"""
