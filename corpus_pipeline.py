"""Training-data pipeline: language ID, n-gram Jaccard join, secret scans, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salescope.llm import common as C
from salescope.llm import jaccard_join, langid, mixing, packing, secret_crf


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language go; a missing lang is filled with the prediction."""
    out = langid.identify(docs).filter(F.col("lang_pred") != langid.UNKNOWN)
    return out.select(F.col("record").withField("lang", F.coalesce("record.lang", "lang_pred")).alias("record")
                      ).select("record.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity the document with the smallest doc_id stays, once.

    A document is told by doc_id and text. One without doc_id stays only where its whole group has none, and then
    (as among rows of the smallest doc_id) the smallest text hash; texts without a word are linked with nothing.
    """
    wordless = F.when(F.col("n_shingles") == 0, F.col("text_hash")).alias("wordless")
    stay = (jaccard_join.join(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("doc_id", "part", wordless).agg(F.min("text_hash").alias("text_hash"))
            .select("doc_id", "text_hash").distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                       F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    return (rows.join(stay, rows["id"].eqNullSafe(stay["doc_id"]) & (rows["hash"] == stay["text_hash"]), "left_semi")
            .dropDuplicates(["id", "hash"]).select("record.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; every document stays."""
    return secret_crf.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source nears its target."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences, with their token ids."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None      # classifiers, hashing vocabularies and packing are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    docs = C.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = C.store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
