"""Language identification by hierarchical discrimination.

A text becomes one vector: counts of its hashed byte trigrams and bigrams
(ASCII letters lower-cased, other ASCII bytes as one), square-rooted and
scaled to length one. A first linear classifier predicts the language
family; inside a family one-versus-one linear support vector machines tell
its languages apart, the most pairwise votes winning (ties: the larger sum of
margins, then the smaller name).

Training uses at most ``FIT_DOCS`` labelled documents, ``FIT_PER_LANG`` a
language at most, those with the smallest text hashes; equal texts count
once. Only text and lang are used. Families come from a fixed table; a
language outside it is a family of its own.

Defined cases: a null text or one without a letter is ``und`` with score 0;
a null lang is never learned; with no labelled document at all every text is
``und``; with one language every other text gets it; an empty table gives an
empty result; very long texts are read whole; extra columns are carried.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common as C
from . import textkit as K

DIMENSIONS = 1 << 12
FIT_DOCS = 4000
FIT_PER_LANG = 400
UNKNOWN = "und"
# Language families of ISO 639-1 codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_FOLD = K.LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0], f"alone:{lang}")


def features(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit vectors (float32) of a block of texts."""
    offsets = offsets - offsets[0]
    n = len(offsets) - 1
    out = np.zeros((n, DIMENSIONS), np.float32)
    if len(buf) < 3:
        return out
    b = _FOLD[buf].astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    doc = np.repeat(np.arange(n, dtype=np.int64) * DIMENSIONS, np.diff(offsets))
    width = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for grams in (two, three):
        size = len(buf) - len(grams)
        cell = (grams * np.uint32(2654435761)) >> width
        inside = doc[:-size] == doc[size:]
        keep = inside & (grams != 0x2020) & (grams != 0x202020)
        out += np.bincount((doc[:-size] + cell)[keep], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    np.divide(out, norm, out=out, where=norm > 0)
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, epochs: int = 30, seed: int = 7):
    """(weights, bias) of an L2-loss linear SVM, labels +-1, by dual coordinate descent."""
    n, d = x.shape
    w, bias, alpha = np.zeros(d), 0.0, np.zeros(n)
    x = x.astype(np.float64)
    diagonal = (x * x).sum(axis=1) + 1.0 + 0.5 / penalty
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(n):
            gradient = y[i] * (x[i] @ w + bias) - 1 + alpha[i] * 0.5 / penalty
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            step = (new - alpha[i]) * y[i]
            if step:
                w += step * x[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32), float(bias)


class Model:
    """Two levels of linear classifiers over the feature vectors."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        labels = np.array(langs)
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(v) for v in self.langs})
        family = np.array([family_of(v) for v in langs])
        self.root = self._one_against_rest(x, family, self.families)
        self.members = {f: [v for v in self.langs if family_of(v) == f] for f in self.families}
        self.pairs = {}
        for f, members in self.members.items():
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    rows = (labels == a) | (labels == b)
                    self.pairs[a, b] = linear_svm(x[rows], np.where(labels[rows] == a, 1.0, -1.0))

    @staticmethod
    def _one_against_rest(x, labels, names):
        if len(names) < 2:
            return []
        if len(names) == 2:
            w, b = linear_svm(x, np.where(labels == names[0], 1.0, -1.0))
            return [(w, b), (-w, -b)]
        return [linear_svm(x, np.where(labels == name, 1.0, -1.0)) for name in names]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if len(self.families) > 1:
            margins = np.stack([x @ w + b for w, b in self.root], axis=1)
            family = margins.argmax(axis=1)
            score = 1 / (1 + np.exp(-2 * margins.max(axis=1)))
        else:
            family, score = np.zeros(n, int), np.ones(n)
        out = np.empty(n, object)
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            members = self.members[name]
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(members)))
            margin_sum = np.zeros_like(votes)
            least = np.full_like(votes, np.inf)
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    w, b = self.pairs[a, members[j]]
                    m = x[rows] @ w + b
                    for side, value in ((i, m), (j, -m)):
                        votes[:, side] += value > 0
                        margin_sum[:, side] += value
                        least[:, side] = np.minimum(least[:, side], value)
            best = (votes + 1e-3 * np.tanh(margin_sum)).argmax(axis=1)
            out[rows] = np.array(members, object)[best]
            if len(members) > 1:
                score[rows] *= 1 / (1 + np.exp(-2 * least[np.arange(len(rows)), best]))
        return out.tolist(), np.clip(score, 0, 1)


def _with_letter(docs: DataFrame, keep: list[str]) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), F.col("text"),
                       F.coalesce(F.rlike(F.col("text"), F.lit(r"\p{L}")), F.lit(False)).alias("letter"))


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS, per_lang: int = FIT_PER_LANG) -> Model | None:
    """Trains on a bounded sample of (text, lang) rows; None if there is none."""
    C.prepare(labelled.sparkSession)
    rows = (labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
            .withColumn("h", F.xxhash64("text")))
    # at least two rows a language: of more languages than that leaves room for, the most frequent are learned
    sizes = (rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(max(1, fit_docs // 2)).collect())
    if not sizes:
        return None
    most = max(2, min(per_lang, fit_docs // len(sizes)))
    # one hash range a language, a little wider than needed
    share = labelled.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2.0 * most / max(1, r["n"]))) for r in sizes], "lang string, share double")
    unit = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)
    near = rows.join(F.broadcast(share), "lang").filter(unit < F.col("share")).drop("share")
    chosen = near.groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = chosen.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= most)

    def vectors(batches):
        for batch in batches:
            buf, off = K.utf8(batch.column("text"))
            for i, j in K.blocks(off):
                x = features(buf[off[i]:off[j]], off[i:j + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(i, j - i), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["lang", "x"])

    got = sorted(chosen.select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect())
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got])
    return Model(x, [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """record (the columns ``keep``, default all), lang_pred, score for every row of ``docs``."""
    spark = docs.sparkSession
    C.prepare(spark)
    keep = keep or docs.columns
    rows = _with_letter(docs, keep)
    schema = rows.select("record").schema.add("lang_pred", "string").add("score", "double")
    shared = spark.sparkContext.broadcast(model)

    def label(batches):
        model = shared.value
        for batch in batches:
            buf, off = K.utf8(batch.column("text"))
            letter = batch.column("letter").to_numpy(zero_copy_only=False)
            langs, scores = [], []
            for i, j in K.blocks(off):
                if model is None:
                    got, score = [UNKNOWN] * (j - i), np.zeros(j - i)
                else:
                    got, score = model.predict(features(buf[off[i]:off[j]], off[i:j + 1]))
                ok = letter[i:j]
                langs += [v if k else UNKNOWN for v, k in zip(got, ok)]
                scores += np.where(ok, score, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("record"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["record", "lang_pred", "score"])

    return rows.mapInArrow(label, schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Fits on the documents that are not held out and labels all of them."""
    model = fit(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    return predict(docs, model, keep)


def query(spark, sf_dir: str) -> DataFrame:
    out = identify(C.documents(spark, sf_dir), ["doc_id"])
    return out.select(F.col("record.doc_id").alias("doc_id"), "lang_pred", "score").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
