"""Small tables with the awkward cases every operator must define, and brute-force twins."""
from __future__ import annotations

import random
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Extra columns whose names clash with those the operators use inside.
CLASHES = ["size", "record", "class", "key", "found", "marks", "ids", "bucket", "copies", "place", "text_crc32"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}{rng.choice(['', '', '.', ','])}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long text and word, repeated rows, near copies."""
    rng = random.Random(5)
    base = [sentence(rng, 120, 10_000) for _ in range(12)]
    rows = [(k, t, ["en", "fr"][k % 2], f"s{k % 3}", len(t)) for k, t in enumerate(base)]
    rows += [(20 + k, base[k], "en", "s0", 1) for k in range(5)]                       # copies
    for k in range(5):                                                                  # near copies
        words = base[k].split()
        words[60] = "changed"
        rows.append((30 + k, " ".join(words), "en", "s1", 1))
    rows += [(40, None, None, None, None), (41, "", "en", None, 0), (42, " \n\t ", None, "s0", 3),
             (43, "one two", "en", "s9", 7), (44, "one TWO", None, "s9", 7), (45, "x" * 20000, "fr", "s2", 20000),
             (46, sentence(rng, 6000), "en", "s2", None), (47, "é ñ — “q”  two  spaces\nline <|endoftext|> !", "fr", "s2", 1),
             (48, "12345 !!! 678", None, "s1", 2), (None, base[0], "en", "s0", 5), (None, "alone here", "en", "s0", 5)]
    rows += [(50, base[7], "en", "s0", 9)] * 3                                          # repeated rows
    return rows


def odd_documents(spark, extra: bool = True):
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
    return df


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


class Groups:
    """Union by smallest member."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def unit_rows(n: int, dim: int, seed: int) -> np.ndarray:
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)
