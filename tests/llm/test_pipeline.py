"""The pipeline's stages against brute force, one after the other, and the registry."""
from __future__ import annotations

from collections import Counter

import odd_tables as O
import pytest
from pyspark.sql import functions as F
from test_pairs import brute_groups
from test_texts import base_of

import __spark_entry__ as entry
import corpus_pipeline as P
from salescope.llm import common as C, mixing, tokens as T


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """documents.parquet: the odd rows and some with secrets."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = O.odd_rows() + [(2000 + k, f"words around here {k} password=abcdef{k:04d}99 and after it number {k * 7919}", "en",
                            f"s{k % 4}", 9) for k in range(30)]
    spark.createDataFrame(rows, O.DOCS).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, tables):
    docs = C.documents(spark, tables)
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = C.store(stage(spark, docs, tables), "test-stage")
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "language ID":
            assert Counter((r.doc_id, r.text) for r in kept[name]) == Counter(
                (r.doc_id, r.text) for r in before if any(c.isalpha() for c in r.text or ""))
            assert all(r.lang in ("en", "fr") for r in kept[name])
        if name == "n-gram Jaccard join":
            groups = brute_groups([(r.doc_id, r.text) for r in before if r.doc_id is not None])
            ids = sorted(r.doc_id for r in kept[name] if r.doc_id is not None)
            assert ids == sorted(i for i, (_, c) in groups.items() if c == i)
            assert {r.text for r in kept[name] if r.doc_id is None} == {"alone here"}
        if name == "secret scans":
            assert len(kept[name]) == len(before)
            old = {r.doc_id: r for r in before}
            for r in kept[name]:
                assert not base_of(r.text)
                if not base_of(old[r.doc_id].text):
                    assert r.text == old[r.doc_id].text
                else:
                    assert "[SECRET]" in r.text
        if name == "mixing":
            assert set(kept[name]) <= set(before)
            copies = Counter(kept[name])
            assert max(copies.values()) <= 2
            total = sum(len(O.words_of(r.text)) for r in before)
            largest = max(len(O.words_of(r.text)) for r in before)
            assert abs(sum(len(O.words_of(r.text)) for r in kept[name]) - 1.5 * total) <= 2 * largest
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(T.vocabulary_path())
    tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in kept["mixing"])
    assert sum(r.length for r in kept["packing"]) == tokens
    assert Counter(r.doc_id for r in kept["packing"] if r.start == 0) == Counter(r.doc_id for r in kept["mixing"])


def test_one_of_a_group_without_ids_stays(spark):
    """Near copies without doc_id, and near copies under one doc_id, leave one row; wordless texts all stay."""
    words = [f"n{k}" for k in range(120)]
    near = [" ".join(words[:k] + ["changed"] + words[k + 1:]) for k in (20, 60, 100)]
    other = [" ".join(f"m{k}" for k in range(60)), " ".join(f"m{k}" for k in range(1, 60))]
    rows = [(None, t) for t in near] + [(None, near[0])] + [(7, t) for t in other] + [(None, other[0])] + [
        (None, ""), (None, " "), (8, ""), (8, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s0", 1) for i, t in rows], O.DOCS).repartition(3)
    got = Counter((r.doc_id, r.text) for r in P.drop_near_duplicates(spark, docs, "").collect())
    assert sum(n for (i, t), n in got.items() if t in near) == 1
    assert [(i, n) for (i, t), n in got.items() if t in other] == [(7, 1)]
    assert {k: n for k, n in got.items() if not k[1].strip()} == {(None, ""): 1, (None, " "): 1, (8, ""): 1, (8, " "): 1}


def test_run_is_its_stages(spark, tables):
    rows = P.run(spark, tables)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(rows.columns)
    assert rows.filter("start = 0").count() > 30


def test_empty_documents(spark, tmp_path):
    O.empty_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registry():
    names = list(entry.queries())
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "secret scans", "mixing", "packing"]


def test_word_count_is_the_stated_pattern(spark):
    rows = O.odd_documents(spark).select("text", mixing.word_count().alias("n"), F.lit(1)).collect()
    assert all(r.n == len(O.words_of(r.text)) for r in rows)
