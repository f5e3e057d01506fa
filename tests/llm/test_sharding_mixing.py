from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import odd_tables as O
import pytest
from pyspark.sql import functions as F

from salescope.llm import mixing, sharding


def test_shards_are_a_shuffle_with_even_counts(spark):
    docs = O.odd_documents(spark)
    rows = sharding.shard(docs, n_shards=3, bucket_bytes=20_000).collect()
    assert Counter(r.record for r in rows) == Counter(r for r in docs.collect())
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    again = sharding.shard(docs.repartition(2), n_shards=3, bucket_bytes=20_000).collect()
    assert sorted((r.record.doc_id or -1, r.position) for r in rows if r.record.doc_id != 50) == \
        sorted((r.record.doc_id or -1, r.position) for r in again if r.record.doc_id != 50)


def test_repeated_rows_spread_over_buckets(spark):
    rows = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    out = sharding.shard(rows, n_shards=4, bucket_bytes=4000)
    assert out.select("bucket").distinct().count() > 4
    assert out.count() == 3000


def test_empty_table_has_no_shards(spark):
    assert sharding.shard(O.empty_documents(spark)).count() == 0


def test_shard_query_sizes_and_checksums(spark):
    rows = sharding.query(spark, "/root/testdata/sf0.001").collect()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 1 for r in rows)
    assert all(r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in rows)


def _targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Shared again by weight until no target is above twice its source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            out |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_mix_hits_targets(spark):
    docs = O.odd_documents(spark)
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"))
    rows = mixing.mix(sized).collect()
    assert len(rows) == docs.count()
    sizes: Counter = Counter()
    for r in docs.collect():
        sizes[r.source] += len(O.words_of(r.text))
    want = _targets(dict(sizes))
    largest = Counter()
    taken: Counter = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(sized.repartition(5)).collect()))


def test_mixed_documents_are_whole_rows(spark):
    docs = O.odd_documents(spark)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"))
    drawn = mixing.mix(sized).agg(F.sum("copies")).first()[0]
    assert out.count() == drawn
    assert set(out.collect()) <= set(docs.collect())


def test_mix_of_nothing(spark):
    empty = O.empty_documents(spark)
    assert mixing.mix_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, " ", None, "b", 1)], O.DOCS)
    rows = mixing.mix(blank.select("doc_id", "source", mixing.word_count().alias("size"))).collect()
    assert [r.target for r in rows] == [0.0, 0.0] and [r.size for r in rows] == [0, 0]


def test_mixing_sql_on_odd_rows(spark, tmp_path):
    docs = O.odd_documents(spark, extra=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = mixing.query(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(mixing.SQL).fetchall()))


def test_many_equal_rows_are_written_out_in_parts(spark, monkeypatch):
    from salescope.llm import mixing
    monkeypatch.setattr(mixing, "COPIES_A_TASK", 7)
    rows = [(1, "a b c", "en", "s0", 5)] * 40 + [(k, f"w{k} x", "en", "s1", 3) for k in range(2, 30)]
    docs = spark.createDataFrame(rows, O.DOCS)
    mixed = mixing.mix_documents(docs)
    copies = mixing.mix(docs.select("doc_id", "source", mixing.word_count().alias("size"))).groupBy("doc_id").sum("copies")
    want = {r[0]: r[1] for r in copies.collect() if r[1]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want and want[1] > 14
