"""Operators on pairs against brute force."""
from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import odd_tables as O
import pytest

from salescope.llm import components as CC, cover_tree, jaccard_join as J, learned_ann as L
from pyspark.sql import functions as F

VEC = "vec_id long, embedding array<float>, label int"


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    rows = CC.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 300: 200}
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
    assert CC.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = O.words_of(text, lower=True)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    groups = O.Groups()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.join(i, j)
    return {i: (len(a), groups.find(i)) for i, a in sets}


def near_copies(rng, texts, copies, changes):
    rows, k = [], 0
    for t in range(texts):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([3, 5, 9, 40, 120]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(changes)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
            rows.append((k, " ".join(w)))
            k += 1
    rng.shuffle(rows)
    return rows


def test_jaccard_join_against_all_pairs(spark):
    rows = near_copies(random.Random(2), 30, 8, 5)
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows)


@pytest.mark.parametrize("width", [2, 200, 60_000])
def test_packed_shingles_keep_64_bits(width):
    """Hashes equal in their low 48 bits stay different, in a narrow and in a wide range."""
    rng = np.random.default_rng(4)
    low = rng.integers(0, 1 << 48, 50, dtype=np.uint64)
    h = np.sort(np.concatenate([low | (np.uint64(t) << np.uint64(48)) for t in (5000, 5001, 5000 + width)]))
    got = J._unpack(*J._pack(h))
    assert got.dtype == np.uint64 and (got == h).all()


def test_split_clusters_lose_no_link(spark, monkeypatch):
    rng = random.Random(3)
    rows = near_copies(rng, 3, 60, 14)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    summary = J.summaries(docs)
    linked = J.class_components(docs, summary, block_shingles=400)
    name = {r["class"]: r.doc_id for r in summary.groupBy("class").agg(F.min("doc_id").alias("doc_id")).collect()}
    groups = O.Groups()
    for r in linked.collect():
        groups.join(name[r.node], name[r.component])
    found = {d: groups.find(name[c]) for c, d in ((r["class"], r.doc_id) for r in summary.collect())}
    want = {i: c for i, (n, c) in brute_groups(rows).items()}
    assert found == want


def test_trie_against_all_pairs():
    rng = np.random.default_rng(6)
    for _ in range(60):
        base = [np.unique(rng.integers(0, 60, rng.integers(1, 30))) for _ in range(6)]
        sets = [np.setdiff1d(b, rng.choice(60, rng.integers(0, 5))) for b in base for _ in range(5)]
        sets = [s for s in sets if len(s)]
        sizes = [len(s) + int(rng.integers(0, 2)) for s in sets]
        trie, groups = J.Trie(sets, sizes, 60), O.Groups()
        for x in range(len(sets)):
            trie.match(x)
            trie.add(x)
            for y in range(x):
                shared = len(np.intersect1d(sets[x], sets[y]))
                if 180 * shared >= 80 * (sizes[x] + sizes[y]):
                    groups.join(x, y)
        assert [trie.find(x) for x in range(len(sets))] == [groups.find(x) for x in range(len(sets))]


def test_jaccard_join_of_odd_documents(spark):
    docs = O.odd_documents(spark)
    got = J.join(docs).collect()
    assert len(got) == docs.count()
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    want = brute_groups(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    nulls = sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None and r.component_id is not None)
    assert nulls == [(want[0][0], 0)]
    assert J.join(O.empty_documents(spark)).count() == 0


def vector_rows(seed=1):
    x = O.unit_rows(300, 16, seed)
    rng = np.random.default_rng(seed)
    for k in range(100, 180):                               # a group of near copies, some nearer than others
        x[k] = x[100] + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.09])
    scale = rng.uniform(0.1, 30, 300)
    rows = [(k, (x[k] * scale[k]).astype(np.float32).tolist(), int(k % 3 == 0)) for k in range(300)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] + [1.0] * 15, 0), (403, [None] + [1.0] * 15, 0),
             (404, [float("inf")] + [1.0] * 15, 1), (405, [1.0, 2.0], 0), (406, [2.0, 4.0], 0), (407, [], 1),
             (408, rows[5][1], None), (409, rows[6][1], rows[6][2])]
    return rows


def usable(e):
    return e and all(v is not None and np.isfinite(v) for v in e) and any(v != 0 for v in e)


def brute_links(rows, threshold=0.93):
    groups, links = O.Groups(), {r[0]: 0 for r in rows}
    for x, (i, a, la) in enumerate(rows):
        for j, b, lb in rows[:x]:
            if la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                u, v = np.array(a, float), np.array(b, float)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold:
                    groups.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return {i: (links[i], groups.find(i), groups.find(i) == i) for i in links}


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_cover_tree_against_all_pairs(spark, block_rows):
    rows = vector_rows()
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, VEC).repartition(3).withColumn("key", F.lit(1)),
                                     block_rows=block_rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_links(rows)


def test_cover_tree_of_nothing_and_of_copies(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], VEC)).count() == 0
    copies = [(k, [1.0, 2.0, 3.0], 4) for k in range(500)] + [(None, [1.0, 2.0, 3.0], 4)]
    got = cover_tree.near_duplicates(spark.createDataFrame(copies, VEC), block_rows=100).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(500, 0)}
    assert [r.vec_id for r in got if r.kept] == [0]


def test_cover_tree_levels_cover():
    x = O.unit_rows(400, 8, 3)
    tree = cover_tree.Tree(x)
    for node in range(len(tree.lo)):
        rows = tree.order[tree.lo[node]:tree.hi[node]]
        assert np.linalg.norm(x[rows] - x[tree.centre[node]], axis=1).max() <= tree.radius[node] + 1e-12
        if tree.kids[node] is not None:
            kids = tree.kids[node]
            assert sorted(np.concatenate([tree.order[tree.lo[k]:tree.hi[k]] for k in kids])) == sorted(rows)


def test_cover_tree_sql_on_odd_vectors(spark, tmp_path):
    rows = [r for r in vector_rows() if r[0] not in (403, 405, 406)]
    spark.createDataFrame(rows, VEC).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(cover_tree.SQL).fetchall())
    assert sorted(map(tuple, cover_tree.query(spark, str(tmp_path)).collect())) == want


def brute_nearest(rows, queries, k):
    ok = [(i, np.array(e, float)) for i, e, _ in rows if i is not None and usable(e) and len(e) == 16]
    out = {}
    for q, v in {i: v for i, v in ok if i in queries}.items():
        order = sorted(((-(v * w).sum(), i) for i, w in ok if i != q))
        out[q] = [(i, -s) for s, i in order[:k]]
    return out


def test_nearest_with_every_part_visited_is_exact(spark):
    rows = vector_rows() + [(None, [1.0] * 16, 0)]
    got = L.search(spark.createDataFrame(rows, VEC).withColumn("part", F.lit(1)), F.col("vec_id") % 20 == 0, k=7,
                   block_rows=64, router=_everywhere(rows)).collect()
    want = brute_nearest(rows, {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0}, 7)
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found.keys() == want.keys()
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def _everywhere(rows):
    router = L.Router(np.array([e for _, e, _ in rows if usable(e) and len(e) == 16], float), parts=4, k=7)
    router.share = 2.0
    return router


def test_recall_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, 0) for r in table.collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got: dict = {}
    for r in L.query(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    queries = [k for k, i in enumerate(ids) if i % 20 == 0]
    for k in queries:
        s = x @ x[k]
        s[k] = -np.inf
        hits += len(got[int(ids[k])] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert hits / (20 * len(queries)) >= 0.9


def test_few_or_no_candidates(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (20, [0.0, 1.0], 1)], VEC)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in L.search(few, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert L.search(spark.createDataFrame([], VEC), F.col("vec_id") % 20 == 0).count() == 0


def numpy_links(x, threshold=0.93):
    """Links per row and least row reachable, from all cosines."""
    x = np.asarray(x, np.float32).astype(float)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    part = np.arange(len(x))
    while True:
        new = np.minimum(part, np.where(near, part[None, :], len(x)).min(axis=1))
        if (new == part).all():
            return near.sum(axis=1), part
        part = new


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = O.unit_rows(n // 40, dim, seed)
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * rng.choice([0.0, 0.02, 0.06, 0.1], n)[:, None]
    return x.astype(np.float32)


@pytest.mark.parametrize("block_rows", [4096, 300])
def test_cover_tree_on_a_large_label(spark, block_rows):
    """2,000 vectors of one label: walked down both trees, not compared at their roots."""
    x = clustered(2000, 16, 8)
    n, part = numpy_links(x)
    rows = [(k, v.tolist(), 7) for k, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           cover_tree.near_duplicates(spark.createDataFrame(rows, VEC), block_rows=block_rows).collect()}
    assert got == {k: (int(n[k]), int(part[k])) for k in range(len(x))} and n.max() > 20


def test_cover_tree_counts_copies_without_comparing_them(spark):
    """20,000 copies of one vector beside near ones: equal vectors are one row of the trees."""
    x = clustered(400, 8, 9)
    n, part = numpy_links(x)
    near = numpy_links(np.vstack([x, x[:1]]))[0]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(1000 + k, x[0].tolist(), 1) for k in range(20_000)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           cover_tree.near_duplicates(spark.createDataFrame(rows, VEC).repartition(8)).collect()}
    assert all(got[1000 + k] == (int(n[0]) + 20_000, int(part[0])) for k in (0, 19_999))
    assert all(got[k] == (int(n[k]) + 20_000 * int(near[k] - n[k]), int(part[k])) for k in range(len(x)))


def test_dual_walk_compares_few_pairs():
    """The walk agrees with all products also with numbers of copies, and roots are always opened."""
    x = clustered(3000, 12, 10).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    times = np.random.default_rng(1).integers(1, 5, len(x))
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    a = cover_tree.Tree(x)
    counts, _, _ = cover_tree.dual_links(a, None, 0.93, times)
    assert (counts == near @ times).all()
    b = cover_tree.Tree(x[:900])
    ca, cb, _ = cover_tree.dual_links(cover_tree.Tree(x[900:]), b, 0.93, times[900:], times[:900])
    assert (ca == near[900:, :900] @ times[:900]).all() and (cb == near[:900, 900:] @ times[900:]).all()
    small = cover_tree.Tree(x[:20])
    assert small.kids[0] is not None and (cover_tree.dual_links(small, None, 0.93)[0] == near[:20, :20].sum(axis=1)).all()


def nearest_by_id(rows, k, step=20):
    """query_id -> [(vec_id, score)]: the smallest vector of an id asks all rows of other ids of its dimension."""
    good = [(i, np.array(np.asarray(e, np.float32), float)) for i, e, _ in rows if i is not None and usable(e)]
    asks = {}
    for i, e in good:
        if i % step == 0:
            asks[i] = min([asks[i], e] if i in asks else [e], key=lambda v: (len(v), v.astype("<f8").tobytes()))
    return {q: sorted([(-float(e @ v), i) for i, v in good if i != q and len(v) == len(e)])[:k] for q, e in asks.items()}


def test_ann_over_dimensions_and_repeated_ids(spark):
    """Every dimension is searched; an id with several vectors asks once; equal vectors are cut by id."""
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=16).astype(np.float32).tolist(), 0) for k in range(60)]
    rows += [(100 + k, rng.normal(size=8).astype(np.float32).tolist(), 0) for k in range(41)]
    rows += [(200 + k, [float(k), 1.0], 0) for k in range(3)] + [(300, [1.0] * 5, 0)]
    rows += [(20, rows[3][1], 0), (20, rows[20][1], 0), (7, rows[7][1], 0)]
    rows += [(1000 + k, rows[5][1], 0) for k in range(50)]
    got = {}
    for r in L.search(spark.createDataFrame(rows, VEC).repartition(4), F.col("vec_id") % 20 == 0, k=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {q: v for q, v in nearest_by_id(rows, 6).items() if v}
    assert got.keys() == want.keys() and 300 not in got and {100, 120, 140, 200} <= got.keys()
    for q, rows_ in got.items():
        assert [(rank, i) for rank, i, _ in sorted(rows_)] == [(n + 1, i) for n, (_, i) in enumerate(want[q])]
        assert np.allclose([s for _, _, s in sorted(rows_)], [-s for s, _ in want[q]], atol=1e-9)


def test_a_block_of_equal_vectors_needs_little_memory():
    """8,192 equal vectors and 256 queries: only as many of them are ranked as a query can return."""
    import tracemalloc
    x = np.ones((8192, 64))
    keep = L._needed(pa.array([v.tobytes() for v in x], pa.binary()), np.arange(8192)[::-1], 20)
    assert sorted((8191 - keep).tolist()) == list(range(21))
    queries = np.random.default_rng(0).normal(size=(256, 64))
    tracemalloc.start()
    i, j, _ = L.nearest_in(queries, np.arange(256) + 8000, x[keep], np.arange(8192)[::-1][keep], 20)
    assert len(i) == 256 * 20 and tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()
