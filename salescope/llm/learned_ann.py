"""Approximate nearest neighbours by learned partitions.

Fit (on at most ``SAMPLE`` distinct vectors, those with the smallest hashes):
the neighbour graph of the sample is cut into ``PARTS`` balanced parts by
label propagation under a size limit; a small network learns to tell a
vector's part; a second one learns how a vector's neighbours spread over the
parts so found. How much of that spread must be visited is set on sample
vectors held out of the second fit so that they find ``TARGET_RECALL`` of
their neighbours.

Index: the first network places every row. Search: the second routes a query
to its most probable parts until their probabilities reach the set share, and
the rows there are ranked by the exact inner product.

Parts are cut into blocks of about ``BLOCK_ROWS`` rows and their queries into
groups of about ``GROUP_QUERIES``, by hash, so no task grows with the data or
with a vector that many rows share.

Vectors of different dimensions are different spaces: the ``ROUTERS`` most
frequent dimensions (ties: the smaller) have an index each; vectors of a rarer
one are one part, whose blocks are all visited.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component, and rows without vec_id, take no part; a query's candidates have its
dimension; equal scores go to the smaller vec_id; a repeated vec_id asks once,
with its smallest vector (by dimension, then bytes), and none of its rows is a
candidate then; repeated candidates of other ids count each; fewer candidates
than ``k`` give them all; an empty table gives an empty result; extra columns do
not matter.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common as C
from . import vectors as V

K_NEAREST = 20
QUERY_STEP = 20
SAMPLE = 4096
PARTS = 16
GRAPH_DEGREE = 10
TARGET_RECALL = 0.97
BLOCK_ROWS = 8192
GROUP_QUERIES = 2048
ROUTERS = 4                    # dimensions with an index of their own
SEED = 3


def balanced_parts(neighbours: np.ndarray, parts: int, seed: int = SEED, rounds: int = 8, slack: float = 0.05):
    """Part of each node: label propagation over the neighbour graph, parts at most (1 + slack) n / parts."""
    n = len(neighbours)
    rng = np.random.default_rng(seed)
    most = int(np.ceil((1 + slack) * n / parts))
    part = rng.permutation(np.arange(n) % parts)
    size = np.bincount(part, minlength=parts)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(neighbours):
        for j in row:
            back[j].append(i)
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n):
            near = np.bincount(part[np.concatenate([neighbours[i], np.array(back[i], int)])], minlength=parts).astype(float)
            near[(size >= most) & (np.arange(parts) != part[i])] = -1
            best = int(near.argmax())
            if near[best] > near[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


class Network:
    """One hidden layer; trained on soft targets by Adam."""

    def __init__(self, dim: int, parts: int, hidden: int = 64, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.w1 = rng.normal(0, 1 / np.sqrt(dim), (dim, hidden))
        self.b1 = np.zeros(hidden)
        self.w2 = rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts))
        self.b2 = np.zeros(parts)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, target: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 5e-3,
              decay: float = 1e-4, seed: int = SEED) -> "Network":
        rng = np.random.default_rng(seed)
        params = [self.w1, self.b1, self.w2, self.b2]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                hidden = np.maximum(x[rows] @ self.w1 + self.b1, 0)
                z = hidden @ self.w2 + self.b2
                e = np.exp(z - z.max(axis=1, keepdims=True))
                error = (e / e.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
                below = (error @ self.w2.T) * (hidden > 0)
                step += 1
                for p, g, m, v in zip(params, (x[rows].T @ below, below.sum(0), hidden.T @ error, error.sum(0)),
                                      first, second):
                    g = g + decay * p
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        return self


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest inner products of each row with the others."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


class Router:
    """The fitted index: dimension, scale of the vectors, two networks and the share to visit."""

    def __init__(self, x: np.ndarray, parts: int = PARTS, k: int = K_NEAREST, target: float = TARGET_RECALL):
        self.dim = x.shape[1]
        self.scale = float(np.sqrt((x * x).sum(axis=1)).mean())
        self.parts = max(1, min(parts, len(x) // (4 * k)))
        self.place = self.spread = None
        self.share = 1.0
        if self.parts < 2:
            return
        z = x / self.scale
        part = balanced_parts(_nearest(x, GRAPH_DEGREE), self.parts)
        self.place = Network(self.dim, self.parts).train(z, np.eye(self.parts)[part])
        placed = self.place.probabilities(z).argmax(axis=1)
        near = placed[_nearest(x, k)]
        seen = np.stack([(near == p).mean(axis=1) for p in range(self.parts)], axis=1)
        held = np.arange(len(x)) % 4 == 0
        self.spread = Network(self.dim, self.parts, seed=SEED + 1).train(z[~held], seen[~held])
        p = self.spread.probabilities(z[held])
        order = np.argsort(-p, axis=1)
        mass = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        found = np.take_along_axis(seen[held], order, axis=1)
        for share in np.arange(0.3, 1.0001, 0.02):
            visited = np.concatenate([np.ones((len(p), 1), bool), mass[:, :-1] < share], axis=1)
            if (found * visited).sum(axis=1).mean() >= target:
                self.share = float(share)
                break

    def parts_of_rows(self, x: np.ndarray) -> np.ndarray:
        if self.place is None:
            return np.zeros(len(x), np.int64)
        return self.place.probabilities(x / self.scale).argmax(axis=1)

    def parts_of_queries(self, x: np.ndarray) -> list[np.ndarray]:
        if self.spread is None:
            return [np.zeros(1, np.int64)] * len(x)
        p = self.spread.probabilities(x / self.scale)
        order = np.argsort(-p, axis=1)
        mass = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        visited = np.concatenate([np.ones((len(p), 1), bool), mass[:, :-1] < self.share], axis=1)
        return [o[v] for o, v in zip(order, visited)]


def fit(rows: DataFrame, sample: int = SAMPLE, routers: int = ROUTERS) -> dict[int, Router]:
    """Fits on a bounded sample of checked rows (vec_id, dim, vec) for each of the most frequent dimensions."""
    out = {}
    for dims in rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(routers).collect():
        unit = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) / float(1 << 30)
        near = rows.filter((F.col("dim") == dims["dim"]) & (unit < min(1.0, 4.0 * sample / dims["n"])))
        got = (near.select("vec").distinct().withColumn("h", F.xxhash64("vec")).orderBy("h", "vec").limit(sample).collect())
        if got:
            out[dims["dim"]] = Router(np.stack([np.frombuffer(r["vec"], "<f8") for r in got]))
    return out


def _needed(vec: pa.Array, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among a query's k best: of equal vectors those with the k + 1 smallest ids."""
    code = vec.dictionary_encode().indices.to_numpy() if len(vec) else np.zeros(0, np.int64)
    order = np.lexsort((ids, code))
    first = np.searchsorted(code[order], code[order])
    return np.sort(order[np.arange(len(order)) - first <= k])


def nearest_in(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query number, row number, score): the k best rows of each query, its own left out, ties to the smaller id."""
    out = []
    for at in range(0, len(queries), 256):
        q = queries[at:at + 256]
        s = q @ rows.T
        s[query_ids[at:at + 256, None] == ids[None]] = -np.inf
        if s.shape[1] > k:
            least = -np.partition(-s, k - 1, axis=1)[:, k - 1:k]
            least = least - 1e-9 * np.maximum(1.0, np.abs(least))    # equal rows may differ in the last bits here
        else:
            least = np.full((len(q), 1), -np.inf)
        i, j = np.nonzero((s >= least) & (s > -np.inf))
        score = (q[i] * rows[j]).sum(axis=1)                         # the same sum for equal rows
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, np.arange(len(q)))
        keep = np.arange(len(i)) - first[i] < k
        out.append((i[keep] + at, j[keep], score[keep]))
    return [np.concatenate(c) for c in zip(*out)]


def search(vectors: DataFrame, queries, k: int = K_NEAREST, router: Router | None = None,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows where the condition ``queries`` holds."""
    spark = vectors.sparkSession
    C.prepare(spark)
    rows = C.store(V.checked(vectors.filter("vec_id IS NOT NULL")).filter("dim > 0"), "vectors")
    routers = {router.dim: router} if router else fit(rows)
    shared = spark.sparkContext.broadcast(routers)

    def by_dimension(batch):
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, shared.value.get(dim), batch.filter(pa.array(dims == dim))

    def place(batches):
        for batch in batches:
            for dim, known, b in by_dimension(batch):
                part = known.parts_of_rows(V.matrix(b.column("vec"), dim)) if known else np.zeros(len(b), np.int64)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("dim"), b.column("vec"),
                                                  pa.array(part.astype(np.int32))], names=["vec_id", "dim", "vec", "part"])

    def route(batches):
        for batch in batches:
            for dim, known, b in by_dimension(batch):
                parts = known.parts_of_queries(V.matrix(b.column("vec"), dim)) if known else [np.zeros(1, np.int64)] * len(b)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("dim"), b.column("vec"),
                                                  pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))],
                                                 names=["vec_id", "dim", "vec", "parts"])

    index = C.store(rows.select("vec_id", "dim", "vec").mapInArrow(place, "vec_id long, dim int, vec binary, part int"), "index")
    asked = (rows.filter(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "vec")).alias("v")).select("vec_id", "v.*")
             .mapInArrow(route, "vec_id long, dim int, vec binary, parts array<int>")
             .select("vec_id", "dim", "vec", F.explode("parts").alias("part")))
    asked = C.store(asked, "asked")
    at = ["dim", "part"]
    size = (index.groupBy(*at).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
            .join(asked.groupBy(*at).agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("groups")), at))
    size = C.store(size, "sizes")
    stored = (index.join(size, at)
              .withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("blocks")).cast("int"))
              .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))))
    wanted = (asked.join(size, at)
              .withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.col("groups")).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    keys = ["dim", "part", "block", "group"]

    def rank(q: pa.Table, r: pa.Table) -> pa.Table:
        if not len(q) or not len(r):
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())],
                                        names=["query_id", "vec_id", "score"])
        dim = q.column("dim")[0].as_py()
        r = r.take(pa.array(_needed(pa.concat_arrays(r.column("vec").chunks), r.column("vec_id").to_numpy(), k)))
        qid, rid = q.column("vec_id").to_numpy(), r.column("vec_id").to_numpy()
        i, j, score = nearest_in(V.matrix(q.column("vec"), dim), qid, V.matrix(r.column("vec"), dim), rid, k)
        return pa.Table.from_arrays([pa.array(qid[i]), pa.array(rid[j]), pa.array(score)],
                                    names=["query_id", "vec_id", "score"])

    found = (wanted.select(*keys, "vec_id", "vec").groupBy(*keys)
             .cogroup(stored.select(*keys, "vec_id", "vec").groupBy(*keys))
             .applyInArrow(rank, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_STEP == 0)
