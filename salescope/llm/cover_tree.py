"""Embedding near-duplicates by a dual traversal of cover trees.

Vectors of one label (and dimension) are scaled to length one; a cosine of at
least ``threshold`` is a distance of at most ``sqrt(2 - 2 threshold)``.

A cover tree has levels with halving radii: the root holds all vectors, and a
node's children are a net of its vectors of half the radius. Every node keeps
its true covering radius. Two trees (or one with itself) are walked together:
a pair of nodes whose centres are farther apart than the distance plus both
radii is left; a pair whose centres plus both radii lie within the distance
links all its vectors at once, without listing them; others are opened, down
to single vectors (or small nodes, compared at once), whose cosine decides.

Equal vectors of a label are one row with their number, before anything is
compared. Labels of more than ``BLOCK_ROWS`` such rows are cut into cells around
the top centres, cells into blocks, and only block pairs that pass the same
bound are compared, each in a task of its own. Links leave a task as counts per
vector and as a spanning forest, so a group of near copies of any size stays
small.

The result is exact. Defined cases: vectors that are null, empty, zero or hold
a null or non-finite component, and rows with a null label, link with nothing;
equal vectors link; vectors of another dimension do not; rows are told apart
by their place, not by vec_id; a null vec_id never names a component; an
empty table gives an empty result; extra columns do not matter.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common as C
from . import vectors as V
from .components import components

THRESHOLD = 0.93
BLOCK_ROWS = 4096
CENTRE_SAMPLE = 2048       # vectors per label from which top centres are chosen, at most
SLACK = 1e-6               # bounds are only trusted beyond rounding (of distances from products)
LEAF_PAIRS = 1 << 10       # two nodes (not the roots) with at most so many pairs of vectors are compared at once
FINE = 1e-3                # radii below this are told by differences, not products
CHUNK = 256


class Tree:
    """Nodes in arrays; node 0 is the root. ``order[lo:hi]`` are a node's vectors, its centre first."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        self.lo, self.hi, self.radius, self.kids = [0], [len(x)], [0.0], [None]
        self.radius[0] = float(self._distances(self.order).max())
        queue = [(0, 2.0)]
        while queue:
            node, radius = queue.pop()
            if self.hi[node] - self.lo[node] > 1 and self.radius[node] > 0:
                queue += self._open(node, radius)
        self.lo, self.hi, self.radius = np.array(self.lo), np.array(self.hi), np.array(self.radius)
        self.centre = self.order[self.lo]

    def _distances(self, rows: np.ndarray) -> np.ndarray:
        d = self.x[rows] - self.x[rows[0]]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _fine_net(self, rows: np.ndarray, radius: float) -> list[np.ndarray]:
        """As ``_net``, by differences: products cannot tell such small distances."""
        groups = []
        while len(rows):
            near = self._distances(rows) <= radius
            near[0] = True
            groups.append(rows[near])
            rows = rows[~near]
        return groups

    def _open(self, node: int, radius: float) -> list[tuple[int, float]]:
        """Children of a node: a net of its vectors with half the radius, or less if all lie nearer."""
        lo, hi = self.lo[node], self.hi[node]
        while radius / 2 >= self.radius[node]:
            radius /= 2
        radius /= 2
        rows = self.order[lo:hi]
        groups = _net(self.x[rows], rows, radius) if radius >= FINE else self._fine_net(rows, radius)
        radii = [float(self._distances(g).max()) if len(g) > 1 else 0.0 for g in groups]
        self.order[lo:hi] = np.concatenate(groups)
        first = len(self.lo)
        for g, r in zip(groups, radii):
            self.lo.append(lo)
            self.hi.append(lo + len(g))
            self.radius.append(r)
            self.kids.append(None)
            lo += len(g)
        self.kids[node] = np.arange(first, len(self.lo))
        return [(k, radius) for k in range(first, len(self.lo))]


def _net(x: np.ndarray, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """Groups of ``rows`` (unit vectors ``x``): each the free ones within the radius of its first, in order.

    The next few rows are compared with all that are left in one product; those
    not taken by an earlier one of them become centres.
    """
    left, groups, limit = np.arange(len(rows)), [], 1 - radius * radius / 2
    while len(left):
        block = x[left]
        near = block[:CHUNK] @ block.T >= limit
        free = np.ones(len(left), bool)
        for i in range(len(near)):
            if free[i]:
                free[i] = False
                others = np.flatnonzero(near[i] & free)
                free[others] = False
                groups.append(rows[left[np.concatenate(([i], others))]])
        left = left[free]
    return groups


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        p = self.parent
        while p[a] != a:
            p[a] = p[p[a]]
            a = p[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def dual_links(a: Tree, b: Tree | None, threshold: float, times_a: np.ndarray | None = None,
               times_b: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links per vector of a and of b, and pairs that connect all linked vectors (b's numbered after a's).

    ``b`` None compares a with itself, each pair of vectors once. A vector that
    stands for several (``times``) counts as so many links of the others.
    """
    same = b is None
    b = a if same else b
    times_a = np.ones(len(a.x), np.int64) if times_a is None else times_a
    times_b = times_a if same else np.ones(len(b.x), np.int64) if times_b is None else times_b
    all_a, all_b = (np.concatenate(([0], np.cumsum(times[t.order]))) for t, times in ((a, times_a), (b, times_b)))
    weight_a, weight_b = all_a[a.hi] - all_a[a.lo], all_b[b.hi] - all_b[b.lo]
    reach = math.sqrt(2 - 2 * threshold)
    shift = 0 if same else len(a.x)
    forest = _Forest(shift + len(b.x))
    whole_a, whole_b = np.zeros(len(a.lo), np.int64), np.zeros(len(b.lo), np.int64)
    own_a, own_b = np.zeros(len(a.x), np.int64), np.zeros(len(b.x), np.int64)

    size_a, size_b = a.hi - a.lo, b.hi - b.lo

    def compare(p: int, others: np.ndarray) -> None:
        """All vectors of a small node with those of others (with itself: each pair once)."""
        rows_p = a.order[a.lo[p]:a.hi[p]]
        rows_q = np.concatenate([b.order[lo:hi] for lo, hi in zip(b.lo[others].tolist(), b.hi[others].tolist())])
        dots = a.x[rows_p] @ b.x[rows_q].T
        i, j = np.nonzero(dots >= threshold - SLACK)
        if same and len(others) == 1 and p == others[0]:
            i, j = i[i < j], j[i < j]
        i, j = rows_p[i], rows_q[j]
        near = _cosines(a.x[i], b.x[j]) >= threshold
        i, j = i[near], j[near]
        np.add.at(own_a, i, times_b[j])
        np.add.at(own_b, j, times_a[i])
        for r, c in zip(i.tolist(), (j + shift).tolist()):
            forest.join(r, c)

    def all_linked(p: int, q: int) -> None:
        if a.hi[p] - a.lo[p] == 1 == b.hi[q] - b.lo[q]:
            whole_a[p] += weight_b[q]
            whole_b[q] += weight_a[p]
            forest.join(int(a.centre[p]), int(b.centre[q]) + shift)
            return
        rows_p, rows_q = a.order[a.lo[p]:a.hi[p]], b.order[b.lo[q]:b.hi[q]] + shift
        if same and p == q:
            whole_a[p] += weight_a[p]
            own_a[rows_p] -= times_a[rows_p]
        else:
            whole_a[p] += weight_b[q]
            whole_b[q] += weight_a[p]
        head_p, head_q = int(rows_p[0]), int(rows_q[0])
        for r in rows_p.tolist():
            forest.join(r, head_q)
        for r in rows_q.tolist():
            forest.join(r, head_p)

    stack = [(0, 0)]
    while stack:
        p, q = stack.pop()
        itself = same and p == q
        kp = a.kids[p] if a.kids[p] is not None else np.array([p])
        kq = b.kids[q] if b.kids[q] is not None else np.array([q])
        if itself and a.kids[p] is None:
            if a.hi[p] - a.lo[p] > 1:                       # equal vectors
                all_linked(p, p)
            continue
        if itself and 2 * a.radius[p] <= reach - SLACK:
            all_linked(p, p)
            continue
        if (p or q) and size_a[p] * size_b[q] <= LEAF_PAIRS:
            compare(p, np.array([q]))
            continue
        for at in range(0, len(kp), CHUNK):
            rows = kp[at:at + CHUNK]
            dots = a.x[a.centre[rows]] @ b.x[b.centre[kq]].T
            d = np.sqrt(np.maximum(2 - 2 * dots, 0))
            spread = a.radius[rows][:, None] + b.radius[kq][None]
            i, j = np.nonzero(d <= reach + spread + SLACK)
            if itself:
                ordered = kq[j] >= rows[i]
                i, j = i[ordered], j[ordered]
            inside = d[i, j] + spread[i, j] <= reach - SLACK
            m, n = rows[i], kq[j]
            ends = ~inside & (a.radius[m] == 0) & (b.radius[n] == 0)     # two vectors (or copies of them)
            if itself:
                ends &= m != n
                inside &= m != n
            at_ends = np.flatnonzero(ends)
            u, v = a.x[a.centre[m[at_ends]]], b.x[b.centre[n[at_ends]]]
            linked = at_ends[_cosines(u, v) >= threshold]
            for p_, q_ in zip(m[linked].tolist(), n[linked].tolist()):
                all_linked(p_, q_)
            for p_, q_ in zip(m[inside].tolist(), n[inside].tolist()):
                all_linked(p_, q_)
            open_ = np.flatnonzero(~ends & ~inside)
            for part in np.split(open_, np.flatnonzero(np.diff(m[open_])) + 1):
                if not len(part):
                    continue
                p_, others = int(m[part[0]]), n[part]
                small = size_a[p_] * size_b[others] <= LEAF_PAIRS
                if itself:
                    small &= others != p_
                if small.any():
                    compare(p_, others[small])
                stack += [(p_, int(q_)) for q_ in others[~small]]
    if same:
        whole_a += whole_b
        own_a += own_b
    edges = [(r, f) for r in range(len(forest.parent)) if (f := forest.find(r)) != r]
    return (_per_vector(a, whole_a) + own_a,
            np.zeros(0, np.int64) if same else _per_vector(b, whole_b) + own_b, edges)


def _cosines(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (u * v).sum(axis=1) / np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1))


def _per_vector(tree: Tree, whole: np.ndarray) -> np.ndarray:
    """Links of nodes handed down to their vectors."""
    steps = np.zeros(len(tree.x) + 1, np.int64)
    np.add.at(steps, tree.lo, whole)
    np.add.at(steps, tree.hi, -whole)
    out = np.empty(len(tree.x), np.int64)
    out[tree.order] = np.cumsum(steps[:-1])
    return out


def _top_centres(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Centres by farthest-first choice: each is the vector farthest from those before."""
    chosen, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < wanted and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _cells(spark, rows: DataFrame, block_rows: int) -> DataFrame:
    """key, unit vector, cell and block of every usable vector; cells only where a label needs blocks."""
    sizes = rows.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
    big = rows.join(sizes, ["label", "dim"])
    unit = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) / float(1 << 30)
    near = big.filter(unit * F.col("n") < 2.0 * CENTRE_SAMPLE).dropDuplicates(["label", "dim", "vec"])

    def centres(table: pa.Table) -> pa.Table:
        dim, n = table.column("dim")[0].as_py(), table.column("n")[0].as_py()
        x = V.matrix(table.column("vec"), dim)[:CENTRE_SAMPLE]
        top = _top_centres(x, math.ceil(n / block_rows))
        return pa.Table.from_pydict({"label": [table.column("label")[0].as_py()], "dim": [dim],
                                     "centres": [np.ascontiguousarray(top, "<f8").tobytes()]},
                                    schema=pa.schema([("label", pa.int64()), ("dim", pa.int32()),
                                                      ("centres", pa.binary())]))

    tops = near.orderBy("vec").groupBy("label", "dim").applyInArrow(centres, "label long, dim int, centres binary")
    tops = C.store(tops, "centres")

    def assign(batches):
        top = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            cuts = [*np.flatnonzero(kind == 0).tolist(), batch.num_rows]
            for lo, hi in zip([0, *cuts], cuts):
                if hi > lo and kind[lo] == 0:              # the centres of the rows after it
                    dim = batch.column("dim")[lo].as_py()
                    top = np.frombuffer(batch.column("vec")[lo].as_py(), "<f8").reshape(-1, dim)
                    lo += 1
                if hi > lo:
                    part = batch.slice(lo, hi - lo)
                    x = V.matrix(part.column("vec"), top.shape[1])
                    d = np.sqrt(np.maximum(2 - 2 * (x @ top.T), 0))
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in ("key", "label", "dim", "vec", "times")],
                         pa.array(d.argmin(axis=1).astype(np.int64)), pa.array(d.min(axis=1))],
                        names=["key", "label", "dim", "vec", "times", "cell", "distance"])

    # the centres go once to each task that has rows of the label, ahead of them
    salts = F.ceil(F.col("n") / block_rows).cast("int")
    mine = big.select("key", "label", "dim", "vec", "times", F.pmod(F.xxhash64("key", F.lit(3)), salts).cast("int").alias("salt"),
                      F.lit(1).alias("kind"))
    ahead = tops.join(sizes, ["label", "dim"]).select(
        "label", "dim", F.col("centres").alias("vec"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        F.lit(0).alias("kind"))
    both = mine.unionByName(ahead, allowMissingColumns=True)
    placed = both.repartition(C.parallelism(spark), "label", "dim", "salt").sortWithinPartitions(
        "label", "dim", "salt", "kind").mapInArrow(
        assign, "key long, label long, dim int, vec binary, times long, cell long, distance double")
    small = rows.join(sizes, ["label", "dim"], "left_anti").select(
        "key", "label", "dim", "vec", "times", F.lit(0).cast("long").alias("cell"), F.lit(0.0).alias("distance"))
    placed = C.store(placed.unionByName(small), "cells")
    count = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
    return placed.join(count, ["label", "dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")))


def links(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS):
    """(rows, counts, edges): key, vec_id and node of every row (the least key of its equal vectors) with their
    number, links per node beyond them, and connecting pairs of nodes."""
    spark = vectors.sparkSession
    C.prepare(spark)
    rows = V.checked(vectors, keep=("vec_id", "label")).select(
        F.monotonically_increasing_id().alias("key"), "vec_id", F.col("label").cast("long").alias("label"), "dim", "vec")
    rows = C.store(rows, "vectors")

    def scaled(batches):
        for batch in batches:
            vec = [(x / np.sqrt(x @ x)).tobytes() for x in
                   (_unscaled(np.frombuffer(v, "<f8")) for v in batch.column("vec").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), batch.column("dim"), pa.array(vec, pa.binary())],
                names=["key", "label", "dim", "vec"])

    usable = rows.filter("dim > 0 AND label IS NOT NULL").select("key", "label", "dim", "vec")
    usable = C.store(usable.mapInArrow(scaled, "key long, label long, dim int, vec binary"), "units")
    same = ["label", "dim", "vec"]
    classes = C.store(usable.groupBy(*same).agg(F.min("key").alias("node"), F.count("*").alias("times")), "classes")
    of_row = usable.join(classes, same).select("key", "node", "times")
    rows = C.store(rows.select("key", "vec_id").join(of_row, "key", "left").select(
        "key", "vec_id", F.coalesce("node", "key").alias("node"), F.coalesce("times", F.lit(1)).alias("times")), "rows")
    usable = classes.select(F.col("node").alias("key"), *same, "times")
    members = C.store(_cells(spark, usable, block_rows), "blocks")
    names = ["label", "dim", "cell", "block"]
    blocks = members.groupBy(*names).agg(F.max("distance").alias("radius"), F.min_by("vec", "key").alias("one"))
    left = blocks.select("label", "dim", *[F.col(c).alias(f"{c}_a") for c in ("cell", "block", "radius", "one")])
    right = blocks.select("label", "dim", *[F.col(c).alias(f"{c}_b") for c in ("cell", "block", "radius", "one")])
    pairs = left.join(right, ["label", "dim"]).filter(
        F.struct("cell_a", "block_a") <= F.struct("cell_b", "block_b"))
    pairs = _near_blocks(pairs, threshold).withColumn("pair", F.monotonically_increasing_id())
    pairs = C.store(pairs, "pairs")
    side_a = pairs.select("pair", "label", "dim", F.col("cell_a").alias("cell"), F.col("block_a").alias("block"),
                          F.lit(0).alias("side"))
    side_b = pairs.filter("cell_a <> cell_b OR block_a <> block_b").select(
        "pair", "label", "dim", F.col("cell_b").alias("cell"), F.col("block_b").alias("block"), F.lit(1).alias("side"))
    work = members.select(*names, "key", "vec", "times").join(side_a.unionByName(side_b), names)

    def compare(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        table = table.sort_by([("side", "ascending"), ("key", "ascending")])
        side, key = table.column("side").to_numpy(), table.column("key").to_numpy()
        x, n = V.matrix(table.column("vec"), dim), int((side == 0).sum())
        a = Tree(x[:n])
        b = Tree(x[n:]) if n < len(x) else None
        times = table.column("times").to_numpy()
        ca, cb, edges = dual_links(a, b, threshold, times[:n], times[n:])
        counts = np.concatenate([ca, cb])
        some = np.flatnonzero(counts)
        e = np.array(edges, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([key[some], key[e[:, 0]]])),
             pa.array(np.concatenate([counts[some], np.zeros(len(e), np.int64)])),
             pa.array([None] * len(some) + key[e[:, 1]].tolist(), pa.int64())], names=["key", "links", "other"])

    found = C.store(work.groupBy("pair").applyInArrow(compare, "key long, links long, other long"), "links")
    counts = found.filter("other IS NULL").groupBy("key").agg(F.sum("links").alias("n_links"))
    edges = found.filter("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b"))
    return rows, counts, edges


def _unscaled(x: np.ndarray) -> np.ndarray:
    """The vector divided by its largest component, so squares neither overflow nor vanish."""
    return x / np.abs(x).max()


def _near_blocks(pairs: DataFrame, threshold: float) -> DataFrame:
    """Block pairs that can hold a link: within a cell always, else by the cells' centres and radii.

    Cells of one label keep their centre only through their members, so the
    bound uses one member of each block: it lies within the radius.
    """
    reach = math.sqrt(2 - 2 * threshold)

    def near(batches):
        for batch in batches:
            a, b = batch.column("one_a").to_pylist(), batch.column("one_b").to_pylist()
            d = np.array([np.linalg.norm(np.frombuffer(u, "<f8") - np.frombuffer(v, "<f8")) for u, v in zip(a, b)])
            ra, rb = batch.column("radius_a").to_numpy(), batch.column("radius_b").to_numpy()
            same = (batch.column("cell_a").to_numpy() == batch.column("cell_b").to_numpy())
            yield batch.filter(pa.array(same | (d <= reach + 2 * (ra + rb) + SLACK)))

    return pairs.mapInArrow(near, pairs.schema).drop("one_a", "one_b", "radius_a", "radius_b")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows, counts, edges = links(vectors, threshold, block_rows)
    parts = components(edges).select("node", F.col("component").alias("part"))
    named = rows.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    least = named.groupBy("part").agg(F.min("vec_id").alias("component_id"))
    found = F.coalesce("n_links", F.lit(0).cast("long")) + F.col("times") - 1
    return (named.join(least, "part").join(counts.withColumnRenamed("key", "node"), "node", "left")
            .select("vec_id", found.cast("long").alias("n_links"), "component_id",
                    F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
