"""N-gram Jaccard join with a prefix tree of globally ordered sets.

A document's set is its distinct five-word shingles (64-bit hashes of the
whole words). Documents with equal sets form one class; only classes go on.

1. Document frequencies: each task cuts its distinct shingles into hash
   ranges, every range is counted on its own (a shingle costs one entry per
   task batch, however often it occurs), and the shingles that occur twice or
   more are kept with their counts, which go back to the sets range by range.
   First this is done for the shingles in the lowest ``REGION`` of the hash
   space only: a class of n shingles with a partner misses at most
   ``n - ceil(0.8 n)`` of them, so one that misses more there is done with.
2. For the classes that are left it is done with all shingles. A shingle that
   occurs once cannot be shared, so a class keeps only its repeated shingles;
   it can have a partner only if they are at least 80 % of its set.
3. Shingles are globally ordered, rare first. Two sets of Jaccard 0.8 share a
   shingle among the first ``n - ceil(0.8 n) + 1`` of each, so classes that
   share such a prefix shingle are gathered into clusters (connected
   components), and all links lie inside clusters.
4. A cluster's sets, in the global order read from its frequent end, are
   stored in a path-compressed trie. A set is matched by walking the trie:
   the overlap with a path is counted once for all sets below it, a subtree
   is left as soon as the overlap so far plus what can still come (the
   smaller of the set's and the subtree's remaining length) is too little for
   its smallest set, or when all its sets are already connected with this one.
5. A cluster of more than ``BLOCK_SHINGLES`` shingles is split into blocks
   that share a few leaders; what then is not connected with the cluster's
   largest part is matched against every block. No pair is left out.

The result is exact up to collisions of 64-bit hashes. Defined cases: null,
empty or blank text has an empty set, size 0, and is linked with nothing; with
fewer than five words the whole sequence is the one shingle; equal rows fall
in one class; a null doc_id is in its class but never names a component
(null only where a whole component has none); an empty table gives an empty
result; extra columns do not matter.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, Window, functions as F

from . import common as C
from . import textkit as K
from .components import components

SHINGLE = 5
PERCENT = 80
RANGE_SHINGLES = 4_000_000     # entries counted in one task at a time
REGION = 0.4                   # share of the hash space that decides which classes go on
FLUSH_SHINGLES = 1 << 20       # entries a task gathers before it sends them on
BATCH_ROWS = 16                # rows of a range's shingles (and texts) that a task holds at a time
BLOCK_SHINGLES = 1_000_000     # shingles of one trie
LEADERS = 8


def class_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key per set, equal for equal sets; 0 for the empty set."""
    sums = np.array([np.add.reduce(K.mix(s), dtype=np.uint64) for s in sets], np.uint64)
    sizes = np.array([len(s) for s in sets], np.uint64)
    return np.where(sizes > 0, K.mix(sums + sizes) | np.uint64(1), np.uint64(0)).view(np.int64)


def _blocks_of_sets(batches, n: int):
    for batch in batches:
        buf, off = K.utf8(batch.column("text"))
        for i, j in K.blocks(off):
            words = K.Words(buf[off[i]:off[j]], off[i:j + 1], lower=True)
            yield batch.slice(i, j - i), K.shingle_sets(words, n)


def _region_end(region: float) -> np.uint64:
    return np.uint64(min(int(region * 2.0 ** 24), 2 ** 24 - 1) << 40 | ((1 << 40) - 1))


def _within(sets: list[np.ndarray], region: float) -> list[np.ndarray]:
    """The part of each ascending set that lies in the lowest share of the hash space."""
    if region >= 1:
        return sets
    end = _region_end(region)
    return [s[:np.searchsorted(s, end, "right")] for s in sets]


def summaries(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, hash of the text, n_shingles, class key and shingles in the region for every document."""
    def rows(batches):
        for part, sets in _blocks_of_sets(batches, n):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(class_keys(sets)), pa.array([len(s) for s in _within(sets, REGION)], pa.int64())],
                names=["doc_id", "text_hash", "n_shingles", "class", "low"])
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        rows, "doc_id long, text_hash long, n_shingles long, class long, low long")


def _range_of(h: np.ndarray, ranges: int, region: float) -> np.ndarray:
    top = (h >> np.uint64(40)).astype(np.int64)
    return top * ranges // ((int(_region_end(region)) >> 40) + 1)


def _pack(h: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """All 64 bits in three planes; of the upper 16 the least value, then what is beyond it, in a byte where that
    is enough (hashes of one range)."""
    top = (h >> np.uint64(48)).astype("<u2")
    least = top.min()
    beyond = top - least
    beyond = beyond.astype("u1") if beyond.max() < 1 << 8 else beyond
    return h.astype("<u4").tobytes(), (h >> np.uint64(32)).astype("<u2").tobytes(), least.tobytes() + beyond.tobytes()


def _unpack(low: bytes, high: bytes, top: bytes) -> np.ndarray:
    beyond = np.frombuffer(top, "u1" if len(top) - 2 == len(low) // 4 else "<u2", offset=2).astype(np.uint64)
    beyond += np.uint64(np.frombuffer(top, "<u2", count=1)[0])
    beyond <<= np.uint64(16)
    beyond |= np.frombuffer(high, "<u2")
    beyond <<= np.uint64(32)
    beyond |= np.frombuffer(low, "<u4")
    return beyond


def repeated_shingles(docs: DataFrame, ranges: int, n: int = SHINGLE, region: float = 1.0) -> DataFrame:
    """One row per hash range: the shingles that occur in two documents or more, and in how many."""
    def send(batches):
        held, size = [], 0

        def flush():
            h, counts = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(_range_of(h, ranges, region), np.arange(ranges + 1))
            rows = {"range": [], "low": [], "high": [], "top": [], "often": [], "times": []}
            for r in np.flatnonzero(np.diff(cut)):
                part, c = h[cut[r]:cut[r + 1]], counts[cut[r]:cut[r + 1]]
                low, high, top = _pack(part)
                often = np.flatnonzero(c > 1)
                for name, v in zip(rows, (int(r), low, high, top, often.astype("<u4").tobytes(),
                                          c[often].astype("<u4").tobytes())):
                    rows[name].append(v)
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("range", pa.int64()), *[(c, pa.binary()) for c in ("low", "high", "top", "often", "times")]]))

        for _, sets in _blocks_of_sets(batches, n):
            held += _within(sets, region)
            size += sum(map(len, held[-len(sets):]))
            if size >= FLUSH_SHINGLES:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        size = pa.compute.sum(pa.compute.binary_length(table.column("low"))).as_py() // 4
        ids, times, at = np.empty(size, np.uint64), np.ones(size, np.uint32), 0
        for batch in table.to_batches():
            for row in _rows(batch):
                one = _unpack(row["low"], row["high"], row["top"])
                ids[at:at + len(one)] = one
                times[at + np.frombuffer(row["often"], "<u4").astype(np.int64)] = np.frombuffer(row["times"], "<u4")
                at += len(one)
        order = np.argsort(ids, kind="stable")
        ids, times = ids[order], times[order]
        del order
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        total = np.add.reduceat(times, first, dtype=np.int64)
        keep = total >= 2
        return pa.Table.from_pydict({"range": [table.column("range")[0].as_py()],
                                     "shingles": [ids[first][keep].tobytes()],
                                     "counts": [np.minimum(total[keep], 2**32 - 1).astype("<u4").tobytes()]},
                                    schema=pa.schema([("range", pa.int64()), ("shingles", pa.binary()),
                                                      ("counts", pa.binary())]))

    sent = docs.select("text").mapInArrow(send, "range long, low binary, high binary, top binary, often binary, times binary")
    return sent.groupBy("range").applyInArrow(count, "range long, shingles binary, counts binary")


def _sent_sets(docs: DataFrame, ranges: int, n: int, region: float) -> DataFrame:
    """The shingles of each class, cut into hash ranges, with the classes they belong to."""
    def send(batches):
        held, keys, sizes, size = [], [], [], 0

        def flush():
            h = np.concatenate(held)
            owner = np.repeat(np.arange(len(held), dtype=np.int64), [len(s) for s in held])
            r = _range_of(h, ranges, region)
            order = np.argsort(r, kind="stable")
            cut = np.searchsorted(r[order], np.arange(ranges + 1))
            rows = {"range": [], "low": [], "high": [], "top": [], "owner": [], "classes": [], "sizes": []}
            key, whole = np.concatenate(keys), np.array(sizes, "<u4")
            for k in np.flatnonzero(np.diff(cut)):
                at = order[cut[k]:cut[k + 1]]
                low, high, top = _pack(h[at])
                inside, place = np.unique(owner[at], return_inverse=True)
                values = (int(k), low, high, top, place.astype("<u2" if len(inside) < 1 << 16 else "<u4").tobytes(),
                          key[inside].tobytes(), whole[inside].tobytes())
                for name, v in zip(rows, values):
                    rows[name].append(v)
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("range", pa.int64()), *[(c, pa.binary()) for c in ("low", "high", "top", "owner", "classes", "sizes")]]))

        for _, sets in _blocks_of_sets(batches, n):
            key = class_keys(sets)
            first = np.unique(key, return_index=True)[1]
            first = first[key[first] != 0]                  # equal sets of a block once
            held += _within([sets[k] for k in first], region)
            sizes += [len(sets[k]) for k in first]
            keys.append(key[first])
            size += sum(map(len, held[len(held) - len(first):]))
            if size >= FLUSH_SHINGLES:
                yield flush()
                held, keys, sizes, size = [], [], [], 0
        if size:
            yield flush()

    return docs.select("text").mapInArrow(
        send, "range long, low binary, high binary, top binary, owner binary, classes binary, sizes binary")


def _rows(batch: pa.RecordBatch):
    """The batch's rows as dictionaries, one at a time and without a copy: a row holds megabytes."""
    binary = [pa.types.is_binary(c.type) for c in batch.columns]
    for k in range(batch.num_rows):
        yield {name: batch.column(c)[k].as_buffer() if binary[c] else batch.column(c)[k].as_py()
               for c, name in enumerate(batch.schema.names)}


def _beside(sent: DataFrame, frequent: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every sent row together with its range's dictionary of repeated shingles.

    Both go to the range's task, the dictionary first, so a task holds one
    dictionary and a few sent rows, and no row carries a copy of it.
    """
    def rows(batches):
        at = known = counts = None
        for batch in batches:
            for row in _rows(batch):
                if row["kind"] == 0:
                    at, known = row["range"], np.frombuffer(row["low"], np.uint64).copy()
                    counts = np.frombuffer(row["high"], "<u4").copy()
                elif row["range"] == at:                 # a range without a dictionary repeats nothing
                    yield work(row, known, counts)

    names = sent.columns
    dictionary = frequent.select("range", F.col("shingles").alias("low"), F.col("counts").alias("high"), F.lit(0).alias("kind"))
    both = sent.withColumn("kind", F.lit(1)).unionByName(dictionary, allowMissingColumns=True)
    return (both.repartition(C.parallelism(sent.sparkSession), "range").sortWithinPartitions("range", "kind")
            .select(*names, "kind").mapInArrow(rows, schema))


def _hits(row: dict, known: np.ndarray, counts: np.ndarray):
    """(classes, their sizes, owner of each shingle, hash of each, counts of the repeated ones, which are repeated)."""
    h = _unpack(row["low"], row["high"], row["top"])
    classes, sizes = np.frombuffer(row["classes"], np.int64), np.frombuffer(row["sizes"], "<u4")
    owner = np.frombuffer(row["owner"], "<u2" if len(classes) < 1 << 16 else "<u4")
    if not len(known):
        return classes, sizes, owner, h, counts[:0], np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = np.flatnonzero(known[at] == h)
    return classes, sizes, owner, h, counts[at[hit]], hit


def promising_classes(docs: DataFrame, rows: DataFrame, n: int = SHINGLE, region: float = REGION) -> DataFrame:
    """class: those that do not miss too many shingles of the region to have a partner.

    A range only tells the repeated shingles of a class beyond a quarter of
    its shingles there; a quarter of all in the region is added in return, so
    the sum is never below the true number.
    """
    total = rows.select(F.sum("low").alias("t")).first()["t"] or 0
    ranges = max(1, math.ceil(total / RANGE_SHINGLES))
    frequent = C.store(repeated_shingles(docs, ranges, n, region), "shingles")

    def count(row, known, counts):
        classes, _, owner, _, _, hit = _hits(row, known, counts)
        found = np.bincount(owner[hit], minlength=len(classes))
        beyond = 4 * found - np.bincount(owner, minlength=len(classes))
        some = np.flatnonzero(beyond > 0)
        return pa.RecordBatch.from_arrays([pa.array(classes[some]), pa.array(beyond[some].astype(np.int64))],
                                          names=["class", "beyond"])

    told = _beside(_sent_sets(docs, ranges, n, region), frequent, count, "class long, beyond long")
    told = C.store(told.groupBy("class").agg(F.sum("beyond").alias("beyond")), "told", BATCH_ROWS)
    C.drop_stored(docs.sparkSession, frequent)
    classes = rows.filter("n_shingles > 0").select("class", "n_shingles", "low").distinct()
    missing = F.col("n_shingles") - F.ceil(F.col("n_shingles") * PERCENT / 100)
    promising = C.store(classes.join(told, "class", "left").filter(
        4 * (F.col("low") - missing) <= F.col("low") + F.coalesce("beyond", F.lit(0))).select("class"), "promising")
    C.drop_stored(docs.sparkSession, told)
    return promising


def repeated_sets(docs: DataFrame, frequent: DataFrame, ranges: int, n: int = SHINGLE) -> DataFrame:
    """class, n, s (shingles and counts), kept: the repeated shingles of each class that can have a partner at all."""
    def attach(row, known, counts):
        classes, sizes, owner, h, times, hit = _hits(row, known, counts)
        by_owner = np.argsort(owner[hit], kind="stable")
        hit, times = hit[by_owner], times[by_owner]
        inside, begin = np.unique(owner[hit], return_index=True)
        code = h[hit]
        bounds = np.append(begin, len(hit)).astype(np.int32)

        def binary(values, width):
            return pa.Array.from_buffers(pa.binary(), len(inside), [
                None, pa.py_buffer(bounds * width), pa.py_buffer(np.ascontiguousarray(values))])

        return pa.RecordBatch.from_arrays(
            [pa.array(classes[inside]), pa.array(np.full(len(inside), row["range"])),
             pa.array(sizes[inside].astype(np.int64)), binary(code, 8), binary(times.astype("<u4"), 4)],
            names=["class", "range", "n", "shingles", "counts"])

    hits = _beside(_sent_sets(docs, ranges, n, 1.0), frequent, attach,
                   "class long, range long, n long, shingles binary, counts binary")
    # a class of several rows gives equal parts: the set keeps one, map-side already
    sets = hits.groupBy("class").agg(F.first("n").alias("n"),
                                     F.collect_set(F.struct("range", "shingles", "counts")).alias("s"))
    kept = F.aggregate("s", F.lit(0).cast("long"), lambda t, x: t + (F.octet_length(x["counts"]) / 4).cast("long"))
    return sets.withColumn("kept", kept).filter(F.col("kept") * 100 >= F.col("n") * PERCENT)


def _ordered(row) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of a class in the global order: rare first, then by value."""
    code = np.frombuffer(b"".join(s["shingles"] for s in row["s"]), np.uint64)
    times = np.frombuffer(b"".join(s["counts"] for s in row["s"]), "<u4")
    order = np.lexsort((code, times))
    return code[order], times[order]


def prefix_entries(sets: DataFrame) -> DataFrame:
    """(shingle, class) for the repeated shingles among each class's prefix."""
    def rows(batches):
        for batch in batches:
            shingles, classes = [], []
            for row in batch.to_pylist():
                code, _ = _ordered(row)
                n = row["n"]
                length = n - -(-PERCENT * n // 100) + 1
                take = max(0, length - (n - len(code)))
                shingles.append(code[:take].view(np.int64))
                classes.append(np.full(min(take, len(code)), row["class"], np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(shingles)), pa.array(np.concatenate(classes))], names=["shingle", "class"])
    return sets.select("class", "n", "s").mapInArrow(rows, "shingle long, class long")


class _Node:
    __slots__ = ("path", "kids", "sets", "least", "most", "rest", "member", "uniform")

    def __init__(self, path, rest, least, most, member):
        self.path, self.kids, self.sets = path, {}, []
        self.rest, self.least, self.most = rest, least, most
        self.member, self.uniform = member, True


class Trie:
    """Path-compressed prefix tree of ordered sets with the components found so far.

    ``rest``: the longest continuation below a node; ``least``/``most``: sizes of
    the sets below; ``uniform``: all of them are connected with ``member``.
    """

    def __init__(self, sets: list[np.ndarray], sizes: list[int], width: int, percent: int = PERCENT):
        self.sets, self.sizes, self.percent = sets, sizes, percent
        self.mask = np.zeros(width + 1, bool)
        self.parent = list(range(len(sets)))
        self.kids: dict[int, _Node] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b

    def _connected(self, node: _Node, root: int) -> bool:
        if not node.uniform:
            node.uniform = (len(node.kids) <= 64 and all(self.find(s) == root for s in node.sets)
                            and all(k.uniform and self.find(k.member) == root for k in node.kids.values()))
            if node.uniform:
                node.member = root
        return node.uniform and self.find(node.member) == root

    def match(self, x: int) -> None:
        """Links set x with the stored sets it is similar to, one link per component."""
        q, n, p = self.sets[x], self.sizes[x], self.percent
        self.mask[q] = True
        smallest = -(-p * n // 100)
        stack = [(k, 0) for k in self.kids.values()]
        while stack:
            node, shared = stack.pop()
            if node.most < smallest or node.least * p > 100 * n or self._connected(node, self.find(x)):
                continue
            enough = p * (n + max(node.least, smallest))
            left = len(q) - int(np.searchsorted(q, node.path[0]))
            if (100 + p) * (shared + min(left, len(node.path) + node.rest)) < enough:
                continue
            shared += int(np.count_nonzero(self.mask[node.path]))
            for s in node.sets:
                if (100 + p) * shared >= p * (n + self.sizes[s]) and self.union(x, s):
                    self.links.append((x, s))
            left = len(q) - int(np.searchsorted(q, node.path[-1], "right"))
            if (100 + p) * (shared + min(left, node.rest)) >= enough:
                stack += [(k, shared) for k in node.kids.values()]
        self.mask[q] = False

    def add(self, x: int) -> None:
        q, n, at, kids = self.sets[x], self.sizes[x], 0, self.kids
        root = self.find(x)
        while True:
            first = int(q[at])
            node = kids.get(first)
            if node is None:
                node = kids[first] = _Node(q[at:], 0, n, n, x)
                node.sets.append(x)
                return
            width = min(len(node.path), len(q) - at)
            differs = np.flatnonzero(node.path[:width] != q[at:at + width])
            same = int(differs[0]) if len(differs) else width
            if same < len(node.path):
                below = _Node(node.path[same:], node.rest, node.least, node.most, node.member)
                below.kids, below.sets, below.uniform = node.kids, node.sets, node.uniform
                node.rest += len(node.path) - same
                node.path, node.kids, node.sets = node.path[:same], {int(below.path[0]): below}, []
            at += same
            node.least, node.most = min(node.least, n), max(node.most, n)
            node.rest = max(node.rest, len(q) - at)
            node.uniform = node.uniform and self.find(node.member) == root
            if at == len(q):
                node.sets.append(x)
                return
            kids = node.kids


def trie_links(rows: list[dict]) -> list[tuple[int, int]]:
    """Links (pairs of class keys that connect all similar sets) of one block.

    Rows with ``query`` are only matched against the others and among
    themselves; ``part`` names what is connected already.
    """
    ordered = [_ordered(r) for r in rows]
    code, times = np.concatenate([o[0] for o in ordered]), np.concatenate([o[1] for o in ordered])
    values, first, inverse, here = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    frequent_first = np.lexsort((values, -times[first].astype(np.int64)))
    rank = np.empty(len(values), np.int64)
    rank[frequent_first] = np.arange(len(values))
    rank, shared = rank[inverse], here[inverse] > 1
    sets, at = [], 0
    for c, _ in ordered:
        part = slice(at, at + len(c))
        sets.append(np.sort(rank[part][shared[part]]))
        at += len(c)
    trie = Trie(sets, [r["n"] for r in rows], len(values))
    parts: dict[int, int] = {}
    for x, r in enumerate(rows):
        if r["part"] is not None:
            trie.union(x, parts.setdefault(r["part"], x))
    order = sorted(range(len(rows)), key=lambda x: (r["query"] if (r := rows[x]) else False, r["n"], r["class"]))
    for x in order:
        if len(sets[x]):
            if rows[x]["query"] or rows[x]["part"] is None:
                trie.match(x)
            trie.add(x)
    return [(rows[a]["class"], rows[b]["class"]) for a, b in trie.links]


def _links(blocks: DataFrame, keys: list[str]) -> DataFrame:
    def link(table: pa.Table) -> pa.Table:
        pairs = trie_links(table.to_pylist())
        return pa.Table.from_arrays([pa.array([a for a, _ in pairs], pa.int64()),
                                     pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])
    return blocks.groupBy(*keys).applyInArrow(link, "a long, b long")


def class_components(docs: DataFrame, classes: DataFrame, n: int = SHINGLE,
                     block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(node, component) over class keys, for classes linked with another."""
    chosen = promising_classes(docs, classes, n)
    first = classes.join(chosen, "class").groupBy("class").agg(
        F.min("doc_id").alias("_first"), F.first("n_shingles").alias("n_shingles"))
    first = C.store(first, "first")
    docs = C.store(docs.join(first.select("_first").distinct(), docs["doc_id"].eqNullSafe(F.col("_first")), "left_semi"),
                   "candidates")
    total = first.select(F.sum("n_shingles").alias("t")).first()["t"] or 0
    ranges = max(1, math.ceil(total / RANGE_SHINGLES))
    frequent = C.store(repeated_shingles(docs, ranges, n), "shingles")
    sets = C.store(repeated_sets(docs, frequent, ranges, n), "sets", BATCH_ROWS)
    for done in (frequent, docs):                          # nothing below reads them
        C.drop_stored(sets.sparkSession, done)
    entries = C.store(prefix_entries(sets), "prefixes")
    lead = entries.groupBy("shingle").agg(F.min("class").alias("b"), F.max("class").alias("most")).filter("b < most")
    edges = entries.join(lead, "shingle").select(F.col("class").alias("a"), "b").filter("a <> b").distinct()
    clusters = components(edges)
    C.drop_stored(sets.sparkSession, entries)
    members = sets.select("class", "n", "s", "kept").join(
        clusters.select(F.col("node").alias("class"), F.col("component").alias("cluster")), "class")
    members = C.store(members, "members")
    size = members.groupBy("cluster").agg(F.sum("kept").alias("shingles"))
    size = size.select("cluster", F.ceil(F.col("shingles") / block_shingles).cast("int").alias("blocks"))
    many = size.filter("blocks > 1")
    plain = members.join(size.filter("blocks = 1"), "cluster").withColumn("block", F.lit(0))
    split = members.join(many, "cluster").select(
        *members.columns, "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"))
    leaders = _leaders(members, many)
    leaders_everywhere = (split.join(leaders, ["cluster", "class"]).drop("block")
                          .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    split = split.join(leaders, ["cluster", "class"], "left_anti").unionByName(leaders_everywhere)
    columns = ["cluster", "block", "class", "n", "s"]
    all_blocks = plain.select(*columns).unionByName(split.select(*columns)).select(
        *columns, F.lit(False).alias("query"), F.lit(None).cast("long").alias("part"))
    links = C.store(_links(all_blocks, ["cluster", "block"]), "links")
    found = components(links)
    if not many.limit(1).count():
        return found
    parts = split.select(*columns, "blocks").join(
        found.select(F.col("node").alias("class"), F.col("component").alias("part")), "class", "left")
    parts = C.store(parts.withColumn("part", F.coalesce("part", "class")), "parts")
    largest = (parts.groupBy("cluster", "part").agg(F.count("*").alias("c")).groupBy("cluster")
               .agg(F.max(F.struct("c", "part")).alias("big")).select("cluster", F.col("big.part").alias("big")))
    rest = parts.join(largest, "cluster").filter("part <> big").select(*columns, "part", "blocks")
    rest = rest.dropDuplicates(["cluster", "class"])
    width = rest.groupBy("cluster").agg(F.ceil(F.sum(F.expr(
        "aggregate(s, 0L, (x, y) -> x + octet_length(y.counts))")) / 4 / block_shingles).cast("int").alias("groups"))
    asked = (rest.join(width, "cluster").withColumn("group", F.pmod(F.xxhash64("class", F.lit(1)), F.col("groups")))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    stored = (parts.join(width, "cluster").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .withColumn("group", F.col("group").cast("long")))
    stored = stored.join(asked.select("cluster", "class", "block", "group"),
                         ["cluster", "class", "block", "group"], "left_anti")
    shape = [*columns, "part", "group"]
    again = (asked.select(*shape, F.lit(True).alias("query"))
             .unionByName(stored.select(*shape, F.lit(False).alias("query"))))
    more = _links(again, ["cluster", "block", "group"])
    return components(C.store(links.unionByName(more), "links"))


def _leaders(members: DataFrame, many: DataFrame) -> DataFrame:
    """The few classes of each split cluster with the smallest hashes, kept by a bounded aggregate."""
    of_split = members.select("cluster", "class").join(many, "cluster").withColumn("h", F.xxhash64("class"))
    pieces = of_split.withColumn("piece", F.pmod(F.col("h"), F.lit(64)))
    first = Window.partitionBy("cluster", "piece").orderBy("h")
    near = pieces.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= LEADERS)
    whole = Window.partitionBy("cluster").orderBy("h")
    return (near.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= LEADERS)
            .select("cluster", "class"))


def join(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, class (key of the shingle set, 0 if empty), part (key of the component, null
    if the set is empty), component_id for every document."""
    C.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = C.store(summaries(docs, n), "classes")
    classes = rows.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    linked = class_components(docs, rows, n)
    named = classes.join(linked, classes["class"] == linked["node"], "left").select(
        "class", "first", F.coalesce("component", "class").alias("part"))
    named = C.store(named, "named")
    label = named.groupBy("part").agg(F.min("first").alias("component_id"))
    known = named.join(label, "part").select("class", "part", "component_id")
    return rows.join(known, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", "class", "part",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    return join(C.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, md5(array_to_string(words[i:i + 4], ' ')) AS g
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 5)
    UNION ALL SELECT doc_id, md5(array_to_string(words, ' ')) FROM w WHERE len(words) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""
