"""Substring dedup on a compacted de Bruijn graph of word sequences.

Edges are the windows of ``WINDOW`` consecutive words of a document (two
windows that follow each other share a node of ``WINDOW - 1`` words). As usual
for large graphs, edges are dealt by their minimizer: the ``MINIMIZER``-word
run inside the window with the least hash. Consecutive edges with one
minimizer form a run, so a document is a chain of runs and every edge of the
corpus with a given minimizer meets in one group.

* A minimizer that occurs in one document only is dropped at once.
* A minimizer whose runs are all equal does not branch there: all its edges
  have the same sources. Runs that always follow each other are compacted
  into paths by joins (equal source coordinates after one and before the
  next, and the least occurrence of one followed by that of the next), then
  pointer jumping. A path has one smallest source.
* A minimizer with different runs branches: the source coordinates of one
  occurrence of each different run are looked up in the text, and its single
  edges are compared by the hash of all their words.

Each occurrence of a path or branching run then marks its windows whose
smallest source is a smaller doc_id, and the words of marked windows go.

The result is exact up to collisions of 64-bit hashes. Defined cases: a null,
empty or blank text has no words; a document shorter than the window is kept
whole; rows with one doc_id never remove each other's words; a row with a
null doc_id is kept whole and is no source; an empty table gives an empty
result; extra columns do not matter; a long document is read whole.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, functions as F

from . import common as C
from . import textkit as K

WINDOW = 50
MINIMIZER = 25
RUNS = "minimizer long, run long, doc_id long, row_key long, first int, edges int"
_MARK = "array<struct<begin:int,end:int,source:bigint>>"


def row_keys(doc_ids: np.ndarray, words: K.Words, run: np.ndarray) -> np.ndarray:
    """A key per row from doc_id and the whole word sequence."""
    return K.mix(K.row_hash(run, words.first) ^ K.mix(doc_ids.astype(np.int64).view(np.uint64))).view(np.int64)


def edge_runs(words: K.Words, run: np.ndarray, window: int = WINDOW, minimizer: int = MINIMIZER):
    """(document, first word in the block, number of edges, minimizer hash, run hash) of a block's runs."""
    n, span = len(words), window - minimizer + 1
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none
    start = np.arange(n - minimizer + 1)
    seed = K.span_hash(run, start, start + minimizer)
    place = np.lib.stride_tricks.sliding_window_view(seed, span).argmin(axis=1) + np.arange(n - window + 1)
    doc = np.repeat(np.arange(len(words.first) - 1), words.counts())
    at = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    if not len(at):
        return none, none, none, none, none
    anchor = place[at]
    begins = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (np.diff(at) != 1))))
    first, edges = at[begins], np.diff(np.append(begins, len(at)))
    anchor = anchor[begins]
    content = K.span_hash(run, first, first + edges + window - 1)
    whole = K.mix(content ^ ((anchor - first).astype(np.uint64) << np.uint64(32)) ^ edges.astype(np.uint64))
    return doc[first], first, edges, seed[anchor].view(np.int64), whole.view(np.int64)


def _find_runs(window: int, minimizer: int):
    def rows(batches):
        for batch in batches:
            buf, off = K.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for i, j in K.blocks(off):
                words = K.Words(buf[off[i]:off[j]], off[i:j + 1])
                run = K.prefix_powers(words.hash)
                doc, first, edges, seed, whole = edge_runs(words, run, window, minimizer)
                keys = row_keys(ids[i:j], words, run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed, pa.int64()), pa.array(whole, pa.int64()), pa.array(ids[i:j][doc], pa.int64()),
                     pa.array(keys[doc], pa.int64()), pa.array((first - words.first[doc]).astype(np.int32)),
                     pa.array(edges.astype(np.int32))],
                    names=["minimizer", "run", "doc_id", "row_key", "first", "edges"])
        pa.default_memory_pool().release_unused()          # workers outlive their tasks
    return rows


def repeated_runs(docs: DataFrame, window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """All occurrences of runs whose minimizer lies in two documents or more."""
    runs = C.store(docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
                   .mapInArrow(_find_runs(window, minimizer), RUNS), "runs")
    # written first: a join of two plain exchanges, so the rows of a frequent minimizer can be split
    shared = C.store(runs.groupBy("minimizer").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                     .filter("a < b").select("minimizer"), "shared")
    out = C.store(runs.join(shared, "minimizer", "left_semi"), "runs")
    C.drop_stored(docs.sparkSession, runs)
    return out


def _distinct_runs(runs: DataFrame) -> DataFrame:
    """One row per different run: its sources' bounds, one occurrence, and sums that name the source
    coordinates before and after it; ``branches`` tells whether its minimizer has other runs."""
    def coordinates(place):                                # both halves of the hash: the sums have room, no bit is cut
        whole = F.xxhash64("row_key", place)
        return F.struct(F.sum(F.shiftrightunsigned(whole, 32)).alias("high"),
                        F.sum(whole.bitwiseAND(F.lit((1 << 32) - 1))).alias("low"))

    distinct = runs.groupBy("minimizer", "run").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.count("*").alias("times"),
        F.first("edges").alias("edges"), F.min(F.struct("doc_id", "row_key", "first")).alias("at"),
        coordinates(F.col("first")).alias("here"), coordinates(F.col("first") + F.col("edges")).alias("after"))
    minimizers = distinct.groupBy("minimizer").agg(F.count("*").alias("n"))
    return distinct.join(minimizers, "minimizer").withColumn("branches", F.col("n") > 1).drop("n")


def compact_paths(distinct: DataFrame) -> DataFrame:
    """Paths of runs that do not branch: the first run's keys, its source, and the edges of the whole path."""
    spark = distinct.sparkSession
    straight = distinct.filter("NOT branches AND source < last").select(
        "minimizer", "run", "source", "edges", "times", "here", "after", "at")
    # where the least occurrence begins and ends: a link holds only if it is followed there in the text
    begin, end = ([F.col("at.doc_id").alias("d"), F.col("at.row_key").alias("r"), place.alias("f")]
                  for place in (F.col("at.first"), F.col("at.first") + F.col("edges")))
    keys = ["here", "times", "d", "r", "f"]
    before = straight.select(F.col("after").alias("here"), "times", *end, F.col("minimizer").alias("p_minimizer"),
                             F.col("run").alias("p_run"), F.col("edges").cast("long").alias("step"))
    before = before.groupBy(*keys).agg(F.min(F.struct("p_minimizer", "p_run", "step")).alias("p"),
                                       F.count("*").alias("n")).filter("n = 1")
    linked = straight.select("*", *begin).join(before, keys, "left")
    node = F.struct("minimizer", "run")
    now = linked.select(
        node.alias("node"), "source", "edges",
        F.when(F.col("p").isNull(), node).otherwise(F.struct(F.col("p.p_minimizer").alias("minimizer"),
                                                             F.col("p.p_run").alias("run"))).alias("head"),
        F.coalesce("p.step", F.lit(0)).cast("long").alias("distance"))
    now = C.store(now, "paths")
    far = now.agg(F.sum("distance")).first()[0]
    while True:                     # pointer jumping, three steps a round: log3(path length) tables are written
        up = now.select(F.col("node").alias("head"), F.col("head").alias("up"), F.col("distance").alias("more"))
        jumped = now
        for _ in range(2):
            jumped = jumped.join(up, "head").select("node", "source", "edges", F.col("up").alias("head"),
                                                    (F.col("distance") + F.col("more")).alias("distance"))
        old, now = now, C.store(jumped, "paths")
        C.drop_stored(spark, old)
        far, last = now.agg(F.sum("distance")).first()[0], far
        if far == last:
            break
    return now.groupBy("head").agg(F.min("source").alias("source"), F.max(F.col("distance") + F.col("edges")).alias("edges"),
                                   F.count("*").alias("runs")).select("head.minimizer", "head.run", "source", "edges", "runs")


def _edges_of(window: int):
    """Windows of the wanted runs of a document: hash of all their words, run and place in it."""
    def rows(batches):
        for batch in batches:
            buf, off = K.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            wanted = batch.column("wanted")
            for i, j in K.blocks(off):
                words = K.Words(buf[off[i]:off[j]], off[i:j + 1])
                run = K.prefix_powers(words.hash)
                keys = row_keys(ids[i:j], words, run)
                out = [[], [], [], [], []]
                for d in range(j - i):
                    some = wanted.slice(i + d, 1).flatten()
                    if not len(some):
                        continue
                    field = {n: some.field(n).to_numpy() for n in ("row_key", "first", "edges", "minimizer", "run",
                                                                   "source", "last")}
                    mine = np.flatnonzero(field["row_key"] == keys[d])
                    edges = field["edges"][mine].astype(np.int64)
                    place = np.arange(edges.sum()) - np.repeat(np.cumsum(edges) - edges, edges)
                    begin = np.repeat(words.first[d] + field["first"][mine], edges) + place
                    out[0].append(K.span_hash(run, begin, begin + window).view(np.int64))
                    out[1].append(np.repeat(field["minimizer"][mine], edges))
                    out[2].append(np.repeat(field["run"][mine], edges))
                    out[3].append(place)
                    out[4].append(np.repeat(np.stack([field["source"][mine], field["last"][mine]], 1), edges, axis=0))
                if out[0]:
                    source = np.concatenate(out[4])
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(np.concatenate(c)) for c in out[:3]], pa.array(np.concatenate(out[3]).astype(np.int32)),
                         pa.array(source[:, 0]), pa.array(source[:, 1])],
                        names=["edge", "minimizer", "run", "place", "source", "last"])
        pa.default_memory_pool().release_unused()
    return rows


def branching_marks(docs: DataFrame, distinct: DataFrame, window: int = WINDOW) -> DataFrame:
    """minimizer, run, marks: of each branching run the stretches of edges and their smallest source."""
    wanted = distinct.filter("branches").groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_list(
        F.struct(F.col("at.row_key").alias("row_key"), F.col("at.first").alias("first"), "edges", "minimizer", "run",
                 "source", "last")).alias("wanted"))
    edges = docs.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(
        _edges_of(window), "edge long, minimizer long, run long, place int, source long, last long")
    edges = C.store(edges, "edges")
    least = C.store(edges.groupBy("edge").agg(F.min("source").alias("least"), F.max("last").alias("most"))
                    .filter("least < most"), "least")
    found = edges.join(least, "edge").filter("least < last")
    out = found.groupBy("minimizer", "run").agg(F.collect_set(F.struct("place", F.col("least").alias("source"))).alias("m"))
    return out.select("minimizer", "run", F.transform("m", lambda x: F.struct(
        x["place"].alias("begin"), (x["place"] + 1).alias("end"), x["source"].alias("source"))).alias("marks"))


def marked_windows(docs: DataFrame, window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """doc_id, marks: per row (its key) the stretches of window starts whose words go."""
    runs = repeated_runs(docs, window, minimizer)
    distinct = C.store(_distinct_runs(runs), "distinct")
    paths = compact_paths(distinct).select("minimizer", "run", F.array(F.struct(
        F.lit(0).alias("begin"), F.col("edges").cast("int").alias("end"), "source")).alias("marks"))
    marks = C.store(paths.unionByName(branching_marks(docs, distinct, window)), "marks")
    found = runs.join(marks, ["minimizer", "run"]).select("doc_id", "row_key", F.expr(
        "transform(filter(marks, m -> m.source < doc_id), m -> struct(first + m.begin as begin, first + m.end as end))"
    ).alias("marks")).filter(F.size("marks") > 0)
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("row_key", "marks")).alias("marks"))


def _remove(window: int):
    def rows(batches):
        for batch in batches:
            buf, off = K.utf8(batch.column("text"))
            known = pa.compute.fill_null(batch.column("doc_id"), 0).to_numpy()
            marks = batch.column("marks")
            for i, j in K.blocks(off):
                block = buf[off[i]:off[j]]
                words = K.Words(block, off[i:j + 1])
                run = K.prefix_powers(words.hash)
                keys = row_keys(known[i:j], words, run)
                cover = np.zeros(len(words) + 1, np.int64)
                for d in range(j - i):
                    some = marks.slice(i + d, 1).flatten()
                    if not len(some):
                        continue
                    lists = some.field("marks")
                    owner = np.repeat(some.field("row_key").to_numpy(), pa.compute.list_value_length(lists).to_numpy())
                    spans = lists.flatten()
                    mine = owner == keys[d]
                    np.add.at(cover, words.first[d] + spans.field("begin").to_numpy()[mine], 1)
                    np.add.at(cover, words.first[d] + spans.field("end").to_numpy()[mine] + window - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                text, bounds = _kept_text(block, words, gone)
                removed = np.add.reduceat(np.append(gone, 0), np.minimum(words.first[:-1], len(gone))).astype(np.int64)
                removed[words.counts() == 0] = 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(words.counts()), pa.array(removed),
                     pa.Array.from_buffers(pa.large_string(), j - i, [
                         None, pa.py_buffer(bounds), pa.py_buffer(text)]).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text"])
        pa.default_memory_pool().release_unused()
    return rows


def _kept_text(block: np.ndarray, words: K.Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds per document): kept words joined by one space."""
    keep = np.flatnonzero(~gone)
    start, size = words.start[keep], words.end[keep] - words.start[keep] + 1
    ends = np.cumsum(size)
    from_ = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    text = np.concatenate([block, np.full(1, 32, np.uint8)])[from_]
    text[ends - 1] = 32
    doc = np.searchsorted(keep, words.first)               # kept words before each document
    bounds = np.concatenate([[0], ends])[doc]
    last = np.ones(len(text), bool)                         # the space after a document's last kept word goes
    filled = np.flatnonzero(np.diff(doc) > 0)
    last[bounds[1:][filled] - 1] = False
    return text[last], (bounds - np.concatenate([[0], np.cumsum(np.diff(doc) > 0)])).astype(np.int64)


def dedup(docs: DataFrame, window: int = WINDOW, minimizer: int = MINIMIZER) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row."""
    C.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    marks = C.store(marked_windows(docs, window, minimizer), "marked")
    return docs.join(marks, "doc_id", "left").select("doc_id", "text", "marks").mapInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, kept_text string")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(C.documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed",
                                                    F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)),
first AS (SELECT h, min(doc_id) AS source FROM windows GROUP BY h),
marked AS (SELECT doc_id, i FROM windows JOIN first USING (h) WHERE source < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM marked),
places AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(words, ' ')
              ELSE array_to_string([words[p] FOR p IN range(1, len(words) + 1) IF NOT list_contains(ps, p)], ' ') END) AS kept_sha256
FROM w LEFT JOIN places ON places.doc_id = w.doc_id
"""
