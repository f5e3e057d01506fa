"""Order-preserving packing of token streams into windows by dynamic programming.

Documents in ascending doc_id order form one token stream per range partition.
Windows of at most ``window`` tokens cover the stream; cuts are chosen among
document ends and sentence ends (and, inside a sentence longer than a window,
at forced places). The cost of a window is its padding plus a penalty for the
cut that ends it: none at a document end, ``SENTENCE_PENALTY`` inside a
document, ``FORCED_PENALTY`` inside a sentence. As padding is linear in the
window's bounds, the best start for each cut is the least of
``cost[i] + place[i]`` over a sliding range, kept in a monotone queue, so the
programme is linear in the number of candidate cuts.

The stream is solved in blocks of ``BLOCK_TOKENS``; the last window of a
block is opened again in the next, so memory does not grow with the data.
Each range partition ends with one partly filled window.

Defined cases: a null or empty text is one token (its end id); equal rows are
packed once each; an empty table gives an empty result; extra columns do not
matter; a document longer than a window spans several.
"""
from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import common as C
from . import tokens as T

WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 4
FORCED_PENALTY = 64
BLOCK_TOKENS = 1 << 18
SENTENCE_ENDS = ".!?Ċ"      # Ċ: how the vocabulary writes a line feed
PIECE_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long")


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Chosen places, in order; ``places`` ascends, ends with the stream's length, gaps <= window."""
    at, pen = [0, *places.tolist()], [0, *penalties.tolist()]
    n = len(at)
    cost, back = [0] * n, [0] * n
    queue: deque[int] = deque([0])
    key = [0] * n
    for j in range(1, n):
        here = at[j]
        low = here - window
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        cost[j] = c = key[i] + window - here + pen[j]
        key[j] = k = c + here
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int, window: int):
    """Places and penalties of the allowed cuts, gaps over a window filled by forced cuts."""
    places = np.union1d(np.union1d(doc_ends, sentence_ends), [total])
    places = places[(places > 0) & (places <= total)]
    gaps = np.diff(np.concatenate([[0], places]))
    wide = np.flatnonzero(gaps > window)
    if len(wide):
        forced = [np.arange(places[w] - gaps[w] + window, places[w], window) for w in wide]
        places = np.union1d(places, np.concatenate(forced))
        penalties = np.full(len(places), SENTENCE_PENALTY)
        penalties[np.isin(places, np.concatenate(forced))] = FORCED_PENALTY
    else:
        penalties = np.full(len(places), SENTENCE_PENALTY)
    penalties[np.isin(places, doc_ends)] = 0
    return places, penalties


class _Stream:
    """Documents waiting to be cut; ``skip`` tokens of the first are in windows already."""

    def __init__(self, window: int, sentence_end: np.ndarray, sequence: int):
        self.window, self.sentence_end, self.sequence = window, sentence_end, sequence
        self.ids, self.doc_ids, self.counts, self.skip = [], [], [], 0

    def held(self) -> int:
        return sum(map(len, self.ids))

    def add(self, doc_ids: pa.Array, flat: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(flat)
        self.doc_ids += doc_ids.to_pylist()
        self.counts += counts.tolist()

    def cut(self, last: bool) -> pa.RecordBatch | None:
        flat = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        if not len(flat):
            return None
        counts = np.asarray(self.counts)
        starts = np.cumsum(counts) - counts - self.skip        # where each document begins, in flat
        ends = starts + counts
        sentences = np.flatnonzero(self.sentence_end[flat]) + 1
        cuts = best_cuts(*candidates(ends, sentences, len(flat), self.window), self.window)
        if not last:
            cuts.pop()
        if not cuts:
            return None
        done = cuts[-1]
        bounds = np.union1d(np.union1d(cuts, ends[ends <= done]), [0]).astype(np.int64)
        begin, length = bounds[:-1], np.diff(bounds)
        doc = np.searchsorted(ends, begin, "right")
        window = np.searchsorted(cuts, begin, "right")
        window_start = np.concatenate([[0], cuts])[window]
        batch = pa.RecordBatch.from_arrays([
            pa.array([self.doc_ids[d] for d in doc], pa.int64()), pa.array(begin - starts[doc]), pa.array(length),
            T.binary_slices(flat[:done], bounds), pa.array(counts[doc]),
            pa.array(self.sequence + window), pa.array(begin - window_start)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(cuts)
        kept = int(np.searchsorted(ends, done, "right"))
        self.skip = int(done - starts[kept]) if kept < len(counts) else 0
        self.ids, self.doc_ids, self.counts = [flat[done:]], self.doc_ids[kept:], self.counts[kept:]
        return batch


def _packer(path: str, window: int, end_id: int):
    def pack(batches):
        enc = T.encoder(path)
        size = enc.tokenizer.get_vocab_size()
        sentence_end = np.array([(enc.tokenizer.id_to_token(i) or " ")[-1] in SENTENCE_ENDS for i in range(size)])
        stream = _Stream(window, sentence_end, TaskContext.get().partitionId() << 32)
        for doc_ids, flat, counts in T.encoded_batches(batches, path, end_id):
            stream.add(doc_ids, flat, counts)
            if stream.held() >= BLOCK_TOKENS and (out := stream.cut(last=False)) is not None:
                yield out
        if (out := stream.cut(last=True)) is not None:
            yield out
    return pack


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         partitions: int | None = None) -> DataFrame:
    """One row per piece of a document in a window, with its token ids.

    ``sequence_id`` numbers the windows in document order: the range partition's
    number in the upper bits, the window's number within it in the lower 32.
    """
    C.prepare(docs.sparkSession)
    path = path or T.vocabulary_path()
    return T.in_order(docs, partitions).mapInArrow(_packer(path, window, end_id), PIECE_SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    return digest(pack(C.documents(spark, sf_dir)))
