"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library.

The pre-tokenizer always cuts before a single space between two characters
that are no white space, so a text is encoded as its space-separated parts,
and each distinct part goes through the tokenizer once per worker: a worker
keeps the ids of the parts it meets (up to ``CACHE_PARTS``, beyond that once
per block), found by a 64-bit hash of the part's bytes. Parts are handed over
joined by spaces; a part's ids begin at the token that starts with a space. A
text with other white space next to a space, or with the string of an added
token, is encoded in one piece. The ids are those of ``Tokenizer.encode``.
"""
from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common as C
from . import textkit as K

CACHE_PARTS = 400_000
BLOCK_BYTES = 1 << 20
JOINED_PARTS = 2_000       # parts handed to the tokenizer as one string
_SPACE = np.zeros(256, bool)
_SPACE[32] = True
_WHITE = _SPACE.copy()
_WHITE[9:14] = True
_OPENING = np.uint64(0x5851F42D4C957F2D)      # tells a part that opens its text from one after a space
_encoders: dict[str, "Encoder"] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _wide_space(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether bytes a, b begin a character that may be white space outside ASCII (it need not be)."""
    return ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | (
        ((a == 0xE1) | (a == 0xE2) | (a == 0xE3)) & ((b == 0x80) | (b == 0x81) | (b == 0x9A)))


def splittable(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: whether every space in it stands between two characters that are no white space."""
    n = len(buf)
    ok = np.ones(len(offsets) - 1, bool)
    if not n:
        return ok
    padded = np.concatenate([np.full(3, 32, np.uint8), buf, np.full(2, 32, np.uint8)])
    at = np.flatnonzero(buf == 32) + 3
    bad = (_WHITE[padded[at - 1]] | _WHITE[padded[at + 1]] | _wide_space(padded[at + 1], padded[at + 2])
           | _wide_space(padded[at - 2], padded[at - 1]) | _wide_space(padded[at - 3], padded[at - 2]))
    ok[np.searchsorted(offsets, at[bad] - 3, "right") - 1] = False
    filled = np.flatnonzero(np.diff(offsets) > 0)
    edge = _WHITE[buf[offsets[filled]]] | _WHITE[buf[offsets[filled + 1] - 1]]
    ok[filled[edge]] = False
    return ok


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = np.zeros(0, np.uint64)                # hashes of cached parts, ascending
        self.number = np.zeros(0, np.int64)                # their places in first and length
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_parts(self, following: list[bytes], opening: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per part) of parts after a space, then of parts that open a text."""
        joined = [(b" " + b" ".join(following[i:i + JOINED_PARTS])).decode()
                  for i in range(0, len(following), JOINED_PARTS)]
        ids = np.concatenate([np.zeros(0, np.uint32), *self._encode(joined)])
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(following):                  # not this vocabulary's way to write a space
            each = self._encode([" " + p.decode() for p in following])
            ids, counts = np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)
        else:
            counts = np.diff(np.append(begins, len(ids)))
        heads = self._encode([p.decode() for p in opening])
        return (np.concatenate([ids, *heads]),
                np.concatenate([counts, np.array([len(h) for h in heads], np.int64)]).astype(np.int64))

    def _look_up(self, keys: np.ndarray, opens: np.ndarray, start: np.ndarray, end: np.ndarray, raw: bytes):
        """(first, length) in the returned pool for each part."""
        distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        hit = np.zeros(len(distinct), bool)
        inside = place < len(self.known)
        hit[inside] = self.known[place[inside]] == distinct[inside]
        at = np.empty(len(distinct), np.int64)
        at[hit] = self.number[place[hit]]
        first, length, pool = self.first, self.length, self.pool
        new = np.flatnonzero(~hit)
        if len(new):
            new = new[np.argsort(opens[sample[new]], kind="stable")]
            parts = [raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())]
            after = len(new) - int(opens[sample[new]].sum())
            ids, counts = self._encode_parts(parts[:after], parts[after:])
            at[new] = len(first) + np.arange(len(new))
            first = np.concatenate([first, len(pool) + np.cumsum(counts) - counts])
            length = np.concatenate([length, counts])
            pool = np.concatenate([pool, ids])
            if len(self.known) < CACHE_PARTS:
                fresh = np.sort(new)
                self.number = np.insert(self.number, place[fresh], at[fresh])
                self.known = np.insert(self.known, place[fresh], distinct[fresh])
                self.first, self.length, self.pool = first, length, pool
        at = at[inverse]
        return first[at], length[at], pool

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, number of ids per text) of a block of UTF-8 texts."""
        offsets = offsets - offsets[0]
        raw = buf.tobytes()
        whole = ~splittable(buf, offsets)
        for w in self.whole:
            at = raw.find(w)
            while at >= 0:
                whole[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(w, at + 1)
        words = K.Words(buf, offsets, separators=_SPACE)
        owner = np.repeat(np.arange(len(whole)), words.counts())
        opens = np.zeros(len(words), bool)
        opens[words.first[:-1][words.counts() > 0]] = True
        keys = np.where(opens, words.hash ^ _OPENING, words.hash)
        stay = ~whole[owner]
        start, end = words.start, words.end
        if not stay.all():
            keys, opens, start, end, owner = keys[stay], opens[stay], start[stay], end[stay], owner[stay]
        first, size, pool = self._look_up(keys, opens, start, end, raw)
        counts = np.bincount(owner, weights=size, minlength=len(whole)).astype(np.int64)
        shift = np.repeat(first - (np.cumsum(size) - size), size)
        flat = pool[shift + np.arange(len(shift))]
        direct = np.flatnonzero(whole)
        if len(direct):
            pieces = np.split(flat, np.cumsum(counts)[:-1])
            for k, ids in zip(direct, self._encode([raw[offsets[k]:offsets[k + 1]].decode() for k in direct])):
                pieces[k] = ids
                counts[k] = len(ids)
            flat = np.concatenate(pieces)
        return flat, counts


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded_batches(batches, path: str, end_id: int):
    """Yields (doc_ids array, ids, counts) for record batches of (doc_id, text), each
    document closed by ``end_id``; a null text is empty."""
    enc = encoder(path)
    for batch in batches:
        buf, off = K.utf8(batch.column("text"))
        for i, j in K.blocks(off, BLOCK_BYTES, 1 << 14):
            flat, counts = enc.encode(buf[off[i]:off[j]], off[i:j + 1])
            yield batch.column("doc_id").slice(i, j - i), np.insert(flat, np.cumsum(counts), np.uint32(end_id)), counts + 1
    pa.default_memory_pool().release_unused()              # workers outlive their tasks


def in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, text) in ascending doc_id over range partitions; ties by text, equal rows spread by number."""
    rows = (docs.select("doc_id", "text").withColumn("_h", F.xxhash64("text"))
            .withColumn("_tie", F.monotonically_increasing_id()))
    by = ["doc_id", "_h", "_tie"]
    return (rows.repartitionByRange(partitions or C.parallelism(docs.sparkSession), *by)
            .sortWithinPartitions(*by).select("doc_id", "text"))


def binary_slices(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column of the little-endian ids between consecutive bounds."""
    data = np.ascontiguousarray(ids, dtype="<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(bounds * 4, dtype=np.int64)), pa.py_buffer(data)]).cast(pa.binary())
