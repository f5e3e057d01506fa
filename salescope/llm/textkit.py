"""Vectorised text primitives used inside tasks (numpy over Arrow buffers).

A word is a maximal run of bytes outside ``{0x20, 0x09-0x0D}``. Words and
word n-grams are identified by 64-bit hashes of their whole bytes, computed
for a block of documents at once with prefix sums, so no Python object is
made per word. Null texts are empty.

A word's hash adds up one random number per byte and place in the word, so no
regular pattern of bytes makes two words collide. N-grams are polynomials of
word hashes modulo 2^64, which patterns of 1,024 words and more can make
collide; longer sequences go through ``row_hash``, which scrambles the hashes
of stretches of ``STRETCH`` words before it adds them up.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

SEPARATORS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BLOCK_BYTES = 1 << 20          # text handled at once; one longer document is one block
BLOCK_ROWS = 1 << 9            # documents handled at once

_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_CODE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
PLACES = 64                    # places of a word with a table of their own
STRETCH = 512                  # words of a long sequence that are hashed as one n-gram
_PLACED_CODE = np.random.default_rng(20260301).integers(0, 2**64, PLACES * 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers["p"]) < n:
        size = max(n, BLOCK_BYTES)
        for name, base in (("p", _BASE), ("q", _BASE_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(29))
    h = h * _M2
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]] if n else buf[:0], off - off[0] if n else np.zeros(1, np.int64)


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of at most ``rows`` documents and ``size`` bytes (one document at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


class Words:
    """Words of a block of documents: hash, bounds, and where each document's start.

    ``first[d]:first[d + 1]`` are the words of document d of the block.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _IS_SEP):
        offsets = offsets - offsets[0]
        n = len(buf)
        if lower:
            buf = LOWER[buf]
        sep = separators[buf]
        inside = ~sep
        begins = np.empty(n, bool)
        ends = np.empty(n, bool)
        if n:
            begins[0] = ends[-1] = True
            begins[1:] = sep[:-1]
            ends[:-1] = sep[1:]
            cuts = offsets[(offsets > 0) & (offsets < n)]
            begins[cuts] = True
            ends[cuts - 1] = True
        self.start = np.flatnonzero(begins & inside)
        self.end = np.flatnonzero(ends & inside) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._bytes, self._begins = buf, begins

    @cached_property
    def hash(self) -> np.ndarray:
        """Hash of each word: a sum of a random number per byte and place, scrambled."""
        n = len(self._bytes)
        if n >= 1 << 31:
            raise ValueError("a block of 2 GiB or more")
        number = np.arange(n, dtype=np.int32)
        place = number - np.maximum.accumulate(number * self._begins) if n else number
        code = np.take(_PLACED_CODE, ((place & (PLACES - 1)) << 8 | self._bytes).astype(np.intp), mode="clip")
        if n and place.max() >= PLACES:
            far = np.flatnonzero(place >= PLACES)
            code[far] = mix(code[far] + (place[far] >> 6).astype(np.uint64) * np.uint64(_BASE))
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(code, dtype=np.uint64, out=run[1:])
        return mix(run[self.end] - run[self.start])

    @cached_property
    def _run(self) -> np.ndarray:
        n = len(self._bytes)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[self._bytes] * _power_tables(n + 1)[0][:n], dtype=np.uint64, out=run[1:])
        return run

    def bytes_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of any bytes [start, end) of the block (a polynomial: for features, not to tell texts apart)."""
        run = self._run
        _, q = _power_tables(len(run))
        return mix((run[end] - run[start]) * q[start])

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def prefix_powers(h: np.ndarray) -> np.ndarray:
    """Running polynomial sums of word hashes (one more entry than words)."""
    p, _ = _power_tables(len(h) + 1)
    run = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:len(h)], dtype=np.uint64, out=run[1:])
    return run


def span_hash(run: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the word sequences [lo, hi), of some hundred words at most, from running sums; the length takes part."""
    _, q = _power_tables(len(run))
    return mix((run[hi] - run[lo]) * q[lo] + (hi - lo).astype(np.uint64))


def row_hash(run: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each document, of any length."""
    stretches = np.maximum(1, -(-np.diff(first) // STRETCH))
    owner = np.repeat(np.arange(len(stretches)), stretches)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    low = first[:-1][owner] + number * STRETCH
    part = span_hash(run, low, np.minimum(low + STRETCH, first[1:][owner]))
    part = mix(part + number.astype(np.uint64) * np.uint64(_BASE))
    return np.add.reduceat(part, np.cumsum(stretches) - stretches) if len(stretches) else part


def word_hashes(words: list[str], lower: bool = False) -> np.ndarray:
    """Hashes of single words, as ``Words.bytes_hash`` gives them."""
    buf, off = utf8(pa.array(words, pa.string()))
    found = Words(buf, off, lower)
    return found.bytes_hash(found.start, found.end)


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingles per document; with fewer words the whole sequence is one."""
    run = prefix_powers(words.hash)
    out = []
    begin = np.arange(max(0, len(words) - n + 1))
    all_grams = span_hash(run, begin, begin + n)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= n:
            g = np.sort(all_grams[a:b - n + 1])
            out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
        elif b > a:
            out.append(span_hash(run, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
