"""Token-ID output as Re-Pair grammars.

Texts are encoded in ascending doc_id order; the id stream is cut into shards
of about ``SHARD_TOKENS`` ids at document ends, and each shard is stored as a
grammar: frequent neighbouring pairs of symbols are replaced by new symbols,
round after round (all pairs of a round at once, the more frequent one first
where two overlap), until a round no longer pays or symbols leave 16 bits.

File format (Parquet, one row per shard): ``part``, ``shard`` (order within
the part), ``doc_ids``, ``doc_tokens`` (ids of each document, its end id
included), ``rules`` (left and right symbol of each nonterminal, uint32
pairs), ``lengths`` (ids each nonterminal stands for, uint32), ``symbols``
(uint16, or uint32 where ``wide``), ``n_tokens``, ``base`` (first
nonterminal). With the lengths' running sum ``read_range`` finds the symbols
that cover any range of ids and expands only those.

Defined cases: a null or empty text is its end id alone; equal rows are
written once each; an empty table gives no shard and an empty result; extra
columns do not matter; a document longer than a shard makes a longer shard.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import common as C
from . import tokens as T

END_ID = 0
SHARD_TOKENS = 1 << 20
LEAST_COUNT = 24          # a pair seen less often in a shard gets no rule
LEAST_GAIN = 0.01         # a round that replaces a smaller share of the symbols is the last
BROADCAST_SHARDS = 100_000   # the shards' offsets are broadcast up to this many, joined by shuffle beyond
_HASH_BITS = 20
SCHEMA = ("part long, shard long, doc_ids array<long>, doc_tokens array<long>, rules binary, lengths binary, "
          "symbols binary, wide boolean, n_tokens long, base long")


def _cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(2654435761)) ^ (b * np.uint32(2246822519))) >> np.uint32(32 - _HASH_BITS)


def _frequent_pairs(seq: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of the pair at each place or a large number, pairs by falling frequency)."""
    a, b = seq[:-1], seq[1:]
    cell = _cells(a, b)
    busy = np.bincount(cell, minlength=1 << _HASH_BITS) >= least
    where = np.flatnonzero(busy[cell])
    code = (a[where].astype(np.uint64) << np.uint64(32)) | b[where]
    # sorted values alone: an order or an inverse of every place would cost several times as much
    ordered = np.sort(code)
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
    counts = np.diff(np.append(begins, len(ordered)))
    often = counts >= least
    pairs, counts = ordered[begins[often]], counts[often]
    pairs = pairs[np.argsort(-counts, kind="stable")]
    rank = np.full(len(a), np.iinfo(np.int32).max, np.int32)
    # a cell names one of its frequent pairs; the places of the others of a shared cell are searched for
    cell = cell[where]
    home = _cells((pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32))
    tenant = np.full(1 << _HASH_BITS, -1, np.int32)
    tenant[home] = np.arange(len(pairs), dtype=np.int32)
    guess = tenant[cell]
    some = np.flatnonzero(guess >= 0)
    right = pairs[guess[some]] == code[some]
    rank[where[some[right]]] = guess[some[right]]
    if len(pairs) > np.count_nonzero(tenant >= 0):
        shared = np.zeros(1 << _HASH_BITS, bool)
        shared[home[tenant[home] != np.arange(len(pairs))]] = True
        rest = some[~right]
        rest = rest[shared[cell[rest]]]
        by_code = np.argsort(pairs)
        at = np.minimum(np.searchsorted(pairs, code[rest], sorter=by_code), len(pairs) - 1)
        found = pairs[by_code[at]] == code[rest]
        rank[where[rest[found]]] = by_code[at[found]]
    return rank, pairs


def compress(ids: np.ndarray, base: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rules[k] is the pair that symbol ``base + k`` stands for."""
    seq, rules, free = ids.astype(np.uint32), [], (1 << 16) - base
    none = np.iinfo(np.int32).max
    made = 0
    while len(seq) > 1 and made < free:
        rank, pairs = _frequent_pairs(seq, least)
        rank[rank >= free - made] = none
        again = np.flatnonzero((rank[1:] == rank[:-1]) & (rank[1:] != none)) + 1   # aaa...: every second place
        if len(again):
            fresh = np.flatnonzero(np.diff(again, prepend=-2) > 1)
            nth = np.arange(len(again)) - np.repeat(fresh, np.diff(np.append(fresh, len(again))))
            rank[again[nth % 2 == 0]] = none
        left = np.concatenate([[none], rank[:-1]])
        right = np.concatenate([rank[1:], [none]])
        take = np.flatnonzero((rank < left) & (rank <= right) & (rank != none))
        uses = np.bincount(rank[take], minlength=min(len(pairs), free - made)) if len(take) else np.zeros(0, int)
        paying = uses >= max(2, least // 2)
        take = take[paying[rank[take]]] if len(take) else take
        if len(take) < LEAST_GAIN * len(seq):
            break
        number = np.cumsum(paying) - 1
        seq[take] = (base + made + number[rank[take]]).astype(np.uint32)
        stay = np.ones(len(seq), bool)
        stay[take + 1] = False
        seq = seq[stay]
        new = pairs[np.flatnonzero(paying)]
        rules.append(np.stack([(new >> np.uint64(32)).astype(np.uint32), new.astype(np.uint32)], axis=1))
        made += len(new)
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids each nonterminal stands for; a rule only names symbols made before it."""
    lengths = np.zeros(len(rules), np.uint32)
    todo = np.ones(len(rules), bool)
    while todo.any():
        part = np.where(rules < base, 1, 0).astype(np.uint32)
        named = rules >= base
        part[named] = lengths[rules[named] - base]
        ready = todo & (part > 0).all(axis=1)
        lengths[ready] = part[ready].sum(axis=1)
        todo &= ~ready
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    seq = symbols.astype(np.uint32)
    while (named := seq >= base).any():
        size = 1 + named
        place = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        out[place[~named]] = seq[~named]
        pair = rules[seq[named] - base]
        out[place[named]] = pair[:, 0]
        out[place[named] + 1] = pair[:, 1]
        seq = out
    return seq


def _loaded(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    return np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2"), rules, np.frombuffer(row["lengths"], "<u4")


def read_range(row: dict, start: int, n: int) -> np.ndarray:
    """ids [start, start + n) of a stored shard, expanding only the symbols that cover them."""
    symbols, rules, lengths = _loaded(row)
    base = row["base"]
    size = np.ones(len(symbols), np.int64)
    named = symbols >= base
    size[named] = lengths[symbols[named] - base]
    ends = np.cumsum(size)
    lo = int(np.searchsorted(ends, start, "right"))
    hi = int(np.searchsorted(ends, start + n, "left")) + 1
    skip = start - (int(ends[lo - 1]) if lo else 0)
    return expand(symbols[lo:hi], rules, base)[skip:skip + n]


def _shard_row(part: int, shard: int, base: int, doc_ids: list, counts: list, ids: np.ndarray) -> pa.RecordBatch:
    symbols, rules = compress(ids, base)
    wide = bool(len(symbols) and symbols.max() >= 1 << 16)
    row = {"part": part, "shard": shard, "doc_ids": doc_ids, "doc_tokens": counts,
           "rules": rules.astype("<u4").tobytes(), "lengths": rule_lengths(rules, base).astype("<u4").tobytes(),
           "symbols": symbols.astype("<u4" if wide else "<u2").tobytes(), "wide": wide,
           "n_tokens": len(ids), "base": base}
    return pa.RecordBatch.from_pylist([row], schema=pa.schema([
        ("part", pa.int64()), ("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())), ("rules", pa.binary()), ("lengths", pa.binary()),
        ("symbols", pa.binary()), ("wide", pa.bool_()), ("n_tokens", pa.int64()), ("base", pa.int64())]))


def _writer(path: str, end_id: int, shard_tokens: int):
    def write(batches):
        part = TaskContext.get().partitionId()
        base = T.encoder(path).tokenizer.get_vocab_size()
        docs, counts, ids, held, shard = [], [], [], 0, 0
        for doc_ids, flat, sizes in T.encoded_batches(batches, path, end_id):
            ends, at, done = np.cumsum(sizes), 0, 0
            while at < len(sizes):                         # up to the document that fills the shard
                to = min(int(np.searchsorted(ends, done + shard_tokens - held)) + 1, len(sizes))
                docs += doc_ids.slice(at, to - at).to_pylist()
                counts += sizes[at:to].tolist()
                ids.append(flat[done:ends[to - 1]])
                held += int(ends[to - 1]) - done
                at, done = to, int(ends[to - 1])
                if held >= shard_tokens:
                    yield _shard_row(part, shard, base, docs, counts, np.concatenate(ids))
                    docs, counts, ids, held, shard = [], [], [], 0, shard + 1
        if docs:
            yield _shard_row(part, shard, base, docs, counts, np.concatenate(ids))
    return write


def write_tokens(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> None:
    """Encodes, compresses and writes all documents as shards under ``out``."""
    C.prepare(docs.sparkSession)
    path = path or T.vocabulary_path()
    shards = T.in_order(docs, partitions).mapInArrow(_writer(path, end_id, shard_tokens), SCHEMA)
    with C.shuffle_cleanup(docs.sparkSession):
        shards.write.mode("overwrite").parquet(out)


def _decode(batches):
    for batch in batches:
        for row in batch.to_pylist():
            symbols, rules, _ = _loaded(row)
            ids = expand(symbols, rules, row["base"])
            ends = np.cumsum(row["doc_tokens"])
            bounds = np.concatenate([[0], ends]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + bounds[:-1]),
                pa.array(np.diff(bounds)), T.binary_slices(ids, bounds)],
                names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark, out: str) -> DataFrame:
    """The documents back from the files: doc_id, start, n_tokens, ids."""
    C.prepare(spark)
    shards = spark.read.schema(SCHEMA).parquet(out)
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(parts_before), F.lit(0)).alias("parts_before")))
    offsets = (shards.select("part", "shard", "n_tokens")
               .withColumn("in_part", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
               .join(parts, "part").select("part", "shard", (F.col("in_part") + F.col("parts_before")).alias("before")))
    if shards.count() <= BROADCAST_SHARDS:                 # one row a shard, counted here
        offsets = F.broadcast(offsets)
    return (shards.join(offsets, ["part", "shard"])
            .mapInArrow(_decode, "doc_id long, start long, n_tokens long, ids binary"))


def query(spark, sf_dir: str) -> DataFrame:
    out = C.scratch(spark, "tokens")
    write_tokens(C.documents(spark, sf_dir), out)
    return read_tokens(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
