"""Spelling variant grouping with blocked Gram matrices of letter counts.

1. Words are counted with built-in functions: maximal letter runs of every whole
   text, only A-Z lower-cased. A run whose checksum with the document's id is a
   multiple of ``MISSPELL`` loses one letter first (the planted misspellings of
   the contract). Words of at least ``LEAST_LETTERS`` letters that occur at
   least twice go on, one row a word.
2. Two words are near if they differ by one inserted, deleted or replaced
   letter. Their common prefix and suffix then cover all but one letter of the
   shorter word of m letters, so with a = (m - 1) // 3 they agree in the first
   2a letters, or in the last 2a, or in the first a and the last a. Each word
   goes under these three keys for m = its own length and for m = one less:
   blocks of the lengths m and m + 1.
3. Within a block the product of the letter-count rows of its shorter words with
   those of all its words (a Gram matrix) gives all squared distances of the
   counts at once. One edit changes them by 1 or 2, so pairs at 1 or 2 are kept,
   and their letters are compared: prefix and suffix must leave at most the one
   edit. A pair is reported under the first of its keys only.
4. A block of more than ``TILE_LETTERS`` letters is cut into tiles by a hash of
   the word; every pair of tiles is a task group of its own, so no task holds
   more than two tiles however many words share a key. No pair is left out.
5. A word's form is its near word of largest count, if that is at least
   ``RATIO`` times its own. Chains of forms are followed by pointer jumping;
   counts grow tenfold a step, so chains are short.

Defined cases: null and empty texts give no words; a null doc_id counts as
empty text in the checksum; a run of one letter that loses it gives no word;
words of millions of letters are compared like others; repeated rows count each
time; ties of count go to the word smallest in code-point order; an empty table
gives an empty result; extra columns do not matter.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MISSPELL = 31
LEAST_LETTERS = 7
LEAST_TIMES = 2
RATIO = 10
TILE_LETTERS = 1 << 16         # letters of a tile; a block of more is cut
CHUNK_LETTERS = 1 << 19        # letters of the blocks that a task multiplies at a time
GRAM_CELLS = 1 << 21           # distances of equally shaped blocks held at a time
SINGLE_LETTERS = 2000          # words so long are multiplied in double precision
ROWS_AT_A_TIME = 20_000


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES,
                misspell: int = MISSPELL) -> DataFrame:
    """word, n: the words of all texts, after the planted misspellings."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]+)"))).alias("run"))
    runs = runs.filter(F.length("run") >= least_letters).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    told = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    sums = runs.select("run", F.crc32(told.cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = sums.select(F.when(F.col("h") % misspell == 0, short).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_times))


def _keys(word: Column, length: Column, m: Column) -> list[Column]:
    a = F.floor((m - 1) / 3).cast("int")
    head, tail = word.substr(F.lit(1), a), word.substr(length - a + 1, a)
    return [F.xxhash64(m, F.lit(0), word.substr(F.lit(1), 2 * a)),
            F.xxhash64(m, F.lit(1), word.substr(length - 2 * a + 1, 2 * a)),
            F.xxhash64(m, F.lit(2), head, F.lit(" "), tail)]


def block_rows(words: DataFrame, least_letters: int = LEAST_LETTERS, tile_letters: int = TILE_LETTERS) -> DataFrame:
    """m, key, tile, word, n, short (asks), asked: the rows of all blocks that can hold a pair.

    ``m`` is the length of the block's shorter words; rows of m letters ask,
    all rows are asked. Blocks without a pair (one row, or no shorter word) are
    left out; a block of several tiles has one group per pair of them.
    """
    length = F.length("word")
    own = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key"))
                              for k, c in enumerate(_keys(F.col("word"), length, F.col("m")))]))
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).filter(
        F.col("m") >= least_letters).select("m", "word", "n", own.alias("k")).select(
        "m", F.col("k.kind").alias("kind"), F.col("k.key").alias("key"), "word", "n")
    sizes = rows.groupBy("m", "kind", "key").agg(
        F.count("*").alias("rows"), F.count_if(F.length("word") == F.col("m")).alias("shorter"),
        F.sum(F.length("word")).alias("letters")).filter("rows > 1 and shorter > 0")
    sizes = sizes.select("m", "kind", "key", F.ceil(F.col("letters") / tile_letters).cast("int").alias("tiles"))
    rows = rows.join(sizes, ["m", "kind", "key"])
    tile = F.pmod(F.xxhash64("word", F.lit(7)), F.col("tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    short = F.length("word") == F.col("m")
    as_both = F.array(F.struct(F.lit(0).alias("tile"), short.alias("short"), F.lit(True).alias("asked")))
    asking = F.transform(F.when(short, others).otherwise(F.array()), lambda j: F.struct(
        (tile * F.col("tiles") + j).alias("tile"), F.lit(True).alias("short"), F.lit(False).alias("asked")))
    asked = F.transform(others, lambda i: F.struct(
        (i * F.col("tiles") + tile).alias("tile"), F.lit(False).alias("short"), F.lit(True).alias("asked")))
    copies = F.when(F.col("tiles") == 1, as_both).otherwise(F.concat(asking, asked))
    return rows.select("m", "kind", "key", "word", "n", F.explode(copies).alias("c")).select(
        "m", "kind", "key", "c.tile", "word", "n", "c.short", "c.asked")


def letter_rows(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, letters padded with 0 on the right, counts a letter) of words of m or m + 1 letters."""
    text = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(size) - size
    codes = np.zeros((len(words), m + 1), np.uint8)
    codes[np.repeat(np.arange(len(words)), size), np.arange(len(text)) - np.repeat(begin, size)] = text
    column = np.where(text < 0xC0, text - 97, text.astype(np.int64) - 0xC0 + 26)
    counts = np.bincount(np.repeat(np.arange(len(words)), size) * 90 + column, minlength=len(words) * 90)
    # squares of the counts of long words are beyond what single precision holds exactly
    return size, codes, counts.reshape(-1, 90).astype(np.float32 if m < SINGLE_LETTERS else np.float64)


def gram_pairs(groups: np.ndarray, short: np.ndarray, asked: np.ndarray, counts: np.ndarray
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row that asks, row asked) of one group whose letter counts are at squared distance 1 or 2.

    Blocks of the same shape are multiplied together, at most ``GRAM_CELLS``
    distances at a time.
    """
    norm = np.einsum("ij,ij->i", counts, counts)
    ask, answer = np.flatnonzero(short), np.flatnonzero(asked)
    kinds = int(groups[-1]) + 1 if len(groups) else 0
    p, q = np.bincount(groups[ask], minlength=kinds), np.bincount(groups[answer], minlength=kinds)
    p_first, q_first = np.cumsum(p) - p, np.cumsum(q) - q
    shapes, which = np.unique(np.stack([p, q]), axis=1, return_inverse=True)
    which = which.reshape(-1)
    for s, (a, b) in enumerate(shapes.T):
        if not a or not b:
            continue
        members = np.flatnonzero(which == s)
        wide = max(1, GRAM_CELLS // int(b))             # rows that ask at a time
        step = max(1, wide // int(a))
        for at in range(0, len(members), step):
            some = members[at:at + step]
            cols = answer[q_first[some][:, None] + np.arange(b)]
            for low in range(0, int(a), wide):
                rows = ask[p_first[some][:, None] + np.arange(low, min(int(a), low + wide))]
                gram = np.matmul(counts[rows], counts[cols].transpose(0, 2, 1))
                far = norm[rows][:, :, None] + norm[cols][:, None, :] - 2 * gram
                g, i, j = np.nonzero((far >= 0.5) & (far <= 2.5))
                yield rows[g, i], cols[g, j]


def one_edit(size: np.ndarray, codes: np.ndarray, a: np.ndarray, b: np.ndarray, kind: np.ndarray, m: int) -> np.ndarray:
    """Which pairs (a of m letters, b of m or m + 1) are one edit apart and first seen under this kind of key."""
    left, right = codes[a], codes[b]
    same = left[:, :m] == right[:, :m]
    prefix = np.where(same.all(axis=1), m, np.argmin(same, axis=1))
    longer = size[b] == m + 1
    back = np.take_along_axis(right, np.arange(m)[None, :] + longer[:, None], axis=1)
    same = (left[:, :m] == back)[:, ::-1]
    suffix = np.where(same.all(axis=1), m, np.argmin(same, axis=1))
    third = (m - 1) // 3
    first = np.where(prefix >= 2 * third, 0, np.where(suffix >= 2 * third, 1, 2))
    return (prefix + suffix >= m - 1 + longer) & (prefix + suffix < 2 * m + longer) & (first == kind)


def near_pairs(blocks: DataFrame) -> DataFrame:
    """word, n, near, near_n: every near pair once (either way round)."""
    names = ["word", "n", "near", "near_n"]

    def find(m: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        words = table.column("word").to_pylist()
        n, kind = table.column("n").to_numpy(), table.column("kind").to_numpy()
        short = table.column("short").to_numpy(zero_copy_only=False)
        asked = table.column("asked").to_numpy(zero_copy_only=False)
        marks = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("kind", "key", "tile")])
        new = np.concatenate(([True], (marks[:, 1:] != marks[:, :-1]).any(axis=0)))
        size, codes, counts = letter_rows(words, m)
        found = []
        for a, b in gram_pairs(np.cumsum(new) - 1, short, asked, counts):
            # both of m letters: the pair is met both ways round, the first by order stands for it
            once = (size[b] > m) | np.array([words[x] < words[y] for x, y in zip(a, b)], bool)
            a, b = a[once], b[once]
            near = one_edit(size, codes, a, b, kind[a], m)
            found.append((a[near], b[near]))
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        column = table.column("word")
        return pa.RecordBatch.from_arrays(
            [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
             for x in (column.take(pa.array(a)), pa.array(n[a]), column.take(pa.array(b)), pa.array(n[b]))], names=names)

    def rows(batches):
        held, letters, m, last = [], 0, None, None

        def group(batch, k):
            return tuple(batch.column(c)[k].as_py() for c in ("m", "kind", "key", "tile"))

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("m", "kind", "key", "tile")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            cuts = np.concatenate(([0], cuts, [batch.num_rows]))
            size = np.concatenate(([0], np.cumsum(marks[0] + 1)))
            at = 0                                                    # rows before it are held or done
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                begins = lo > 0 or group(batch, 0) != last
                if begins and (held or lo > at) and (
                        marks[0, lo] != m or letters + size[lo] - size[at] >= CHUNK_LETTERS):
                    if lo > at:
                        held.append(batch.slice(at, lo - at))
                    yield find(m, held)
                    held, letters, at = [], 0, lo
                m = int(marks[0, lo])
            held.append(batch.slice(at))
            letters += int(size[-1] - size[at])
            last = group(batch, batch.num_rows - 1)
        if held:
            yield find(m, held)

    parts = C.parallelism(blocks.sparkSession)
    return (blocks.repartition(parts, "m", "kind", "key", "tile").sortWithinPartitions("m", "kind", "key", "tile")
            .mapInArrow(rows, "word string, n long, near string, near_n long"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms, by pointer jumping."""
    roots = C.store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = roots.join(step, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        longer = C.store(longer, "roots")
        moved = longer.filter("moved").limit(1).count()
        C.drop_stored(roots.sparkSession, roots)
        roots = longer.select("word", "root")
        if not moved:
            return roots


def group_variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES,
                   ratio: int = RATIO, misspell: int = MISSPELL, tile_letters: int = TILE_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word."""
    spark = docs.sparkSession
    C.prepare(spark)
    words = C.store(word_counts(docs.select("doc_id", "text"), least_letters, least_times, misspell), "words")
    pairs = C.store(near_pairs(block_rows(words, least_letters, tile_letters)), "near", ROWS_AT_A_TIME)
    both = pairs.select(F.explode(F.array(
        F.struct("word", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")
    ).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best"))
    told = words.join(best, "word", "left")
    enough = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    told = C.store(told.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(enough, F.col("best.word")).alias("form"),
                               F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    roots = follow_forms(told.filter(F.col("form").isNotNull()))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return group_variants(C.documents(spark, sf_dir))


SQL = r"""
WITH RECURSIVE crc(k, step, c) AS (
  SELECT k, 0, k::UBIGINT FROM range(256) r(k)
  UNION ALL SELECT k, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM crc WHERE step < 8),
codes AS (SELECT list(c ORDER BY k) AS t FROM crc WHERE step = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
long AS (SELECT DISTINCT doc_id, run FROM runs WHERE length(run) >= 7),
bytes AS (
  SELECT doc_id, run, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS b FROM long),
sums AS (
  SELECT doc_id, run, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, b::UBIGINT[]),
    lambda s, x: xor(s // 256, t[(xor(s % 256, x) + 1)::BIGINT]))) AS h FROM bytes, codes),
cut AS (
  SELECT doc_id, run, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                           ELSE run END AS word FROM sums),
words AS (
  SELECT word, count(*) AS n FROM runs JOIN cut ON runs.run = cut.run AND runs.doc_id IS NOT DISTINCT FROM cut.doc_id
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
holes AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT word, rest FROM holes WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM holes WHERE rest IN (SELECT word FROM words)),
near AS (
  SELECT p.a AS word, p.b AS near, w.n AS near_n,
         row_number() OVER (PARTITION BY p.a ORDER BY w.n DESC, p.b) AS place, count(*) OVER (PARTITION BY p.a) AS n_near
  FROM pairs p JOIN words w ON w.word = p.b),
told AS (
  SELECT w.word, w.n, coalesce(x.n_near, 0) AS n_near, CASE WHEN x.near_n >= 10 * w.n THEN x.near END AS form,
         CASE WHEN x.near_n >= 10 * w.n THEN x.near_n END AS form_n
  FROM words w LEFT JOIN near x ON x.word = w.word AND x.place = 1),
chain(word, upto, step) AS (
  SELECT word, word, 0 FROM told
  UNION ALL SELECT c.word, t.form, c.step + 1 FROM chain c JOIN told t ON t.word = c.upto WHERE t.form IS NOT NULL)
SELECT t.word, t.form, c.root, t.n, t.n_near, t.form_n
FROM told t JOIN (SELECT word, arg_max(upto, step) AS root FROM chain GROUP BY word) c ON c.word = t.word
"""
