"""Secret scans: a linear-chain conditional random field over words.

Every whole text is tagged word by word as secret begin, inside or outside.
Features are categories: the word's shape (length, digits, capitals, symbols),
how often its characters change class, ``:`` or ``=`` inside it, what the word
before announces (a key word, a colon), the shape of the word after, and how
much the document looks like code. The best tag path is found by Viterbi; a
word whose outside score leads by more than any neighbouring tags can make up
is outside on every best path, so only the stretches between such words are
decoded, with the same result.

Three fixed patterns give the base spans, which always stay (``BASE``); the
field adds ``crf`` spans where a tagged word touches none of them.

Training: at most ``FIT_DOCS`` documents, drawn from all documents in two
strata by the smallest text hashes: those with a base span in their share of
the table, ``FIT_POSITIVE`` at least if there are so many, and those without.
Words touched by base spans are the positive labels, words of unusual shape
around them and elsewhere the negatives. Only where no document of the whole
table has a base span nothing is added.

Spans are in code points, end exclusive. Defined cases: a null or empty text
has no span; a text may be one huge word; equal rows give equal spans; an
empty table gives an empty result; extra columns are carried.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, functions as F, types as T

from . import common as C
from . import textkit as K

FIT_DOCS = 6000
FIT_POSITIVE = 300             # of these at least, if there are so many, with a base span
FIT_SEGMENTS = 2500            # training stretches kept of those documents, positive ones first
REACH = 8                      # words on either side of a training stretch's centre
LEAST_MARGIN = 2.0             # score a secret tag must gain over outside
MASK = "[SECRET]"
# Patterns of the base kinds, in order, and words that announce a secret.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KEY_WORDS = ("password", "passwd", "pwd", "pass", "passphrase", "secret", "token", "apikey", "api_key", "api-key",
             "access_key", "key", "auth", "authorization", "bearer", "credential", "credentials", "private_key")
KINDS = ("assign", "access", "hex", "crf")
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
_SIZES = (8 * 27, 8 * 5, 3, 5, 4, 4)      # categories of each feature
_EDGE = b"\"'`()[]{}<>,;:."
_FIELD = np.uint64(21)


def _matches(text: str) -> list[tuple[re.Match, int]]:
    out = []
    folded = text.lower()
    if any(stem in folded for stem in ASSIGN_STEMS):
        out += [(m, 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m, 1) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    return out + [(m, 2) for m in HEX.finditer(text)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the three patterns, leftmost and non-overlapping per kind."""
    return [(*m.span(), kind) for m, kind in _matches(text)]


def _secret_parts(text: str) -> list[tuple[int, int, int]]:
    """The secrets themselves, without the words that announce them: what the field learns to tag."""
    return [(*(m.span(2) if kind == 0 else m.span()), kind) for m, kind in _matches(text)]


def _class_tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(256, 3, np.int8)                        # 0 lower or non-ASCII, 1 upper, 2 digit, 3 symbol
    kind[97:123] = 0
    kind[128:] = 0
    kind[65:91] = 1
    kind[48:58] = 2
    packed = np.zeros(256, np.uint64)
    packed[kind == 1] = 1
    packed[kind == 2] = np.uint64(1) << _FIELD
    packed[kind == 3] = np.uint64(1) << (_FIELD * np.uint64(2))
    return kind, packed


_CLASS, _PACKED = _class_tables()
_ASSIGNS = np.zeros(256, bool)
_ASSIGNS[[58, 61]] = True
_CODE = np.zeros(256, bool)
_CODE[list(b"{}<>=;$#|\\")] = True
_LENGTH_EDGES = np.array([4, 8, 12, 16, 20, 24, 32])
_KEY_HASHES = np.sort(K.word_hashes(list(KEY_WORDS)))


def _sums(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def word_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[K.Words, np.ndarray]:
    """Words of a block and their categories, one column a feature."""
    offsets = offsets - offsets[0]
    words = K.Words(buf, offsets, lower=True)
    s, e = words.start, words.end
    n = len(s)
    length = e - s
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_PACKED[buf], out=run[1:])
    packed = run[e] - run[s]
    field = (np.uint64(1) << _FIELD) - np.uint64(1)
    upper = (packed & field).astype(np.int64)
    digit = ((packed >> _FIELD) & field).astype(np.int64)
    symbol = (packed >> (_FIELD * np.uint64(2))).astype(np.int64)
    kind = _CLASS[buf]
    change = _sums(np.concatenate(([False], kind[1:] != kind[:-1]))) if len(buf) else np.zeros(1, np.int64)
    changes = np.maximum(change[e] - change[np.minimum(s + 1, len(change) - 1)], 0)
    size = np.searchsorted(_LENGTH_EDGES, length, "right")
    shape = ((size * 3 + np.where(digit == 0, 0, np.where(2 * digit < length, 1, 2))) * 3
             + np.minimum(upper, 2)) * 3 + np.minimum(symbol, 2)
    rate = np.searchsorted(np.array([0.001, 0.1, 0.2, 0.35]), changes / np.maximum(length, 1), "right")
    assigns = _sums(_ASSIGNS[buf])
    inside = np.minimum(assigns[e] - assigns[s], 2)
    announces = _ASSIGNS[buf[e - 1]] if n else np.zeros(0, bool)
    quoted = (buf[s] == 34) | (buf[s] == 39) if n else np.zeros(0, bool)
    core = words.bytes_hash(np.minimum(s + quoted, e), np.maximum(e - announces, np.minimum(s + quoted, e)))
    found = np.searchsorted(_KEY_HASHES, core)
    key = _KEY_HASHES[np.minimum(found, len(_KEY_HASHES) - 1)] == core
    cue = announces * 1 + key * 2
    before = np.full(n, 4)
    before[1:] = cue[:-1]
    opening = words.first[:-1][np.diff(words.first) > 0]
    before[opening] = 4
    odd = np.where((digit > 0) & (length >= 8), 2, np.where((digit > 0) | (upper > 1), 1, 0))
    after = np.full(n, 3)
    after[:-1] = odd[1:]
    after[words.first[1:][np.diff(words.first) > 0] - 1] = 3
    code = _sums(_CODE[buf])
    per_doc = (code[offsets[1:]] - code[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)
    look = np.repeat(np.searchsorted(np.array([1e-6, 0.002, 0.01]), per_doc, "right"), words.counts())
    return words, np.stack([shape, size * 5 + rate, inside, before, after, look], axis=1).astype(np.int16)


class Field:
    """Weights per feature category and tag, and between neighbouring tags."""

    def __init__(self):
        self.weights = [np.zeros((n, 3)) for n in _SIZES]
        self.moves = np.zeros((3, 3))
        self.moves[OUTSIDE, INSIDE] = -4.0

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((*features.shape[:-1], 3))
        for k, w in enumerate(self.weights):
            out += w[features[..., k]]
        return out

    def train(self, features: np.ndarray, tags: np.ndarray, mask: np.ndarray,
              rounds: int = 60, rate: float = 0.25, decay: float = 2e-4) -> None:
        """Maximum likelihood by Adam; stretches (S, T, features), tags (S, T), mask of real words."""
        params = [*self.weights, self.moves]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            for p, g, m, v in zip(params, self._gradient(features, tags, mask), first, second):
                g = g / len(tags) + decay * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def _gradient(self, features, tags, mask):
        emit = self.scores(features)
        s, t, _ = emit.shape
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[:, 0] = emit[:, 0]
        for i in range(1, t):
            new = _logsum(forward[:, i - 1, :, None] + self.moves, 1) + emit[:, i]
            forward[:, i] = np.where(mask[:, i, None], new, forward[:, i - 1])
        for i in range(t - 2, -1, -1):
            new = _logsum(self.moves + (emit[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
            backward[:, i] = np.where(mask[:, i + 1, None], new, 0.0)
        total = _logsum(forward[:, -1], 1)
        belief = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        belief[np.arange(s)[:, None], np.arange(t)[None], tags] -= mask
        grads = []
        flat, error = features.reshape(-1, features.shape[-1]), belief.reshape(-1, 3)
        for k, w in enumerate(self.weights):
            grads.append(np.stack([np.bincount(flat[:, k], weights=error[:, y], minlength=len(w)) for y in range(3)], 1))
        moves = np.zeros((3, 3))
        both = (mask[:, 1:] & mask[:, :-1]).astype(float)
        for i in range(t - 1):
            pair = np.exp(forward[:, i, :, None] + self.moves + (emit[:, i + 1] + backward[:, i + 1])[:, None, :]
                          - total[:, None, None])
            moves += (pair * both[:, i, None, None]).sum(axis=0)
            np.add.at(moves, (tags[:, i], tags[:, i + 1]), -both[:, i])
        return [*grads, moves]

    def _gains(self) -> np.ndarray:
        """Per tag, the most that a path can gain in its moves by this tag instead of outside."""
        enter = np.append((self.moves - self.moves[:, :1]).max(axis=0)[None], np.zeros((1, 3)), axis=0)
        leave = np.append((self.moves - self.moves[:1]).max(axis=1)[None], np.zeros((1, 3)), axis=0)
        return enter.max(axis=0) + leave.max(axis=0)

    def decode(self, scores: np.ndarray, first: np.ndarray, margin: float) -> np.ndarray:
        """Best tags per document; ``margin`` is taken off the secret tags."""
        scores = scores.copy()
        scores[:, 1:] -= margin
        doubtful = np.flatnonzero((scores[:, :1] - scores <= self._gains())[:, 1:].any(axis=1))
        tags = np.zeros(len(scores), np.int8)
        if not len(doubtful):
            return tags
        doc = np.searchsorted(first, doubtful, "right")
        cut = np.flatnonzero((np.diff(doubtful) > 1) | (np.diff(doc) > 0)) + 1
        moves = self.moves.tolist()
        for part in np.split(doubtful, cut):
            lo, hi = int(part[0]), int(part[-1]) + 1
            tags[lo:hi] = _viterbi(scores[lo:hi].tolist(), moves, lo not in first, hi not in first)
        return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _viterbi(scores: list, moves: list, after_outside: bool, before_outside: bool) -> list[int]:
    """Best path of one stretch; its neighbours in the document, if any, are outside."""
    best = [s + (moves[OUTSIDE][y] if after_outside else 0.0) for y, s in enumerate(scores[0])]
    back = []
    for row in scores[1:]:
        come = [max(range(3), key=lambda a: best[a] + moves[a][y]) for y in range(3)]
        best = [best[come[y]] + moves[come[y]][y] + row[y] for y in range(3)]
        back.append(come)
    if before_outside:
        best = [b + moves[y][OUTSIDE] for y, b in enumerate(best)]
    path = [max(range(3), key=best.__getitem__)]
    for come in reversed(back):
        path.append(come[path[-1]])
    return path[::-1]


def _byte_places(text: str, raw: bytes, spans) -> list[tuple[int, int]]:
    if len(raw) == len(text):
        return [(a, b) for a, b, _ in spans]
    return [(len(text[:a].encode()), len(text[:b].encode())) for a, b, _ in spans]


def _label_words(words: K.Words, d: int, offset: int, places) -> np.ndarray:
    """Tags of document d's words from its base spans (bytes within the document)."""
    lo, hi = words.first[d], words.first[d + 1]
    tags = np.zeros(hi - lo, np.int8)
    start, end = words.start[lo:hi] - offset, words.end[lo:hi] - offset
    for a, b in sorted(places):
        i, j = int(np.searchsorted(end, a, "right")), int(np.searchsorted(start, b, "left"))
        if j > i:
            tags[i:j] = INSIDE
            tags[i] = BEGIN
    return tags


def _stretches(batches):
    """Training stretches: categories and tags around unusual words, a few more anywhere."""
    width = 2 * REACH + 1
    for batch in batches:
        texts = batch.column("text").to_pylist()
        buf, off = K.utf8(batch.column("text"))
        rows = {"x": [], "y": [], "positive": [], "h": []}
        hashes = batch.column("h").to_pylist()
        for i, j in K.blocks(off):
            words, features = word_features(buf[off[i]:off[j]], off[i:j + 1])
            for d in range(j - i):
                text = texts[i + d] or ""
                lo, hi = words.first[d], words.first[d + 1]
                if hi == lo:
                    continue
                places = _byte_places(text, text.encode(), _secret_parts(text))
                tags = _label_words(words, d, off[i + d] - off[i], places)
                odd = np.flatnonzero((tags > 0) | (features[lo:hi, 0] // 9 % 3 > 0) | (features[lo:hi, 1] % 5 > 2))
                centres = odd[:: max(1, len(odd) // 6)].tolist() + [hashes[i + d] % (hi - lo)]
                if tags.any() and not any(tags[max(0, c - REACH):max(0, c - REACH) + width].any() for c in centres):
                    centres.append(int(tags.argmax()))
                for c in centres:
                    a = max(0, c - REACH)
                    x = features[lo + a:min(lo + a + width, hi)]
                    y = tags[a:a + width]
                    rows["x"].append(x.astype("<i2").tobytes())
                    rows["y"].append(y.tobytes())
                    rows["positive"].append(bool(y.any()))
                    rows["h"].append(hashes[i + d])
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
            ("x", pa.binary()), ("y", pa.binary()), ("positive", pa.bool_()), ("h", pa.int64())]))


def _with_base_spans(batches):
    """Text hashes of the documents with a base span, and of the few that may be drawn without one."""
    for batch in batches:
        found = [bool(_matches(t)) for t in batch.column("text").to_pylist()]
        rows = pa.RecordBatch.from_arrays([batch.column("h"), pa.array(found, pa.bool_())], names=["h", "positive"])
        yield rows.filter(pa.compute.or_(rows.column("positive"), batch.column("near")))


def sample(docs: DataFrame, fit_docs: int = FIT_DOCS, least: int = FIT_POSITIVE) -> DataFrame:
    """h, text: the documents to learn from, with and without a base span."""
    rows = docs.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("h"))
    n = docs.select("text").count()
    unit = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)

    def share(wanted, there):
        return unit < min(1.0, 2.0 * wanted / max(1, there))

    hashes = C.store(rows.withColumn("near", share(fit_docs, n)).mapInArrow(
        _with_base_spans, "h long, positive boolean").distinct(), "base-spans")
    positive = hashes.filter("positive").count()
    quota = min(positive, fit_docs, max(min(least, (fit_docs + 1) // 2), fit_docs * positive // max(1, n)))
    chosen = (hashes.filter(F.col("positive") & share(quota, positive)).select("h").orderBy("h").limit(quota)
              .unionByName(hashes.filter(~F.col("positive") & share(fit_docs, n)).select("h").orderBy("h")
                           .limit(fit_docs - quota)))
    chosen = docs.sparkSession.createDataFrame(chosen.collect(), "h long")      # fit_docs hashes at most
    return rows.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, segments: int = FIT_SEGMENTS) -> Field | None:
    C.prepare(docs.sparkSession)
    near = sample(docs, fit_docs)
    got = (near.mapInArrow(_stretches, "x binary, y binary, positive boolean, h long")
           .orderBy(F.desc("positive"), "h", "x").limit(segments).collect())
    if not any(r["positive"] for r in got):
        return None
    width = 2 * REACH + 1
    x = np.zeros((len(got), width, len(_SIZES)), np.int64)
    y, mask = np.zeros((len(got), width), np.int64), np.zeros((len(got), width), bool)
    for k, r in enumerate(got):
        tags = np.frombuffer(r["y"], np.int8)
        x[k, :len(tags)] = np.frombuffer(r["x"], "<i2").reshape(len(tags), -1)
        y[k, :len(tags)], mask[k, :len(tags)] = tags, True
    field = Field()
    field.train(x, y, mask)
    return field


def added_spans(field: Field, words: K.Words, tags: np.ndarray, d: int, raw: bytes, offset: int,
                taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans of document d's tagged words, edges trimmed, that touch no taken span."""
    lo, hi = words.first[d], words.first[d + 1]
    out, open_span = [], None
    for k in np.flatnonzero(tags[lo:hi]) + lo:
        a, b = int(words.start[k]) - offset, int(words.end[k]) - offset
        while a < b and raw[a] in _EDGE:
            a += 1
        while a < b and raw[b - 1] in _EDGE:
            b -= 1
        if a == b or any(a < y and x < b for x, y in taken):
            open_span = None
            continue
        if tags[k] == INSIDE and open_span == k - 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        open_span = k
    return out


def _scanner(shared, margin: float, mask: str | None):
    def scan(batches):
        field = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            buf, off = K.utf8(batch.column("text"))
            found, masked = [], []
            for i, j in K.blocks(off):
                block = buf[off[i]:off[j]]
                tagged = np.zeros(j - i, bool)
                if field is not None:
                    words, features = word_features(block, off[i:j + 1])
                    tags = field.decode(field.scores(features), words.first, margin)
                    tagged[np.searchsorted(words.first, np.flatnonzero(tags), "right") - 1] = True
                for d in range(j - i):
                    text = texts[i + d] or ""
                    spans = base_spans(text)
                    if tagged[d]:
                        raw = text.encode()
                        more = added_spans(field, words, tags, d, raw, int(off[i + d] - off[i]),
                                           _byte_places(text, raw, spans))
                        spans += [(len(raw[:a].decode()), len(raw[:b].decode()), 3) for a, b in more]
                    spans.sort(key=lambda s: (s[0], s[2], s[1]))
                    found.append([{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans])
                    if mask is not None:
                        masked.append(_masked(texts[i + d], spans, mask))
            columns = [batch.column("record"), pa.array(found, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
            names = ["record", "found"]
            if mask is not None:
                columns.append(pa.array(masked, pa.string()))
                names.append("masked")
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return scan


def _masked(text: str | None, spans: list[tuple[int, int, int]], mask: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, field: Field | None, keep: list[str] | None = None,
         margin: float = LEAST_MARGIN, mask: str | None = None) -> DataFrame:
    """record (the columns ``keep``, default all), found (spans in order) and, given a mask, the masked text."""
    spark = docs.sparkSession
    C.prepare(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("record"), F.col("text"))
    schema = rows.select("record").schema.add("found", SPAN)
    if mask is not None:
        schema = schema.add("masked", "string")
    return rows.mapInArrow(_scanner(spark.sparkContext.broadcast(field), margin, mask), schema)


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """The same rows and columns with every span of the text replaced by ``mask``; ``n_chars`` follows the text."""
    out = scan(docs, fit(docs), mask=mask)
    record = F.col("record").withField("text", F.col("masked"))
    if "n_chars" in docs.columns:
        record = F.when(F.size("found") > 0, record.withField(
            "n_chars", F.char_length("masked").cast(docs.schema["n_chars"].dataType))).otherwise(record)
    return out.select(record.alias("record")).select("record.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    out = scan(docs, fit(docs), ["doc_id"])

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != "crf")
    return out.select(F.col("record.doc_id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                      F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
