"""Conversation structure repair with a grammar-compressed min-plus dynamic programme.

A conversation's roles should read ``(s?(ua)+)?`` (system once at most and
first, then user and assistant in turn). Each row is one symbol: what its role
begins with and its first fault (blank, duplicate, truncated or none). Edits
keep, rerole, delete a row or insert an empty one; the cheapest sequence of
edits (ties: the ASCII-least audit, a string of their initials) is sought.

1. Equal rows of one turn are counted together, so a row repeated millions of
   times is one symbol with a run of forced deletions; a row is a duplicate if
   its role and text occur at an earlier turn, told by an aggregate per
   (conversation, role, text), not by a window over a conversation.
2. Rows are put in order by range over all conversations, so a long one is
   spread over tasks, and cut into segments of at most ``SEGMENT`` symbols.
3. A task compresses all its segments together by Re-Pair: the most frequent
   pair of neighbouring symbols becomes a rule as long as it occurs
   ``LEAST_USES`` times (equal segments once). Each symbol has a 4 x 4 min-plus
   transfer matrix over the states of the grammar (start, after s, after u, after a), each
   entry a cost and an audit rope; a rule's matrix is the product of its two
   parts, computed once, bottom-up, and shared by all conversations of the task.
4. A conversation within one segment is done there; the matrices of longer ones
   are streamed in order and folded. Audits of equal cost between two states have
   the same number of rows and of insertions, so none is a proper prefix of another and the
   least of a product is made of least parts: the fold is exact.
5. The texts are sent once, by conversation and in order, behind the audit, which
   is replayed over them row by row into the repaired text's checksum.

Defined cases: a null in any column reads as one space (a null conv_id is a
conversation of its own, returned as null; a null turn comes first and counts
in no gap); rows of one turn are ordered by role, then by the hash of the text;
the initial of an empty role is nothing, which no grammar accepts; a
conversation without rows left has zeros, an empty audit and the checksum of an
empty text; repeated rows are damaged alike; an empty table gives an empty
result; extra columns do not matter. Texts are told apart by 128-bit hashes.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common as C

SEGMENT = 4096                 # symbols of one segment at most
LEAST_USES = 4                 # a pair that occurs less often gets no rule
HELD_SYMBOLS = 1 << 16         # symbols compressed together
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROWS_AT_A_TIME = 2000          # rows with texts that a task gets at a time
NARROW_ROWS = 20_000           # rows without texts

#: Symbols: role initial s, u, a or other (0 to 3), plus 4 if truncated; a row that must go is 8.
GONE = 8
STATES = 4                     # start, after s, after u, after a
FAR = 1 << 60
_KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
_REROLE = {0: 2, 1: 2, 3: 2, 2: 3}
ROLE_AFTER = {0: "user", 1: "user", 3: "user", 2: "assistant"}


class Matrix:
    """Min-plus transfer matrix: cost and least audit rope from each state to each.

    A rope is a string or a pair of ropes; it is written out only to settle a
    tie and for a result.
    """

    __slots__ = ("cost", "rope", "_text")

    def __init__(self, cost: list[list[int]], rope: list[list]):
        self.cost, self.rope, self._text = cost, rope, {}

    def text(self, i: int, j: int) -> str:
        if (i, j) not in self._text:
            out, stack = [], [self.rope[i][j]]
            while stack:
                top = stack.pop()
                if isinstance(top, str):
                    out.append(top)
                else:
                    left, x, k, right, y, l = top
                    stack += [right.rope[y][l] if (y, l) not in right._text else right._text[y, l],
                              left.rope[x][k] if (x, k) not in left._text else left._text[x, k]]
            self._text[i, j] = "".join(out)
        return self._text[i, j]


def product(a: Matrix, b: Matrix, rows: range = range(STATES)) -> Matrix:
    cost = [[FAR] * STATES for _ in range(STATES)]
    rope: list[list] = [[None] * STATES for _ in range(STATES)]
    for i in rows:
        for j in range(STATES):
            ways = [(a.cost[i][k] + b.cost[k][j], k) for k in range(STATES)]
            least = min(ways)[0]
            if least >= FAR:
                continue
            best = [k for c, k in ways if c == least]
            if len(best) > 1:
                best = [min(best, key=lambda k: a.text(i, k) + b.text(k, j))]
            cost[i][j], rope[i][j] = least, (a, i, best[0], b, best[0], j)
    return Matrix(cost, rope)


def _from_moves(moves: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return Matrix([[moves.get((i, j), (FAR, ""))[0] for j in range(STATES)] for i in range(STATES)],
                  [[moves[i, j][1] if (i, j) in moves else None for j in range(STATES)] for i in range(STATES)])


def insertions() -> Matrix:
    """Any number of insertions: an empty row of the one role that the state allows."""
    moves = {(i, i): (0, "") for i in range(STATES)}
    for i in range(STATES):
        at, n = i, 0
        while (at := _REROLE[at]) != i and (i, at) not in moves:
            n += 1
            moves[i, at] = (INSERT * n, "I" * n)
    return _from_moves(moves)


def symbol_matrix(symbol: int) -> Matrix:
    """Insertions, then the row itself."""
    moves: dict[tuple[int, int], tuple[int, str]] = {(i, i): (DELETE, "D") for i in range(STATES)}

    def offer(i: int, j: int, cost: int, edit: str) -> None:
        moves[i, j] = min(moves.get((i, j), (FAR, "~")), (cost, edit))

    if symbol < GONE:
        more = TRUNCATED if symbol >= 4 else 0
        for i in range(STATES):
            offer(i, _REROLE[i], REROLE + more, "R")
            if (i, symbol % 4) in _KEEP:
                offer(i, _KEEP[i, symbol % 4], more, "K")
    return product(insertions(), _from_moves(moves))


def _count_pairs(text: np.ndarray, width: int, wall: int) -> tuple[int, int]:
    """(code, count) of the most frequent pair of neighbours, ties to the smaller; overlaps of one symbol count half."""
    pair = text[:-1] * width + text[1:]
    inside = (text[:-1] != wall) & (text[1:] != wall)
    same = inside & (text[:-1] == text[1:])
    if same.any():
        # in a run of equal symbols every second pair counts
        begins = same & ~np.concatenate(([False], same[:-1]))
        start = np.maximum.accumulate(np.where(begins, np.arange(len(same)), 0))
        inside &= ~(same & ((np.arange(len(same)) - start) % 2 == 1))
    values, counts = np.unique(pair[inside], return_counts=True)
    if not len(values):
        return -1, 0
    top = int(np.argmax(counts))
    return int(values[top]), int(counts[top])


def re_pair(sequences: list[np.ndarray], symbols: int, least_uses: int = LEAST_USES
            ) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """(rules, sequences in rules and symbols): rule r stands for symbol ``symbols + r``."""
    wall = 0
    text = np.concatenate([x for s in sequences for x in (s.astype(np.int64) + 1, [wall])]) if sequences else np.zeros(1, np.int64)
    rules: list[tuple[int, int]] = []
    while True:
        width = symbols + len(rules) + 2
        code, count = _count_pairs(text, width, wall)
        if count < least_uses:
            break
        a, b = divmod(code, width)
        hit = np.flatnonzero((text[:-1] == a) & (text[1:] == b))
        if a == b and len(hit):                       # of overlapping places every second one
            begins = np.concatenate(([True], np.diff(hit) > 1))
            start = np.maximum.accumulate(np.where(begins, hit, 0))
            hit = hit[(hit - start) % 2 == 0]
        rules.append((a - 1, b - 1))
        text[hit] = symbols + len(rules)
        text = np.delete(text, hit + 1)
    ends = np.flatnonzero(text == wall)
    begin = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else []
    return rules, [text[x:y] - 1 for x, y in zip(begin, ends)][:len(sequences)]


def matrices_of(rules: list[tuple[int, int]], symbols: list[Matrix]) -> list[Matrix]:
    """A matrix per symbol and rule, bottom-up."""
    out = list(symbols)
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


SYMBOLS = [symbol_matrix(k) for k in range(GONE + 1)]
LAST = insertions()
ONE_ROW = range(1)


def evaluate(sequences: list[np.ndarray], rows: range, least_uses: int = LEAST_USES) -> list[Matrix]:
    """The transfer matrix of every sequence (the given rows of it), through one grammar for all."""
    rules, short = re_pair(sequences, len(SYMBOLS), least_uses)
    known = matrices_of(rules, SYMBOLS)
    empty = _from_moves({(i, i): (0, "") for i in range(STATES)})
    out = []
    for s in short:
        m = empty
        for x in s.tolist():
            m = product(m, known[x], rows)
        out.append(m)
    return out


def cheapest(m: Matrix) -> tuple[int, str]:
    """(cost, audit) of a whole conversation from its matrix."""
    done = product(m, LAST, ONE_ROW)
    return min((done.cost[0][j], done.text(0, j)) for j in (0, 3) if done.cost[0][j] < FAR)


# ------------------------------------------------------------------ Spark

def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times (0: dropped) after the damage of the contract."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.when(kind == 4, "user").otherwise(said("role")).alias("role"),
                       F.when(kind == 0, None).otherwise(text).alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"))


def plain(rows: DataFrame) -> DataFrame:
    """The rows as they are, in the form of ``damaged``."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(1).cast("long").alias("times"))


_ORDER = ["conv_id", "turn", "role", "text_id"]


def coded_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text_id, times, fault of the first of ``times`` equal rows; the others must go.

    ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated.
    """
    seen = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    rows = rows.filter("times > 0").select(
        "conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_id"), "times",
        F.when(seen == "", 1).when(F.substring(seen, -1, 1).rlike("[.!?]"), 0).otherwise(3).alias("fault"))
    rows = C.store(rows.groupBy(*_ORDER).agg(F.sum("times").alias("times"), F.min("fault").alias("fault")), "turns")
    # one struct of the turn: a null turn comes first
    again = rows.groupBy("conv_id", "role", "text_id").agg(
        F.min(F.struct("turn")).alias("first"), F.count("*").alias("rows")).filter("rows > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_id").alias("t"), "first")
    same = rows["conv_id"].eqNullSafe(F.col("c")) & (rows["role"] == F.col("r")) & (rows["text_id"] == F.col("t"))
    later = F.col("first").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first"))
    return rows.join(again, same, "left").select(
        *_ORDER, "times", F.when((F.col("fault") != 1) & later, 2).otherwise(F.col("fault")).alias("fault"))


_SEGMENT_TYPES = [
    ("conv_id", None), ("turn", pa.int64()), ("role", pa.string()), ("text_id", pa.binary()), ("part", pa.int64()),
    ("whole", pa.bool_()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("first_role", pa.string()), ("last_role", pa.string()), ("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string()))]
_SEGMENT = ("turn long, role string, text_id binary, part long, whole boolean, first_turn long, last_turn long, "
            "turns long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
            "cost array<long>, audit array<string>")
_LEGAL = {"su", "ua", "au"}
_NEVER = object()


class _Segment:
    """Neighbouring rows of one conversation: their symbols and the counts of the report."""

    __slots__ = ("conv", "turn", "role", "text_id", "part", "symbols", "first_turn", "last_turn", "turns", "counts",
                 "illegal", "first", "last", "begins", "ends")

    def __init__(self, row: dict, begins: bool, part: int):
        self.conv, self.turn, self.role, self.text_id = row["conv_id"], row["turn"], row["role"], row["text_id"]
        self.part, self.begins, self.ends = part, begins, False
        self.symbols: list[int] = []
        self.first_turn = self.last_turn = None
        self.turns, self.counts, self.illegal = 0, [0, 0, 0], 0
        self.first, self.last = row["role"][:1], None

    def take(self, row: dict, times: int, first: bool) -> None:
        """``times`` equal rows; the first of them has the row's fault if ``first``, the others are copies."""
        initial = row["role"][:1]
        copy = 1 if row["fault"] == 1 else 2
        fault = row["fault"] if first else copy
        letter = "sua".find(initial) % 4 if initial else 3
        self.symbols.append(GONE if fault in (1, 2) else letter + (4 if fault == 3 else 0))
        if fault:
            self.counts[fault - 1] += 1
        if times > 1:
            self.symbols += [GONE] * (times - 1)
            self.counts[copy - 1] += times - 1
            self.illegal += (times - 1) * (2 * initial not in _LEGAL)
        if self.last is not None:
            self.illegal += self.last + initial not in _LEGAL
        if row["turn"] is not None and row["turn"] != self.last_turn:
            self.turns += 1
            self.last_turn = row["turn"]
            self.first_turn = row["turn"] if self.first_turn is None else self.first_turn
        self.last = initial


def segments(coded: DataFrame, segment: int = SEGMENT, least_uses: int = LEAST_USES) -> DataFrame:
    """One row per segment: where it begins, its counts, and cost and audit: of the whole conversation where it is
    one segment, else of its matrix, row by row."""
    def finish(held: list[_Segment], schema: pa.Schema) -> pa.RecordBatch:
        keys = [(np.array(s.symbols, np.uint8).tobytes(), s.begins and s.ends) for s in held]
        answers: dict[tuple[bytes, bool], tuple[list, list]] = {}
        for whole, rows in ((True, ONE_ROW), (False, range(STATES))):
            some = sorted({k for k, w in keys if w == whole})
            for k, m in zip(some, evaluate([np.frombuffer(k, np.uint8) for k in some], rows, least_uses)):
                if whole:
                    cost, audit = cheapest(m)
                    answers[k, whole] = [cost], [audit]
                else:
                    answers[k, whole] = ([c for line in m.cost for c in line],
                                         [m.text(i, j) if m.cost[i][j] < FAR else None
                                          for i in range(STATES) for j in range(STATES)])
        rows = [{"conv_id": s.conv, "turn": s.turn, "role": s.role, "text_id": s.text_id, "part": s.part,
                 "whole": k[1], "first_turn": s.first_turn, "last_turn": s.last_turn, "turns": s.turns,
                 "blank": s.counts[0], "duplicate": s.counts[1], "truncated": s.counts[2], "illegal": s.illegal,
                 "first_role": s.first, "last_role": s.last, "cost": answers[k][0], "audit": answers[k][1]}
                for s, k in zip(held, keys)]
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Segment] = []
        now: _Segment | None = None
        conv, part, size, schema = _NEVER, 0, 0, None
        for batch in batches:
            schema = schema or pa.schema([(n, t or batch.schema.field("conv_id").type) for n, t in _SEGMENT_TYPES])
            for row in batch.to_pylist():
                # a task's first conversation may have begun in the task before
                begins = conv is not _NEVER and row["conv_id"] != conv
                if now is not None and begins:
                    now.ends = True
                    held.append(now)
                    now = None
                if begins:
                    part = 0
                conv, left, first = row["conv_id"], row["times"], True
                while left:
                    if now is None:
                        now = _Segment(row, begins and first, part)
                        part += 1
                    some = min(left, segment - len(now.symbols))
                    now.take(row, some, first)
                    left, first, size = left - some, False, size + some
                    if len(now.symbols) == segment:
                        held.append(now)
                        now = None
                    if size >= HELD_SYMBOLS and held:
                        yield finish(held, schema)
                        held, size = [], len(now.symbols) if now is not None else 0
        if now is not None:                            # a task's last conversation may go on in the next
            held.append(now)
        if held:
            yield finish(held, schema)

    parts = C.parallelism(coded.sparkSession)
    ordered = coded.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
    return ordered.mapInArrow(cut, f"conv_id {coded.schema['conv_id'].dataType.simpleString()}, {_SEGMENT}")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_AUDITED = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string"


class _Fold:
    """The segments of one conversation so far, from the grammar's start to each state.

    What all audits begin with is set aside, so the rest stays short.
    """

    def __init__(self):
        self.ways: dict[int, tuple[int, str]] = {0: (0, "")}
        self.done: list[str] = []
        self.counts = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal"), 0)
        self.first_turn = self.last_turn = self.last_role = None

    def _step(self, cost: Callable[[int, int], int], audit: Callable[[int, int], str]) -> None:
        ways = {}
        for j in range(STATES):
            offers = [(c + cost(k, j), k) for k, (c, _) in self.ways.items() if cost(k, j) < FAR]
            if offers:
                least = min(offers)[0]
                ways[j] = least, min(self.ways[k][1] + audit(k, j) for c, k in offers if c == least)
        texts = [t for _, t in ways.values()]
        low, high = min(texts), max(texts)
        same = next((n for n, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        self.done.append(low[:same])
        self.ways = {j: (c, t[same:]) for j, (c, t) in ways.items()}

    def take(self, row: dict) -> None:
        self._step(lambda k, j: row["cost"][4 * k + j], lambda k, j: row["audit"][4 * k + j])
        for c in self.counts:
            self.counts[c] += row[c]
        if self.last_role is not None:
            self.counts["illegal"] += self.last_role + row["first_role"] not in _LEGAL
        if row["first_turn"] is not None:
            if self.first_turn is None:
                self.first_turn = row["first_turn"]
            self.counts["turns"] -= row["first_turn"] == self.last_turn
            self.last_turn = row["last_turn"]
        self.last_role = row["last_role"]

    def result(self, conv) -> dict:
        self._step(lambda k, j: LAST.cost[k][j], lambda k, j: LAST.text(k, j))
        cost, rest = min(self.ways[j] for j in (0, 3) if j in self.ways)
        n = self.counts
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - n["turns"]
        return {"conv_id": conv, "gaps": gaps, "cost": cost, "audit": "".join(self.done) + rest,
                **{c: n[c] for c in ("blank", "duplicate", "truncated", "illegal")}}


def audits(pieces: DataFrame) -> DataFrame:
    """conv_id, the counts, cost and audit of every conversation that has rows."""
    conv_type = pieces.schema["conv_id"].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, rows, schema = None, None, [], None
        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type),
                                          *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if now is None or row["conv_id"] != conv:
                    if now is not None:
                        rows.append(now.result(conv))
                    now, conv = _Fold(), row["conv_id"]
                now.take(row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result(conv)], schema=schema)

    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    whole = pieces.filter("whole").select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("cost")[0].alias("cost"), F.col("audit")[0].alias("audit"))
    cut = pieces.filter("not whole").repartition(C.parallelism(pieces.sparkSession), "conv_id").sortWithinPartitions(
        *_ORDER, "part")
    return whole.unionByName(cut.mapInArrow(fold, f"conv_id {conv_type}, {_AUDITED}"))


class _Replay:
    """An audit read along the rows of its conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit.startswith("I", self.at):
            yield ROLE_AFTER[self.state], ""
            self.state, self.at = _REROLE[self.state], self.at + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            yield role, text
            self.state = _KEEP[self.state, "sua".index(role[:1])]
        elif edit == "R":
            yield ROLE_AFTER[self.state], text
            self.state = _REROLE[self.state]


def _told(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Rows of ``damaged`` behind their conversation's audit, a conversation in one task and in order."""
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role",
                        F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_id"), "text", "times")
    heads = told.withColumn("kind", F.lit(0))
    both = lines.unionByName(heads, allowMissingColumns=True)
    return both.repartition(C.parallelism(rows.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "kind", "turn", "role", "text_id")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict | None, object]]:
    """(conv_id, its audit's row or None if nothing is left of it, iterator of its repaired (role, text))."""
    def lines():
        for batch in batches:
            yield from batch.select(["conv_id", "kind", "role", "text", "times", *_COUNTS, "audit"]).to_pylist()

    rows = lines()
    row = next(rows, None)
    while row is not None:
        conv, head = row["conv_id"], row if row["kind"] == 0 else None
        ahead: list = [row if head is None else next(rows, None)]

        def repaired():
            replay = _Replay(head["audit"]) if head else None
            while (now := ahead[0]) is not None and now["conv_id"] == conv:
                for _ in range(now["times"]):
                    yield from replay.row(now["role"], now["text"])
                ahead[0] = next(rows, None)
            if replay:
                yield from replay.inserted()

        turns = repaired()
        yield conv, head, turns
        for _ in turns:                                # whatever the caller has left
            pass
        row = ahead[0]


def repaired_turns(rows: DataFrame, told: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the repaired conversations, in order by place."""
    def write(batches):
        out, schema = [], None

        def seen():
            nonlocal schema
            for batch in batches:
                schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("place", pa.int64()),
                                              ("role", pa.string()), ("text", pa.string())])
                yield batch

        for conv, _, turns in _conversations(seen()):
            for place, (role, text) in enumerate(turns):
                out.append({"conv_id": conv, "place": place, "role": role, "text": text})
                if len(out) == ROWS_AT_A_TIME:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _told(rows, told).mapInArrow(
        write, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, text string")


def digests(rows: DataFrame, told: DataFrame) -> DataFrame:
    """conv_id, the counts, cost, audit and repaired_sha256 of every conversation, also of those without rows left."""
    def digest(batches):
        out, schema = [], None

        def seen():
            nonlocal schema
            for batch in batches:
                schema = schema or pa.schema([
                    ("conv_id", batch.schema.field("conv_id").type), *[(c, pa.int64()) for c in _COUNTS],
                    ("audit", pa.string()), ("repaired_sha256", pa.string())])
                yield batch

        for conv, head, turns in _conversations(seen()):
            sha, between = hashlib.sha256(), b""
            for role, text in turns:
                sha.update(between + f"{role}:{text}".encode())
                between = b"\n"
            out.append({"conv_id": conv, **{c: head[c] if head else 0 for c in _COUNTS},
                        "audit": head["audit"] if head else "", "repaired_sha256": sha.hexdigest()})
            if len(out) == ROWS_AT_A_TIME:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _told(rows, told).mapInArrow(
        digest, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_AUDITED}, repaired_sha256 string")


def audit_conversations(rows: DataFrame, segment: int = SEGMENT, least_uses: int = LEAST_USES) -> DataFrame:
    """The cheapest edits of rows in the form of ``damaged`` or ``plain``; written once to the shared folder."""
    C.prepare(rows.sparkSession)
    coded = C.store(coded_rows(rows), "coded")
    pieces = C.store(segments(coded, segment, least_uses), "segments", NARROW_ROWS)
    return C.store(audits(pieces), "audits")


def query(spark, sf_dir: str) -> DataFrame:
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    told = audit_conversations(rows)
    return C.store(digests(rows, told), "repaired", ROWS_AT_A_TIME)
