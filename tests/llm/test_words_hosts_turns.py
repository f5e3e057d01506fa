"""Spelling variants, URL filters and conversation repair against plain models on awkward tables."""
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import odd_tables as O
import pytest
from pyspark.sql import functions as F

from salescope.llm import conversation_repair as R, spelling_variants as S, url_filter as U

LOWER = O.LOWER


# ---------------------------------------------------------------- spelling variants

def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(rows, misspell=31, least=7, times=2, ratio=10):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % misspell == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= times}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def told(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def word_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé\u00ff") for _ in range(rng.randrange(7, 12))) for _ in range(40)]
    rows = []
    for k, w in enumerate(base):
        rows.append((k, " ".join([w] * rng.choice([2, 30, 400]))))
        for _ in range(6):
            p, how = rng.randrange(len(w)), rng.randrange(3)
            v = w[:p] + (rng.choice("abx") if how else "") + w[p + (how != 1):]
            rows.append((100 + k, f"{v} {v.upper() if v.isascii() else v}, {v}!"))
    long = "z" * 5000
    rows += [(None, "nullidword nullidword nullidwords nullidwords"), (7, None), (8, ""), (9, " \n"),
             (50, f"{long} {long}"), (51, f"{long}z {long}z"), (52, "kindness kindness KINDNESS Kindness kindnes"),
             (53, "aaaaaaaab aaaaaaaab aaaaaaaba aaaaaaaba aaaaaaabb aaaaaaabb aaaaaabb aaaaaabb")]
    return rows + rows[:3]


@pytest.mark.parametrize("tile", [S.TILE_LETTERS, 40])
def test_variants_equal_brute_force(spark, tile):
    rows = word_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("word", F.lit(1))
    docs = docs.withColumn("n", F.lit("x")).withColumn("key", F.lit(2.0))
    want = variants(rows)
    assert told(S.group_variants(docs, tile_letters=tile)) == want
    assert sum(w[1] is not None for w in want) > 20 and max(len(w[0]) for w in want) == 5001


def test_variants_of_odd_documents_and_no_documents(spark):
    rows = [r[:2] for r in O.odd_rows()]
    assert told(S.group_variants(O.odd_documents(spark), least_letters=4)) == variants(rows, least=4)
    assert told(S.group_variants(O.empty_documents(spark))) == set()


def test_one_edit_and_letter_counts():
    rng = random.Random(1)
    for m in (4, 7, 9):
        words = sorted({"".join(rng.choice("ab\u00e9") for _ in range(m + (k % 2))) for k in range(300)})
        size, codes, counts = S.letter_rows(words, m)
        assert all(counts[k].sum() == len(w) for k, w in enumerate(words))
        short = size == m
        a, b = (np.concatenate(x) for x in zip(*S.gram_pairs(np.zeros(len(words), int), short, size > 0, counts)))
        kept = set()
        for kind in range(3):
            ok = S.one_edit(size, codes, a, b, np.full(len(a), kind), m)
            pairs = set(zip(a[ok].tolist(), b[ok].tolist()))
            assert not pairs & kept                     # each pair under one kind only
            kept |= pairs
        want = {(x, y) for x, y in itertools.product(range(len(words)), repeat=2)
                if len(words[x]) == m and one_edit(words[x], words[y])}
        assert kept == want and len(want) > 20


# ---------------------------------------------------------------- URL filters

def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def verdicts(pages, rules=U.RULES, rounds=U.ROUNDS, d=U.DAMPING):
    parts = [(p, *split_url(u), h) for p, u, h in pages]

    def fit(host, path):
        ok = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(ok, key=lambda r: len(r.name), default=None)

    edges, seeds = {}, {"allow": {}, "block": {}}
    hosts = set()
    for _, host, path, html in parts:
        rule = fit(host, path)
        if rule:
            seeds[rule.verdict][host] = seeds[rule.verdict].get(host, 0) + 1
        if host:
            hosts.add(host)
            for link in re.findall(U.LINK, html or ""):
                to = re.split("[/?#]", link.split("//", 1)[1], maxsplit=1)[0].translate(LOWER)
                if to and to != host:
                    hosts.add(to)
                    edges[host, to] = edges.get((host, to), 0) + 1
    for h in list(hosts):
        labels = h.split(".")
        for k in range(len(labels) - 2):
            a, b = ".".join(labels[k:]), ".".join(labels[k + 1:])
            for e in ((a, b), (b, a)):
                edges.setdefault(e, 0)
    tree = {e for h in hosts for k in range(len(h.split(".")) - 2)
            for e in itertools.permutations((".".join(h.split(".")[k:]), ".".join(h.split(".")[k + 1:])))}
    edges = {e: w + (e in tree) for e, w in edges.items()}

    def rank(edges, seed):
        total, out = sum(seed.values()), {}
        for (a, _), w in edges.items():
            out[a] = out.get(a, 0) + w
        start = {h: n / total for h, n in seed.items()}
        now = dict(start)
        for _ in range(rounds):
            new = {h: (1 - d) * s for h, s in start.items()}
            for (a, b), w in edges.items():
                if a in now:
                    new[b] = new.get(b, 0) + d * now[a] * w / out[a]
            now = new
        return now

    trust = rank(edges, seeds["allow"])
    distrust = rank({(b, a): w for (a, b), w in edges.items()}, seeds["block"])
    out = []
    for p, host, path, _ in parts:
        rule = fit(host, path)
        bad = round(distrust.get(host, 0) - 0.5 * (trust.get(host, 0) + distrust.get(host, 0)), 12) > 0
        out.append((p, host, path, rule.name if rule else None,
                    rule.verdict if rule else "block" if bad else "allow"))
    return sorted(out, key=str)


def page_rows():
    def link(*to):
        return "".join(f'<a href="{t}">x</a>' for t in to) + "<a href='/here'>h</a>"
    bad, good = "http://bad.net/x", "https://good.org/fr/1"
    return [(1, bad, link("http://c.example.com/q")), (2, good, link("//friend.info/a", "HTTPS://Friend.info")),
            (3, "http://friend.info/x?y", None), (4, "http://points.info/", link(bad, bad)),
            (5, "http://far.info", link("http://points.info/?a")), (6, "http://lonely.io/a", ""),
            (7, "ftp://EXAMPLE.net/en/#t", link(good)), (8, "http://www.example.net/en/", ""), (9, "http://a.net", ""),
            (10, "http://a.net?x=/", ""), (11, "http://sub.bad.net:80/", None), (12, None, link(bad)), (13, "no scheme/", ""),
            (14, "", None), (None, "http://x.y.example.com/de/1", ""), (15, "http://z.y.example.com/es/1", link(good)),
            (16, "http://org/fr/", ""), (17, "http://norg/fr/", ""), (18, "http://good.org/de/1", ""),
            (19, "x://h://net/", ""), (20, bad, ""), (20, bad, ""), (21, "http:///path", ""), (22, "http://both.info/", link(good, bad))]


def test_verdicts_equal_brute_force(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["host", "path", "kind", "rank", "src", "rule"])])
    got = sorted([tuple(r) for r in U.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect()], key=str)
    assert got == verdicts(rows)
    by = {r[0]: r for r in got}
    assert by[4][4] == by[5][4] == "block" and by[3][4] == by[6][4] == by[12][4] == "allow"      # by the method alone
    assert by[7][3] == "example.net/en/" and by[9][3] is None and by[16][3] == "org/fr/" and by[17][3] is None


def test_verdicts_without_seeds_or_pages(spark):
    schema = "page_id long, url string, html string"
    got = U.judge(spark.createDataFrame([(1, "http://a.io/", "<a href='http://b.io/'>")], schema)).collect()
    assert [(r["verdict"], r["trust"], r["distrust"]) for r in got] == [("allow", 0.0, 0.0)]
    assert U.judge(spark.createDataFrame([], schema)).collect() == []


# ---------------------------------------------------------------- conversation repair

AFTER = {0: ("user", 2), 1: ("user", 2), 3: ("user", 2), 2: ("assistant", 3)}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows):
    """Cheapest (cost, audit, lines), row by row over the four states."""
    def insert(ways):
        ways = dict(ways)
        for _ in range(4):
            for s, (c, a, o) in list(ways.items()):
                role, n = AFTER[s]
                if n not in ways or (c + 5, a + "I") < ways[n][:2]:
                    ways[n] = (c + 5, a + "I", [*o, role + ":"])
        return ways

    ways = {0: (0, "", [])}
    for (_, role, text), fault in zip(rows, faults_of(rows)):
        new = {}
        for s, (c, a, o) in insert(ways).items():
            offers = [(s, (c + 2, a + "D", o))]
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                offers.append((AFTER[s][1], (c + 1 + more, a + "R", [*o, f"{AFTER[s][0]}:{text}"])))
                if (s, role[:1]) in KEEP:
                    offers.append((KEEP[s, role[:1]], (c + more, a + "K", [*o, f"{role}:{text}"])))
            for n, way in offers:
                if n not in new or way[:2] < new[n][:2]:
                    new[n] = way
        ways = new
    ways = insert(ways)
    return min(ways[s] for s in (0, 3) if s in ways)


def report(rows):
    """The contract's columns for one conversation's rows after damage, in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    faults, turns = faults_of(rows), [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = repaired(rows)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
            faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            kept += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    return out


def turn_rows():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "and then", "", " \n", "Why? ", "Fine.\t", "é", None]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role,
                         f"Line {rng.randrange(40)}." if rng.random() < 0.5 else rng.choice(texts)))
    rows += [(900, t, ["system", "user", "assistant"][min(t, 1 + t % 2)], f"Long {t % 70}{'.' * (t % 3 > 0)}") for t in range(400)]
    rows += [(901, 3, "user", "Same.")] * 30 + [(901, 4, "assistant", "Same.")] * 3 + [(901, None, "system", "First.")]
    rows += [(None, 1, "user", "Null."), (None, 2, "assistant", "Null too."), (902, None, None, None),
             (903, 0, "user", "x" * 100_000 + "."), (903, 1, "assistant", "y" * 50_000)]
    return rows


def got_reports(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("segment", [R.SEGMENT, 3])
def test_reports_equal_brute_force(spark, segment):
    rows = turn_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["times", "kind", "fault", "first", "cost", "audit"])])
    damaged = R.damaged(df)
    told = R.audit_conversations(damaged, segment=segment)
    assert got_reports(R.digests(damaged, told)) == {c: report(r) for c, r in damage(rows).items()}


def test_repaired_turns_follow_the_grammar(spark):
    rows = turn_rows()
    df = R.plain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {}
    for r in sorted(R.repaired_turns(df, R.audit_conversations(df)).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        out.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert len(out) > 100 and all(re.fullmatch("s?(ua)+", "".join(v)) for v in out.values())


def test_no_conversations(spark):
    df = R.damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert R.digests(df, R.audit_conversations(df)).collect() == []


def test_edits_are_the_cheapest_of_all():
    """All edit sequences of short conversations, tried one by one."""
    def best(rows):
        faults, found = faults_of(rows), []

        def go(k, state, cost, audit):
            if cost > 4 + 2 * len(rows) + 5:
                return
            if k == len(rows) and state in (0, 3):
                found.append((cost, audit))
            role, after = AFTER[state]
            go(k, after, cost + 5, audit + "I")
            if k < len(rows):
                go(k + 1, state, cost + 2, audit + "D")
                if faults[k] not in ("b", "d"):
                    more = 5 * (faults[k] == "t")
                    go(k + 1, after, cost + 1 + more, audit + "R")
                    if (state, rows[k][1][:1]) in KEEP:
                        go(k + 1, KEEP[state, rows[k][1][:1]], cost + more, audit + "K")
        go(0, 0, 0, "")
        return min(found)

    symbols = {"s": ("system", "S"), "u": ("user", "U"), "a": ("assistant", "A"), "t": ("user", "T"), "x": ("tool", "X")}
    for word in itertools.product(symbols, repeat=4):
        rows = [(k, symbols[c][0], f"{symbols[c][1]}{k}{'' if c == 't' else '.'}") for k, c in enumerate(word)]
        coded = np.array([R.GONE if f in ("b", "d") else "sua".find(r[1][0]) % 4 + 4 * (f == "t")
                          for r, f in zip(rows, faults_of(rows))], np.uint8)
        (matrix,) = R.evaluate([coded], R.ONE_ROW)
        assert R.cheapest(matrix) == best(rows)


def test_grammar_gives_the_sequences_back():
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 9, rng.integers(0, 60)).astype(np.uint8) for _ in range(50)]
    sequences += [np.full(n, 8, np.uint8) for n in (1, 2, 3, 50, 51)]
    rules, short = R.re_pair(sequences, 9)

    def expand(x):
        return [x] if x < 9 else expand(rules[x - 9][0]) + expand(rules[x - 9][1])

    assert len(rules) > 5 and sum(map(len, short)) < sum(map(len, sequences))
    for s, t in zip(sequences, short):
        assert [y for x in t.tolist() for y in expand(x)] == s.tolist()


def test_ranks_are_written_once_a_group_of_rounds(spark, monkeypatch):
    from salescope.llm import url_filter as U
    written, store = [], U.C.store
    monkeypatch.setattr(U.C, "store", lambda df, kind, *a: written.append(kind) or store(df, kind, *a))
    pages = spark.createDataFrame([(1, "http://a.net/x", '<a href="http://b.org/fr/">'), (2, "http://b.org/fr/", None),
                                   (3, "http://b.org/de/", None)], "page_id long, url string, html string")
    verdicts = {r["page_id"]: r["verdict"] for r in U.judge(pages, rounds=2 * U.ROUNDS_A_TABLE).collect()}
    assert verdicts == {1: "block", 2: "allow", 3: "allow"}
    assert sorted(written) == ["counts", "edges", "host-edges", "ranks", "ranks"]
