from __future__ import annotations

import numpy as np
import odd_tables as O
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from salescope.llm import common as C
from salescope.llm import packing, textkit as K, token_output, tokens as T

TEXTS = ["", None, " a b", "x  y", "tab\t next", "a\n b", "a \nb", "<|endoftext|> hi", "naïve café’s — “q”", "end\n",
         "it's John's 3.14 ... wow!!  ", "a\xa0b c", "a\xa0 b c", "q 　z", "中文 测试", "é à ü ñ ß.", "A " + "b" * 5000,
         "a", " ", "\n", "“ q”", "a — b", "same same same", "\x00 zero \x00"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(T.vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_tokenizers_ids(reference, monkeypatch):
    enc = T.Encoder(T.vocabulary_path())
    for _ in range(2):                                     # with and without cached parts
        ids, counts = enc.encode(*K.utf8(pa.array(TEXTS, pa.string())))
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [reference(t) for t in TEXTS]
    monkeypatch.setattr(T, "CACHE_PARTS", 0)
    ids, counts = T.Encoder(T.vocabulary_path()).encode(*K.utf8(pa.array(TEXTS, pa.string())))
    assert ids.tolist() == [i for t in TEXTS for i in reference(t)]


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 500, 40)
    ids = np.concatenate([np.concatenate([phrase, rng.integers(0, 500, 7)]) for _ in range(300)]).astype(np.uint32)
    for least in (2, 24):
        symbols, rules = token_output.compress(ids, 500, least)
        assert len(symbols) < len(ids) / 2
        assert (token_output.expand(symbols, rules, 500) == ids).all()
        lengths = token_output.rule_lengths(rules, 500)
        assert int(sum(lengths[s - 500] if s >= 500 else 1 for s in symbols.tolist())) == len(ids)
        row = {"rules": rules.astype("<u4").tobytes(), "lengths": lengths.tobytes(), "wide": True, "base": 500,
               "symbols": symbols.astype("<u4").tobytes()}
        for start, n in ((0, 1), (17, 400), (len(ids) - 3, 3), (5, 0)):
            assert (token_output.read_range(row, start, n) == ids[start:start + n]).all()
    runs = np.full(1000, 7, np.uint32)
    symbols, rules = token_output.compress(runs, 500, 2)
    assert (token_output.expand(symbols, rules, 500) == runs).all() and len(symbols) < 100


def test_token_files_round_trip(spark, reference):
    docs = O.odd_documents(spark)
    out = C.scratch(spark, "test-tokens")
    token_output.write_tokens(docs, out, shard_tokens=2000, partitions=3)
    assert spark.read.parquet(out).count() > 3
    rows = token_output.read_tokens(spark, out).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, tuple(reference(r.text) + [0])) for r in docs.collect())
    got = sorted((r.doc_id if r.doc_id is not None else -1, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows)
    assert got == want
    rows.sort(key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)


def test_token_files_of_nothing(spark):
    out = C.scratch(spark, "test-tokens")
    token_output.write_tokens(O.empty_documents(spark), out)
    assert token_output.read_tokens(spark, out).count() == 0


def brute_cost(places, penalties, window):
    best = {0: 0}
    for j, p in zip(places, penalties):
        best[j] = min(best[i] + window - (j - i) for i in best if j - i <= window) + p
    return best[places[-1]]


def test_cuts_are_optimal():
    rng = np.random.default_rng(4)
    for _ in range(200):
        total = int(rng.integers(1, 400))
        ends = np.unique(np.append(rng.integers(1, total + 1, rng.integers(0, 8)), total))
        sentences = np.unique(rng.integers(1, total + 1, rng.integers(0, 30)))
        window = int(rng.integers(3, 60))
        places, penalties = packing.candidates(ends, sentences, total, window)
        assert np.diff(np.concatenate([[0], places])).max() <= window
        cuts = packing.best_cuts(places, penalties, window)
        assert cuts[-1] == total and max(np.diff([0, *cuts])) <= window
        penalty = dict(zip(places.tolist(), penalties.tolist()))
        cost = sum(window - (b - a) + penalty[b] for a, b in zip([0, *cuts], cuts))
        assert cost == brute_cost(places.tolist(), penalties.tolist(), window)


def test_pieces_cover_every_id_once(spark, reference, monkeypatch):
    docs = O.odd_documents(spark)
    rows = packing.pack(docs, window=64, partitions=2).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, tuple(reference(r.text) + [1])) for r in docs.collect())
    by_doc: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        key = r.doc_id if r.doc_id is not None else -1
        if r.start == 0:
            by_doc.setdefault(key, []).append([])
        assert len(by_doc[key][-1]) == r.start and r.doc_tokens >= r.start + r.length
        by_doc[key][-1] += ids
    assert sorted((k, tuple(v)) for k, vs in by_doc.items() for v in vs) == want
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64


def test_pack_of_nothing(spark):
    assert packing.pack(O.empty_documents(spark)).count() == 0


def test_little_padding(spark):
    rows = packing.query(spark, "/root/testdata/sf0.01").groupBy("sequence_id").sum("length").collect()
    total = sum(r[1] for r in rows)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert total / (2048 * (len(rows) - partitions)) > 0.97


def twin_words(n):
    """A word and its complement whose letters follow the Thue-Morse sequence: polynomial hashes confuse them."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_twin_words_have_hashes_and_ids_of_their_own():
    import numpy as np
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer
    from salescope.llm import textkit as K, tokens
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, enc = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = [t for n in (64, 128, 1024, 2048, 4096) for w in [twin_words(n)] for t in (w[0], w[1], f"x {w[0]} {w[1]}")]
    buf, off = K.utf8(pa.array(texts))
    words = K.Words(buf, off)
    strings = [w for t in texts for w in t.split()]
    assert len(set(words.hash.tolist())) == len(set(strings))
    assert dict(zip(strings, words.hash.tolist())) == dict(reversed(list(zip(strings, words.hash.tolist()))))
    flat, counts = enc.encode(buf, off)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [
        plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_rows_of_twin_word_orders_have_keys_of_their_own():
    import pyarrow as pa
    from salescope.llm import textkit as K
    texts = [" ".join(w) for n in (512, 1024, 2048, 4096) for w in twin_words(n)]
    buf, off = K.utf8(pa.array([*texts, "", *texts]))
    words = K.Words(buf, off)
    keys = K.row_hash(K.prefix_powers(words.hash), words.first)
    assert len(set(keys.tolist())) == len(texts) + 1 and keys[:len(texts)].tolist() == keys[len(texts) + 1:].tolist()
