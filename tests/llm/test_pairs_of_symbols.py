"""Counting of neighbouring symbols for op4's grammars."""
import numpy as np
import pytest

from salescope.llm import token_output as TO


@pytest.mark.parametrize("bits", [4, 10, 20])
def test_frequent_pairs_are_those_of_a_plain_count(monkeypatch, bits):
    monkeypatch.setattr(TO, "_HASH_BITS", bits)           # few cells: many pairs share one
    g = np.random.default_rng(bits)
    for least in (1, 3, 24):
        for size in (2, 50, 20_000):
            seq = (g.zipf(1.3, size) % 60_000).astype(np.uint32)
            rank, pairs = TO._frequent_pairs(seq, least)
            code = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
            distinct, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            order = order[counts[order] >= least]
            place = np.full(len(distinct), np.iinfo(np.int32).max, np.int32)
            place[order] = np.arange(len(order))
            assert pairs.tolist() == distinct[order].tolist() and rank.tolist() == place[inverse].tolist()
