"""Pairs of sets that share an index entry and are far apart."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import jaccard_join


def test_folded_bits_are_those_of_a_shorter_row():
    rng = np.random.default_rng(1)
    for size in (1, 100, 200, 3_000, 40_000):
        own = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
        slots = ((own * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) & (64 * jaccard_join.FOLDED - 1)
        bits = np.packbits(np.bincount(slots, minlength=64 * jaccard_join.FOLDED) & 1).view(np.int64)
        assert jaccard_join.folded([jaccard_join.parity(own)]).tolist() == [bits.tolist()]
    assert jaccard_join.folded([]).shape == (0, jaccard_join.FOLDED)


@pytest.mark.parametrize("percent", [90, 80])
def test_sets_that_share_rare_passages_make_no_pairs(spark, monkeypatch, percent):
    """Each text is five passages of 25 texts: n-grams are rare, texts meet by them, and hubs link nothing."""
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(30)) for _ in range(40)]
    rows = [(k, " ".join(rng.sample(pool, 5))) for k in range(200)]
    rows += [(200 + k, rows[k][1].rsplit(" ", 3)[0]) for k in range(20)]  # close to a text, whatever hub that met
    made = []
    whole = jaccard_join.may_link

    def counted(pairs, vertices, percent):
        made.append(pairs.count())
        return whole(pairs, vertices, percent)

    monkeypatch.setattr(jaccard_join, "may_link", counted)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, percent)
    found = {r.doc_id: r.component_id for r in got.collect()}
    assert found == {k: k - 200 if k >= 200 else k for k in range(220)}
    assert made[-1] < 100
