"""How many rows the search for repeated spans keeps, and that what its table of bits lets through changes nothing."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import plain
from tidemark.llm import repeated_spans


def kept_rows(monkeypatch):
    made = []
    whole = repeated_spans.stored

    def counted(df):
        out = whole(df)
        made.append(out.count())
        return out

    monkeypatch.setattr(repeated_spans, "stored", counted)
    return made


def checked(spark, rows, most):
    got = repeated_spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), most).drop("kept").collect()
    found = plain.without_repeats([t for _, t in rows])
    assert Counter(map(tuple, got)) == Counter((k, *f) for (k, _), f in zip(rows, found, strict=True))


@pytest.mark.parametrize("most", [100_000, 10])
def test_a_text_that_repeats_itself_costs_few_rows(spark, monkeypatch, most):
    """Such texts have a segment at every byte, of a few anchors, and different ones where they end."""
    made = kept_rows(monkeypatch)
    rows = [(k, "ab " * 700 + f"{k:03d} " * (k % 5) + "ab " * 70) for k in range(30)]
    checked(spark, rows, most)
    assert sum(made) < 150 * len(rows)


def test_segments_that_occur_once_are_not_kept(spark, monkeypatch):
    rng = random.Random(4)
    new = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = new(40)
    rows = [(k, f"{new(150)} {passage if k < 6 else ''} {new(150)}") for k in range(40)]
    made = kept_rows(monkeypatch)
    checked(spark, rows, 100_000)
    assert sum(made) < 400


@pytest.mark.parametrize("most", [100_000, 1])
def test_full_bits_change_nothing(spark, monkeypatch, most):
    rng = random.Random(6)
    new = lambda n: " ".join(rng.choice(("ab", "cde", "fg")) + str(rng.randrange(1000)) for _ in range(n))
    passage = new(60)
    rows = [(k % 17, f"{new(30)} {passage[k % 7 :]} {new(30)}") for k in range(20)] + [(None, passage), (None, passage), (3, None), (4, "")]
    monkeypatch.setattr(repeated_spans, "place_bits", lambda wanted: np.full(1 << (repeated_spans.SLOT_BITS - 3), 0xFF, np.uint8))
    checked(spark, rows, most)
