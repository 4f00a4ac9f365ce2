"""The mixture over contexts of up to ``DEPTH`` bytes, against the recursion over them."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import exp, lgamma, log, log10, pi

import pytest

from tidemark.llm import context_tree


def plain_scores(train: list[bytes], texts: list[bytes], depth: int) -> list[float]:
    """Log10 probabilities of ``texts``, one decision at a time, from dictionaries of contexts."""
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def decisions(data: bytes):
        padded = bytes(depth) + data
        for i, byte in enumerate(data):
            for k in range(8):
                yield padded[i : i + depth], (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1

    for data in train:
        for context, node, bit in decisions(data):
            for d in range(depth + 1):
                counts[node, context[depth - d :]][bit] += 1
                if d:
                    children[node, context[depth - d + 1 :]].add((node, context[depth - d :]))

    memo: dict = {}

    def weighted(key) -> tuple[float, float]:
        """Of the context: log weighted probability, and the share of its own estimate."""
        if key not in memo:
            a, b = counts.get(key, (0, 0))
            own = lgamma(a + 0.5) + lgamma(b + 0.5) - log(pi) - lgamma(a + b + 1)
            if len(key[1]) == depth:
                memo[key] = own, 1.0
            else:
                below = sum(weighted(c)[0] for c in children.get(key, ()))
                both = max(own, below) + log(1 + exp(-abs(own - below)))
                memo[key] = both - log(2), exp(own - both)
        return memo[key]

    out = []
    for data in texts:
        total = 0.0
        for context, node, bit in decisions(data):
            one = 0.0
            for d in range(depth, -1, -1):
                key = node, context[depth - d :]
                a, b = counts.get(key, (0, 0))
                share = weighted(key)[1]
                one = share * (b + 0.5) / (a + b + 1) + (1 - share) * one
            total += log10(one if bit else 1 - one)
        out.append(total)
    return out


@pytest.mark.parametrize("most_grams", [3, 2_000_000])
def test_score_reads_all_bytes_of_context(spark, monkeypatch, most_grams):
    monkeypatch.setattr(context_tree, "TOGETHER", 64)  # several chunks in a task
    rng = random.Random(4)
    texts = ["the cat sat on the mat", "a cat sat", "", None, "die Katze saß é", "abababab" * 9, "the cat sat on the mat"]
    texts += ["".join(rng.choice("abc ") for _ in range(rng.randrange(60))) for _ in range(20)]
    held = [k % 4 == 1 for k in range(len(texts))]
    held[6] = None  # neither learned from nor held out
    rows = [(k, h, t) for k, (h, t) in enumerate(zip(held, texts, strict=True))]
    raw = [(t or "").encode() for t in texts]
    expected = plain_scores([t for t, h in zip(raw, held, strict=True) if h is False], raw, context_tree.DEPTH)
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string"), most_grams=most_grams)
    found = {r.doc_id: r.score for r in got.collect()}
    assert context_tree.DEPTH > 2
    assert found == {k: pytest.approx(x, abs=1e-4) for k, x in enumerate(expected)}


def test_longer_contexts_tell_texts_apart(spark):
    """Three letters decide the next one; the two before it do not."""
    rng = random.Random(2)
    words = ["xabc", "yabd"]
    rows = [(k, False, " ".join(rng.choice(words) for _ in range(50))) for k in range(40)]
    rows += [(100, True, " ".join(["xabc"] * 20)), (101, True, " ".join(["xabd"] * 20))]
    got = {r.doc_id: r.score for r in context_tree.score(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")).collect()}
    assert got[100] - got[101] > 20


def test_no_rows_to_learn_from(spark):
    rows = [(1, True, "ab"), (2, True, None)]
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")).collect()
    assert {r.doc_id: round(r.score, 4) for r in got} == {1: round(16 * log10(0.5), 4), 2: 0.0}


def test_grams_and_rare_ones():
    import numpy as np

    texts = [b"abcab", b"", b"ab"]
    flat, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    grams = context_tree.grams_of(flat, starts)
    assert [int(g).to_bytes(6, "big").lstrip(b"\0") for g in grams] == [b"a", b"ab", b"abc", b"abca", b"abcab", b"a", b"ab"]
    table = np.array([97], np.int64)
    sums, rare = context_tree.gram_sums(flat, starts, table, np.array([-1.0]))
    assert sums.tolist() == [-1.0, 0.0, -1.0]
    counted = Counter({(0, b"ab"): 1, (0, b"abc"): 1, (0, b"abca"): 1, (0, b"abcab"): 1, (2, b"ab"): 1})
    assert counted == Counter({(k, p["token"].to_bytes(6, "big").lstrip(b"\0")): p["times"] for k, row in enumerate(rare.to_pylist()) for p in row})


def test_grams_of_more_texts_than_a_number_holds(monkeypatch):
    import numpy as np

    monkeypatch.setattr(context_tree, "TEXTS", 2)
    texts = [b"ab", b"", b"a", b"aab", b"b"]
    flat, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    sums, rare = context_tree.gram_sums(flat, starts, np.array([97], np.int64), np.array([-2.0]))
    assert sums.tolist() == [-2.0, 0.0, -2.0, -2.0, 0.0]
    assert [len(row) for row in rare.to_pylist()] == [1, 0, 0, 2, 1]
