import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import vector_codes
from tidemark.llm.vector_codes import Grid, product_codes

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        after = []
        for p in range(parts):
            members = [[] for _ in books[p]]
            for c in cut:
                members[near(p, c[p])[1]].append(c[p])
            after.append([[sum(x) // len(m) for x in zip(*m)] if m else e for m, e in zip(members, books[p])])
        books = after
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(kept, errors):
        totals[label] = totals.get(label, 0) + e
    return [(i, "".join(f"{k:02x}" for _, k in f), e, totals[label], digest) for (i, _, label), f, e in zip(kept, found, errors)]


def made(n, width, seed=1, scale=0.2):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0, scale) for _ in range(16 * width)], rng.choice([0, 1, 2, None])) for k in range(n)]
    rows += rows[3:6]  # repeated rows
    rows += [(n, [0.0] * 16 * width, 7)] * (n // 2)  # one vector over and over
    rows += [(None, rows[0][1], 1), (n + 1, None, 1), (n + 2, [None] * 16 * width, 1)]
    rows += [(n + 3, [float("nan")] + [0.0] * (16 * width - 1), 0), (-5, [float("inf")] * 16 * width, 0), (n + 4, [], 0)]
    return rows


@pytest.mark.parametrize(("n", "width", "scale"), [(150, 2, 0.2), (90, 1, 0.01), (20, 3, 5.0), (70, 4, 0.0)])
def test_against_plain(spark, n, width, scale):
    rows = made(n, width, scale=scale)
    got = product_codes(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))


def test_cells_leave_out_dominated_entries_only():
    rng = np.random.default_rng(3)
    for width in (1, 2, 4, 9):
        books = rng.integers(-60, 60, (2, 64, width))
        books[:, 9] = books[:, 4]  # a tie that the lower index wins
        grid = Grid(books)
        points = rng.integers(-90, 90, (3_000, width))
        for part in range(2):
            code, least = grid.nearest(part, points)
            distance = ((points[:, None] - books[part][None]) ** 2).sum(axis=2)
            assert (code == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
        if width < 3:
            assert np.mean([len(x) for x in grid.memo[0].values()]) < 16


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(vector_codes, "HELD", 50)
    rng = np.random.default_rng(4)
    books = rng.integers(-60, 60, (1, 64, 3))
    grid = Grid(books)
    for _ in range(5):
        points = rng.integers(-90, 90, (40, 3))
        distance = ((points[:, None] - books[0][None]) ** 2).sum(axis=2)
        assert (grid.nearest(0, points)[0] == distance.argmin(axis=1)).all()
        assert grid.held <= 50


def test_rare_labels_meet_their_totals(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "LABELS", 2)
    rows = [(k, [k / 50.0] * 16, None if k % 3 == 0 else k % 7) for k in range(80)]
    got = product_codes(frame(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))


def test_empty(spark):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for rows in ([], [(1, None, 1), (2, [None], 1)]):
        got = product_codes(frame(spark, rows))
        assert got.columns == columns and got.count() == 0
