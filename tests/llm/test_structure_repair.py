import hashlib
import random
from collections import defaultdict

import pytest

from tidemark.llm import structure_repair
from tidemark.llm.structure_repair import ACCEPTED, KEEPS, LEADS, START, Row, cheapest, repair, repair_report

TURNS = "conv_id long, turn long, role string, text string, pos string, place string, kind string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_ways(rows):
    """Place -> (cost, audit, repaired rows): every row preceded by insertions, then kept, reroled or deleted."""

    def inserted(best):
        for _ in range(2):
            for q in list(best):
                cost, audit, out = best[q]
                new = (cost + 5, audit + "I", [*out, (("user", "user", "assistant", "user")[q], "")])
                best[LEADS[q]] = min(new, best.get(LEADS[q], new), key=lambda x: x[:2])
        return best

    best = {START: (0, "", [])}
    for row, role, text in rows:
        after = {}

        def put(q, new, after=after):
            after[q] = min(new, after.get(q, new), key=lambda x: x[:2])

        for q, (cost, audit, out) in inserted(best).items():
            put(q, (cost + 2, audit + "D", out))
            if not row.goes:
                if KEEPS[q][row.initial] >= 0:
                    put(KEEPS[q][row.initial], (cost + row.extra, audit + "K", [*out, (role, text)]))
                give = ("user", "user", "assistant", "user")[q]
                put(LEADS[q], (cost + 1 + row.extra, audit + "R", [*out, (give, text)]))
        best = after
    best = inserted(best)
    return min((best[q] for q in ACCEPTED if q in best), key=lambda x: x[:2])


def plain_report(every, rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role, text))
    out = {}
    for conv in {r[0] for r in every}:
        mine = sorted(found[conv])
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in mine:
            end = text.rstrip(BLANKS)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = "sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3
            marked.append((Row(initial, fault in ("blank", "duplicate"), 5 * (fault == "truncated")), role, text))
        cost, audit, repaired = plain_ways(marked)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        turns = {t for there, t, _, _ in mine if there}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), repaired)
    return out


def made(seed=11):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "u", "", " ", "tool", "Assistant"]
    texts = ["Yes.", "No!", "open", "  ", "", "Long " * 50 + "end?", "é.\n", "a\tb", "x. \x0b"]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choices(roles, (6, 6, 2, 1, 1, 1, 1, 1))[0], rng.choice(texts)))
    rows += rows[5:9]  # repeated rows
    rows += [(77, t, ("user", "assistant")[t % 2] if rng.random() < 0.8 else rng.choice(roles), f"Text {t}" + rng.choice(".!x ")) for t in range(700)]
    rows += [(78, 1, "user", "x" * 300_000 + ".")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], TURNS).repartition(4)


def test_search_against_plain():
    rng = random.Random(3)
    for _ in range(3_000):
        weights = rng.choice([(1, 5, 5, 1), (1, 1, 1, 1), (0, 6, 1, 0)])
        rows = [Row(rng.choices(range(4), weights)[0], rng.random() < 0.15, 5 * (rng.random() < 0.2)) for _ in range(rng.randint(0, 14))]
        cost, audit, _ = plain_ways([(r, "", "") for r in rows])
        assert cheapest(rows, START, ACCEPTED, True)[:2] == (cost, audit)


def test_no_way():
    assert cheapest([], 2, (0,), False) is None
    assert cheapest([Row(1, False, 0)], 3, (1,), False) is None


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_report_against_plain(spark, bits):
    rows = made()
    every = [*rows, (500, 1, "user", "gone"), (None, None, None, None)]
    got = repair_report(frame(spark, every), frame(spark, rows), bits).collect()
    expected = plain_report(every, rows)
    assert len(got) == len(expected)
    for r in got:
        assert tuple(r)[1:] == expected[r.conv_id][:-1], r.conv_id


@pytest.mark.parametrize("bits", [1, 12])
def test_repaired_rows(spark, bits):
    rows = made(5)
    expected = plain_report(rows, rows)
    found = defaultdict(list)
    for r in repair(frame(spark, rows), bits).orderBy("pos", "seq").collect():
        if r.edit != "D":
            found[r.conv_id].append((r.role, r.text))
    assert found == {c: x[-1] for c, x in expected.items() if x[-1]}


def test_one_text_repeated(spark):
    rows = [(1, t, "user", "Same.") for t in range(300)] + [(1, 300, "assistant", "End.")]
    (got,) = repair_report(frame(spark, rows), bits=4).collect()
    assert (got.duplicate, got.cost, got.audit) == (299, 598, "K" + "D" * 299 + "K")


def test_empty(spark):
    none = frame(spark, [])
    assert repair_report(none).count() == 0
    assert repair(none).count() == 0
    (got,) = repair_report(frame(spark, [(1, 0, "user", "x")]), none).collect()
    assert tuple(got) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage_by_remainder(spark):
    rows = [(c, t, "assistant", "A. B?") for c in range(20) for t in range(10)] + [(None, None, None, None)]
    got = structure_repair.damaged(frame(spark, rows)).collect()
    import zlib

    kind = {(c, t): zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, _, _ in rows}
    expected = []
    for c, t, role, text in rows:
        k, role, text = kind[c, t], role or " ", text or " "
        text = "" if k == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if k == 2 else text
        expected += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
