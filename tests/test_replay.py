"""Set-based replay against the sequential model on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from tests import model
from tidemark.operators.image import apply_final, final_image, merge_image
from tidemark.operators.links import links_cascade, links_new, merge_links
from tidemark.operators.replay import replay
from tidemark.operators.skew import SkewPolicy
from tidemark.spec import ChangeSpec, Column, Link, Mapping

ALL_HOT = SkewPolicy(hot_rows=1, sample=1.0, slice_rows=4, chain=3)
SOME_HOT = SkewPolicy(hot_rows=30, sample=1.0, slice_rows=40)
SCHEMA = "id long, op string, k1 int, k2 string, ok boolean, a string, b long"


def log(seed, n, keys, skewed=True):
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(1, 10 * n), n):
        k = 0 if skewed and rng.random() < 0.35 else rng.randrange(keys)
        key = (None, "n") if k == 1 else (k, None if k % 3 == 0 else f"s{k}")
        rows.append(
            {
                "id": i,
                "op": rng.choices(["I", "U", "D", "X", None], [4, 4, 3, 1, 0.3])[0],
                "key": key,
                "ok": rng.random() < 0.9,
                "a": rng.choice([None, "x", "y", "z"]),
                "b": rng.choice([None, 1, 2, 3]),
            }
        )
    return rows


def frame(spark, rows):
    data = [(r["id"], r["op"], r["key"][0], r["key"][1], r["ok"], r["a"], r["b"]) for r in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def spec_for(partial=False, link=None, **options):
    both = {"a": ":a", "b": ":B"}
    checks = {"flag": "not :OK"}
    return ChangeSpec(
        business_keys=("k1", "k2"),
        order_key="id",
        op_column="op",
        id_column="row_id",
        nullable_keys=True,
        target={"a": Column("string", nullable=True), "b": Column("bigint", nullable=True)},
        insert=Mapping(both, checks),
        update=Mapping({"a": ":a"} if partial else both, checks),
        link=link,
        **options,
    )


def as_target(df):
    return {(r.k1, r.k2): {"id": r.row_id, "a": r.a, "b": r.b} for r in df.collect()}


CASES = [
    dict(quarantine=q, on_duplicate=d, on_missing=m, partial=p)
    for q in (True, False)
    for d in ("fail", "upsert")
    for m in ("noop", "upsert")
    for p in (False, True)
]


RUNS = [(case, None) for case in CASES]
RUNS += [(case, (ALL_HOT, SOME_HOT)[(i + i // 2) % 2]) for i, case in enumerate(CASES)]


def run_name(value):
    if isinstance(value, dict):
        return "-".join(str(v) for v in value.values())
    return {None: "plain", SOME_HOT: "some_hot", ALL_HOT: "all_hot"}[value]


@pytest.mark.parametrize("case, skew", RUNS, ids=run_name)
def test_random_logs(spark, case, skew):
    seed = CASES.index(case)
    rows = log(seed, 260, 9)
    cut = sorted(r["id"] for r in rows)[90]
    ordered = sorted(rows, key=lambda r: r["id"])
    options = dict(
        quarantine_on=case["quarantine"], on_duplicate=case["on_duplicate"], on_missing=case["on_missing"],
        update_sets=("a",) if case["partial"] else ("a", "b"),
    )
    spec = spec_for(**case)

    # The first part gives the starting state, the second part is what is compared.
    _, target0, blocked0, _ = model.run([r for r in ordered if r["id"] <= cut], **options)
    expected, target1, blocked1, _ = model.run(
        [r for r in ordered if r["id"] > cut], target0, blocked0, **options
    )
    changes = frame(spark, rows).where(F.col("id") > cut)
    target = spark.createDataFrame(
        [(v["id"], k[0], k[1], v["a"], v["b"]) for k, v in target0.items()],
        "row_id long, k1 int, k2 string, a string, b long",
    )
    blocked = spark.createDataFrame(list(blocked0), "k1 int, k2 string")
    outcomes = replay(changes, spec, target, blocked, skew)
    assert {r.id: r.outcome for r in outcomes.collect()} == expected
    assert as_target(apply_final(changes, spec, target, blocked, skew)) == target1
    if case["quarantine"]:
        fresh = {(r.k1, r.k2) for r in outcomes.where("insert_failed").select("k1", "k2").collect()}
        assert blocked0 | fresh == blocked1
        assert not blocked0 & fresh

    # From an empty start, and the same in two steps.
    whole, target2, _, _ = model.run(ordered, **options)
    got = replay(frame(spark, rows), spec, skew=skew)
    assert {r.id: r.outcome for r in got.collect()} == whole
    assert target2 == target1
    assert as_target(apply_final(frame(spark, rows), spec, skew=skew)) == target2


@pytest.mark.parametrize("skew", [None, ALL_HOT], ids=["plain", "all_hot"])
@pytest.mark.parametrize("link_ok", [True, False])
def test_links(spark, skew, link_ok):
    link = Link(
        {"parent": ":NEW_ID", "who": ":WHO"},
        {"parent": Column("bigint"), "who": Column("string", length=4)},
        {"WHO": "ann" if link_ok else "too long"},
    )
    spec = spec_for(link=link, quarantine=False)
    rows = sorted(log(99, 300, 8), key=lambda r: r["id"])
    half = rows[150]["id"]
    options = dict(quarantine_on=False, link_ok=link_ok)
    expected, target, _, links = model.run(rows, **options)
    changes = frame(spark, rows)
    outcomes = replay(changes, spec, skew=skew)
    assert {r.id: r.outcome for r in outcomes.collect()} == expected
    kept = links_cascade(links_new(outcomes, spec), apply_final(changes, spec, skew=skew), spec)
    assert {r.parent: r.link_id for r in kept.collect()} == links

    # The same from two cycles that carry target and links.
    first = final_image(changes.where(F.col("id") <= half), spec, skew=skew)
    target1, links1 = merge_image(None, first, spec), merge_links(None, first, spec)
    second = final_image(changes.where(F.col("id") > half), spec, target1, skew=skew)
    assert as_target(merge_image(target1, second, spec)) == target
    assert {r.parent: r.link_id for r in merge_links(links1, second, spec).collect()} == links
