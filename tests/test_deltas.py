"""What cycles write and read: changes instead of rewritten buckets, one classification, ranges of stamps."""

import glob
import json
import re

import pytest
from pyspark.sql import functions as F

from tests import model
from tests.seed import good, seed
from tests.test_replay import frame, log, spec_for as random_spec
from tests.test_state import held, history_of, ids, spec_for, target_of
from tidemark import Column, Link, SkewPolicy, Store, replay, requeue, run_cycle, run_keyset, run_queue
from tidemark.operators import stamps
from tidemark.operators.select import nth_key
from tidemark.operators.skew import find_hot_keys
from tidemark.plans.cycle import pending, stamps_of
from tidemark.plans.store import overlapping
from tidemark.sources.generate import generate_changes
from workload.catalog import STATUS_HOT
from workload.logs import line_log, line_spec


def written(spark, store, version):
    """Records in the files that a cycle has left."""
    paths = glob.glob(f"{store.files.root}/*/v={version}-*")
    return {p.split("/")[-2]: spark.read.parquet(p).count() for p in paths}


def scanned(df):
    """Rows that the file scans of a plan without exchanges hand on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_few_changes_write_few_records(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"), buckets=8)
    log = generate_changes(spark, 100_000)
    run_keyset(store, spec_for(), log)
    assert store.read("target").count() == 99_000
    some = log.where("operation = 'I' and order_id between 501 and 599")
    more = some.withColumns({"change_id": F.col("change_id") + 10**9, "operation": F.lit("U"), "status_code": F.lit("CN")})
    gone = log.where("operation = 'I' and order_id = 1001").withColumns({"change_id": F.lit(2 * 10**9), "operation": F.lit("D")})
    run_keyset(store, spec_for(), log.unionByName(more).unionByName(gone))
    records = written(spark, store, 2)
    assert records == {"history": 100, "target": 100, "links": 1}
    target = store.read("target")
    assert target.count() == 98_999
    assert target.where("order_id between 501 and 599 and status = 'CANCELLED'").count() == 99
    assert store.read("links").count() == 98_999
    # Keys near a few changes are read without an aggregate over their whole buckets.
    near = store.read("target", near=spark.createDataFrame([(501,), (1001,)], "order_id bigint"))
    assert [(r.order_id, r.status) for r in near.collect()] == [(501, "CANCELLED")]


@pytest.mark.parametrize("quarantine", [True, False])
def test_many_cycles_with_folds_and_packs(spark, tmp_path, quarantine, monkeypatch):
    from tidemark.plans import deltas

    monkeypatch.setattr(deltas, "MOST_SETS", 2)
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    link = Link({"parent": ":NEW_ID", "who": ":WHO"}, {"parent": Column("bigint"), "who": Column("string")}, {"WHO": "x"})
    spec = random_spec(link=link, quarantine=quarantine)
    rows = sorted(log(5, 240, 60, skewed=False), key=lambda r: r["id"])
    outcomes, target, blocked, links = model.run(rows, quarantine_on=quarantine)
    steps = set()
    for at in range(0, 240, 30):
        before = store.latest().parts.get("target", {})
        run_keyset(store, spec, frame(spark, rows[: at + 30]))
        for b, part in store.latest().parts["target"].items():
            old = before.get(b)
            if old is not None and old != part:
                steps.add("fold" if part["base"] != old["base"] else "append" if len(part["sets"]) > len(old["sets"]) else "pack")
    assert {"fold", "append"} <= steps
    assert {r.id: r.outcome for r in store.read("history").collect()} == outcomes
    assert {(r.k1, r.k2): {"id": r.row_id, "a": r.a, "b": r.b} for r in store.read("target").collect()} == target
    assert {r.parent: r.link_id for r in store.read("links").collect()} == links
    store.vacuum(keep=1)
    assert store.read("target").count() == len(target)


def test_sets_are_packed(spark, tmp_path, monkeypatch):
    from tidemark.plans import deltas

    monkeypatch.setattr(deltas, "MOST_SETS", 2)
    store = Store(spark, str(tmp_path / "state"), buckets=1)
    rows = good(spark, *[(i, "I", i) for i in range(1, 41)])
    run_keyset(store, spec_for(), rows)
    sets = []
    for n, (op, key) in enumerate([("U", 1), ("D", 2), ("U", 1), ("D", 3), ("I", 2)]):
        rows = rows.unionByName(good(spark, (100 + n, op, key)))
        run_keyset(store, spec_for(), rows)
        sets.append(len(store.latest().parts["target"]["0"]["sets"]))
    assert sets == [1, 2, 1, 2, 1]
    assert sorted(target_of(store)) == [1, 2, *range(4, 41)]
    assert sorted(r.summary_id for r in store.read("links").collect()) == [1, *range(4, 41), 104]


def test_a_cycle_reads_its_page_twice(spark, tmp_path):
    """Once the key columns, once the rows, however much is written from them."""
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    run_keyset(store, spec_for(), good(spark, *[(i, "I", i) for i in range(1, 21)]))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    page = good(spark, *[(i, "U" if i % 3 else "D", i % 25) for i in range(21, 61)]).coalesce(1)
    page = page.mapInArrow(counted, page.schema)
    run_cycle(store, spec_for(), page)
    assert reads.value == 2 * 40


def test_requeue_leaves_old_history_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"), buckets=4)
    spec, changes = spec_for(queue=True), seed(spark)
    run_queue(store, spec, changes)
    before = store.latest().segments["history"]
    requeue(store, spec, spark.createDataFrame([(2001,)], "order_id int"))
    fixed = changes.withColumn("order_month", F.when(F.col("change_id") == 9, "10").otherwise(F.col("order_month")))
    run_queue(store, spec, fixed)
    after = store.latest().segments["history"]
    assert after[: len(before)] == before and len(after) == len(before) + 1
    assert history_of(store)[9] == "INSERTED" and store.read("history").count() == 17
    history = history_of(store)
    commit = store.compact_history()
    assert len(commit.segments["history"]) == 1
    store.vacuum(keep=1)
    assert history_of(store) == history and store.read("history").count() == 17
    assert store.compact_history() == commit


def test_overlapping_segments():
    s = lambda low, high: {"low": str(low), "high": str(high)}
    assert overlapping([s(5, 9), s(10, 12), s(100, 200)], "bigint") == [[s(5, 9)], [s(10, 12)], [s(100, 200)]]
    assert overlapping([s(11, 20), s(5, 9), s(9, 12), s(-3, 4)], "bigint") == [[s(-3, 4)], [s(5, 9), s(9, 12), s(11, 20)]]
    assert overlapping([s("a", "b"), s("B", "C")], "string") == [[s("B", "C")], [s("a", "b")]]
    assert overlapping([], "bigint") == []


def test_a_trace_skips_most_of_the_history(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_keyset(store, spec_for(link=None), generate_changes(spark, 3_000))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    history = store.read("history")
    assert history.count() == 3_330
    trace = history.where("order_id = 100")
    assert scanned(trace) < 0.6 * 3_330
    assert [r.outcome for r in trace.orderBy("change_id").collect()] == ["INSERTED", "UPDATED", "DELETED"]


def test_nth_key(spark):
    frames = {
        "bigint": spark.range(20_000).select((F.col("id") * 7 - 5).alias("k")),
        "timestamp": spark.range(9_000).select(F.timestamp_micros(F.col("id") * 1_000_003).alias("k")),
        "date": spark.range(500).select(F.date_from_unix_date((F.col("id") / 3).cast("int")).alias("k")),
        "decimal(12,0)": spark.range(100).select((F.col("id") * 10**9).cast("decimal(12,0)").alias("k")),
        "int": spark.range(30).select(F.when(F.col("id") > 2, F.lit(4)).cast("int").alias("k")),
    }
    for kind, rows in frames.items():
        keys = sorted(r.k for r in rows.where("k is not null").collect())
        for n in (1, 2, len(keys) // 2, len(keys) - 1, len(keys), len(keys) + 5):
            border = spark.range(1).select(nth_key(rows, "k", n).alias("k"))
            assert border.schema["k"].dataType.simpleString() == kind
            assert border.first().k == keys[min(n, len(keys)) - 1], (kind, n)
    assert nth_key(spark.range(3).select(F.lit(None).cast("long").alias("k")), "k", 1) is None


def test_stamped_ranges_are_not_scanned(spark, tmp_path):
    path = str(tmp_path / "log")
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    spec = spec_for(queue=True, quarantine=False, link=None)
    first = generate_changes(spark, 30_000).withColumn("processed", F.lit(0))
    first.where("change_id <= 30000 and change_id <> 7777").repartitionByRange(6, "change_id").write.parquet(path)
    run_queue(store, spec, spark.read.parquet(path))
    found = stamps_of(store, store.latest())
    assert found.ranges == [(64, 7743), (7808, 29951)]
    assert found.rest.count() == 3
    assert pending(store, spec, spark.read.parquet(path)).count() == 0

    # A late row in the gap, and new ones behind: only their parts of the log are read.
    late = first.where("change_id in (7777, 30011, 30021)")
    late.coalesce(1).write.mode("append").parquet(path)
    changes = spark.read.parquet(path)
    waiting = pending(store, spec, changes)
    assert ids(waiting) == [7777, 30011, 30021]
    text = waiting._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter .*change_id#\d+L < 64\) OR \(change_id#\d+L > 7743", text)
    left = changes.where(stamps.outside(F.col("change_id"), found.ranges)).select("change_id")
    assert scanned(left) < 18_000  # three of six files lie inside a range, and their statistics say so
    run_queue(store, spec, changes)
    assert pending(store, spec, changes).count() == 0
    assert history_of(store)[7777] == "INSERTED"


def test_stamps_in_many_cycles(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    spec = spec_for(queue=True, link=None, history=False)
    keys = [*range(-70, 70), *range(1_000, 1_200, 3)]
    changes = good(spark, *[(k, "I", abs(k) * 10 + (k < 0)) for k in keys])
    results = run_queue(store, spec, changes, 40)
    assert sum(r.rows_read for r in results) == len(keys)
    assert pending(store, spec, changes).count() == 0 and held(store) == []
    assert len(store.latest().segments["marks"]) <= 9


def test_ranges_of_stamps(spark, monkeypatch):
    monkeypatch.setattr(stamps, "_SPAN", 2)
    monkeypatch.setattr(stamps, "MOST_RANGES", 2)
    keys = [*range(0, 64 * 9), *range(64 * 20, 64 * 21), *range(-128, -64), 64 * 30]
    bits = stamps.bits_of(spark.createDataFrame([(k,) for k in keys], "k int"), "k")
    found = stamps.joined(stamps.longest_ranges(bits))
    assert found[-1] == (0, 64 * 8 - 1)  # two whole spans of four blocks
    assert stamps.joined([(0, 63), (64, 127), (200, 255)]) == [(0, 127), (200, 255)]
    kept, short = stamps.longest([(0, 63), (128, 255), (512, 1023)])
    assert (kept, short) == ([(128, 255), (512, 1023)], [(0, 63)])
    again = stamps.merged(stamps.full_blocks(stamps.without_ranges(bits, kept), short))
    assert {r.block for r in again.collect()} == {-2, 0, 1, 4, 5, 6, 7, 20, 30}


def test_half_the_log_on_one_key_is_cut(spark):
    changes = line_log(spark, "/root/testdata/sf0.01")
    hot = find_hot_keys(changes, ["l_linestatus"], "change_id", STATUS_HOT)
    per_key = {r[0]: r[1] for r in hot.slices.groupBy("l_linestatus").count().collect()}
    assert len(per_key) == 2 and min(per_key.values()) >= 10
    assert hot.most > STATUS_HOT.chain  # chained in more than one level
    spec = line_spec(business_keys=("l_linestatus",), quarantine=False)
    plain = replay(changes, spec, skew=None).groupBy("outcome").count().collect()
    cut = replay(changes, spec, skew=SkewPolicy(hot_rows=1_000, sample=1.0, slice_rows=300, chain=2))
    assert sorted(cut.groupBy("outcome").count().collect()) == sorted(plain)


def test_commit_record_stays_plain(spark, tmp_path):
    store = Store(spark, str(tmp_path / "state"), buckets=2)
    run_queue(store, spec_for(queue=True), seed(spark))
    record = json.loads(store.files.read_text("_commits", store.files.names("_commits")[0]))
    assert record["keys"] == {"history": ["change_id"], "target": ["order_id"], "links": ["summary_id"]}
