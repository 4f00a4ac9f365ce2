"""Cycles over stored state: golden seed, crash, resume, requeue, restart, vacuum."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests.seed import TARGET, good, order_row, seed, SCHEMA
from tidemark import OrderKeyError, Store, apply_batch, requeue, run_cycle, run_keyset, run_queue
from tidemark.examples.orders import orders_spec
from tidemark.operators.names import OUTCOMES
from tidemark.plans.cycle import pending
from tidemark.plans.store import CommitConflict

EXPECTED_ON = (
    ["INSERTED"] * 5 + ["UPDATED"] * 2 + ["DELETED"] + ["FAILED"] * 2 + ["SKIPPED_QUARANTINED"] * 7
)
EXPECTED_OFF = (
    ["INSERTED"] * 5 + ["UPDATED"] * 2 + ["DELETED"] + ["FAILED"] * 2
    + ["UPDATED"] * 2 + ["INSERTED"] * 2 + ["UPDATED"] + ["DELETED"] * 2
)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "state"), buckets=4)


def spec_for(queue=False, quarantine=True, **changed):
    return orders_spec(processed_column="processed" if queue else None, quarantine=quarantine, **changed)


def target_of(store):
    rows = store.read("target").collect()
    return {
        r.order_id: (r.customer_name, str(r.order_date), r.total_amount, r.status, r.region) for r in rows
    }


def history_of(store):
    return {r.change_id: r.outcome for r in store.read("history").collect()}


def held(store):
    return sorted(r.order_id for r in store.read("quarantine").collect())


def ids(df):
    return sorted(r.change_id for r in df.select("change_id").collect())


def check_links(store):
    links = store.read("links").collect()
    target = {r.summary_id for r in store.read("target").collect()}
    assert sorted(r.summary_id for r in links) == sorted(target)
    assert len({r.link_id for r in links}) == len(links)


@pytest.mark.parametrize("quarantine", [True, False])
@pytest.mark.parametrize("batch", [4, 12, None])
def test_seed_keyset(spark, store, batch, quarantine):
    log = seed(spark)
    results = run_keyset(store, spec_for(quarantine=quarantine), log, batch)
    expected = EXPECTED_ON if quarantine else EXPECTED_OFF
    assert history_of(store) == dict(enumerate(expected, start=1))
    assert target_of(store) == TARGET
    check_links(store)
    if quarantine:
        assert held(store) == [2001, 2002]
    else:
        assert store.read("quarantine") is None
    assert results[-1].total == 17 and results[-1].last_key == "17"
    assert sum(r.failed for r in results) == 2
    # The resume point stays: nothing is replayed twice.
    assert run_keyset(store, spec_for(quarantine=quarantine), log, batch) == []
    assert target_of(store) == TARGET


@pytest.mark.parametrize(
    "batch, recorded",
    [(None, range(1, 18)), (12, range(1, 13)), (10, range(1, 11)), (5, range(1, 11))],
)
def test_seed_queue_with_quarantine(spark, store, batch, recorded):
    spec, log = spec_for(queue=True), seed(spark)
    run_queue(store, spec, log, batch)
    assert history_of(store) == {i: EXPECTED_ON[i - 1] for i in recorded}
    assert target_of(store) == TARGET
    assert held(store) == [2001, 2002]
    assert ids(pending(store, spec, log)) == list(range(9, 18))
    check_links(store)


@pytest.mark.parametrize("batch", [None, 7])
def test_seed_queue_without_quarantine(spark, store, batch):
    spec, log = spec_for(queue=True, quarantine=False), seed(spark)
    run_queue(store, spec, log, batch)
    assert history_of(store) == dict(enumerate(EXPECTED_OFF, start=1))
    assert target_of(store) == TARGET
    assert ids(pending(store, spec, log)) == []


def test_requeue_fails_again_until_the_data_is_fixed(spark, store):
    spec, log = spec_for(queue=True), seed(spark)
    run_queue(store, spec, log)
    cleared = spark.createDataFrame([(2001,)], "order_id int")
    requeue(store, spec, cleared)
    assert held(store) == [2002]
    run_queue(store, spec, log)
    assert history_of(store)[9] == "FAILED"
    assert held(store) == [2001, 2002]

    requeue(store, spec, cleared)
    fixed = log.withColumn("order_month", F.when(F.col("change_id") == 9, "10").otherwise(F.col("order_month")))
    run_queue(store, spec, fixed)
    # 13 inserts a key that 9 has put there, so the key is held again.
    got = history_of(store)
    assert [got[i] for i in (9, 11, 12, 13, 16)] == [
        "INSERTED", "UPDATED", "UPDATED", "FAILED", "SKIPPED_QUARANTINED",
    ]
    assert len(store.read("history").collect()) == 17
    assert target_of(store)[2001][0] == "Still Blocked"


def test_duplicate_insert_in_one_cycle_keeps_both_pending(spark, store):
    spec, log = spec_for(queue=True), good(spark, (1, "I", 7), (2, "I", 7))
    run_queue(store, spec, log)
    assert history_of(store) == {1: "INSERTED", 2: "FAILED"}
    assert ids(pending(store, spec, log)) == [1, 2]
    requeue(store, spec, spark.createDataFrame([(7,)], "order_id long"))
    run_queue(store, spec, log)
    assert history_of(store) == {1: "FAILED", 2: "SKIPPED_QUARANTINED"}


def test_duplicate_insert_with_batch_of_one(spark, store):
    spec, log = spec_for(queue=True), good(spark, (1, "I", 7), (2, "I", 7))
    run_queue(store, spec, log, 1)
    assert history_of(store) == {1: "INSERTED", 2: "FAILED"}
    assert ids(pending(store, spec, log)) == [2]


def test_applied_done_stamps_what_took_effect(spark, store):
    spec = spec_for(queue=True, mark_policy="applied_done")
    log = good(spark, (1, "I", 7), (2, "I", 7))
    run_queue(store, spec, log)
    assert ids(pending(store, spec, log)) == [2]


def test_late_lower_key_in_queue_mode(spark, store):
    spec = spec_for(queue=True)
    run_queue(store, spec, good(spark, (5, "I", 7)))
    run_queue(store, spec, good(spark, (3, "D", 7), (5, "I", 7)))
    assert history_of(store) == {3: "DELETED", 5: "INSERTED"}
    assert target_of(store) == {}
    assert store.read("links").count() == 0


def test_restart_replays_over_the_finished_state(spark, store):
    spec, log = spec_for(), seed(spark)
    run_keyset(store, spec, log)
    run_keyset(store, spec, log, restart=True)
    got = history_of(store)
    assert [got[i] for i in (1, 2, 3, 5)] == ["FAILED"] * 4
    assert (got[4], got[8]) == ("INSERTED", "DELETED")
    assert {got[i] for i in (6, 7, *range(9, 18))} == {"SKIPPED_QUARANTINED"}
    assert target_of(store) == TARGET
    assert store.latest().rows == 34


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["history", "quarantine", "target", "links"])
def test_crash_before_the_commit_changes_nothing(spark, store, step):
    spec, log = spec_for(), seed(spark)
    run_keyset(store, spec, log, 4, max_cycles=1)
    before = store.latest()

    def stop(name):
        if name == step:
            raise Crash

    with pytest.raises(Crash):
        run_keyset(store, spec, log, on_step=stop)
    assert store.latest() == before
    assert sorted(target_of(store)) == [1001, 1002, 1003, 1004]
    run_keyset(store, spec, log)
    assert target_of(store) == TARGET
    assert history_of(store) == dict(enumerate(EXPECTED_ON, start=1))
    check_links(store)


def test_two_writers_conflict(spark, store):
    spec, log = spec_for(), seed(spark)
    base = store.latest()
    run_cycle(store, spec, log, base=base)
    with pytest.raises(CommitConflict):
        run_cycle(store, spec, good(spark, (1, "I", 7)), base=base)
    assert target_of(store) == TARGET and len(store.read("history").collect()) == 17
    # What the loser wrote goes with the next clean-up.
    assert {d.split("/")[0] for d in store.vacuum(keep=1)} == {"target", "links", "history"}
    assert target_of(store) == TARGET
    check_links(store)


def test_committed_batch_is_skipped(spark, store):
    spec = spec_for()
    assert apply_batch(store, spec, good(spark, (1, "I", 7)), "s", 0).inserted == 1
    assert apply_batch(store, spec, good(spark, (1, "I", 7)), "s", 0) is None
    # Late rows are counted, not applied.
    apply_batch(store, spec, good(spark, (1, "I", 9), (2, "I", 8)), "s", 1)
    assert sorted(target_of(store)) == [7, 8]
    assert store.latest().late == 1
    apply_batch(store, spec, good(spark, (1, "I", 9)), "s", 2)
    assert store.latest().late == 2


def test_order_key_must_be_set_and_unique(spark, store):
    spec = spec_for()
    with pytest.raises(OrderKeyError):
        run_keyset(store, spec, good(spark, (1, "I", 7), (1, "I", 8)))
    blank = good(spark, (1, "I", 7)).withColumn("change_id", F.lit(None).cast("long"))
    with pytest.raises(OrderKeyError):
        run_keyset(store, spec, blank)
    with pytest.raises(ValueError):
        run_keyset(store, spec, good(spark, (1, "I", 7)), 0)


def test_timestamp_order_key_resumes(spark, store):
    spec = spec_for(order_key="at", link=None)
    def at(log):
        return log.withColumn("at", F.timestamp_seconds(F.col("change_id") * 86400 + 0.25)).drop("change_id")

    log = at(seed(spark))
    run_keyset(store, spec, log, 6, max_cycles=1)
    assert store.latest().key_type == "timestamp"
    run_keyset(store, spec, log)
    assert target_of(store) == TARGET
    assert store.latest().rows == 17


def test_vacuum_keeps_what_the_last_commits_use(spark, store):
    spec, log = spec_for(), seed(spark)
    run_keyset(store, spec, log, 7)
    history = history_of(store)
    assert store.vacuum(keep=1)
    assert len(store.versions()) == 1
    assert target_of(store) == TARGET and history_of(store) == history
    check_links(store)


def test_rows_carry_the_time_of_their_last_write(spark, store):
    spec = spec_for(stamped=True)
    run_keyset(store, spec, good(spark, (1, "I", 7), (2, "I", 8)))
    first = {r.order_id: r.synced_at for r in store.read("target").collect()}
    run_keyset(store, spec, good(spark, (3, "U", 7)))
    second = {r.order_id: r.synced_at for r in store.read("target").collect()}
    assert second[7] > first[7] and second[8] == first[8]


def test_history_off(spark, store):
    spec = spec_for(history=False)
    run_keyset(store, spec, seed(spark), 9)
    assert store.read("history") is None
    assert target_of(store) == TARGET
    assert held(store) == [2001, 2002]


def test_unknown_operation_never_stalls_the_queue(spark, store):
    spec = spec_for(queue=True)
    rows = [order_row(1, "a long flag", 7), order_row(2, None, 7), order_row(3, "i", 7)]
    log = spark.createDataFrame(rows, SCHEMA)
    run_queue(store, spec, log)
    records = {r.change_id: r for r in store.read("history").collect()}
    assert {r.outcome for r in records.values()} == {"SKIPPED_BADROW"}
    assert all(r.order_id is None for r in records.values())
    assert records[1].detail == "unknown operation value 'a long flag'"
    assert (records[2].operation, records[2].detail) == ("", "unknown operation value ''")
    assert ids(pending(store, spec, log)) == []


def test_every_outcome_is_known():
    assert set(EXPECTED_ON) | set(EXPECTED_OFF) <= set(OUTCOMES)


def test_commit_record_is_plain_json(spark, store, tmp_path):
    run_keyset(store, spec_for(), seed(spark))
    name = store.files.names("_commits")[0]
    record = json.loads(store.files.read_text("_commits", name))
    assert record["last_key"] == "17" and record["rows"] == 17
    assert uuid.uuid4().hex not in name


@pytest.mark.parametrize("quarantine", [True, False])
def test_random_log_in_cycles_with_hot_keys(spark, store, quarantine):
    """Stored cycles over a skewed log against the sequential model."""
    from tests import model
    from tests.test_replay import SOME_HOT, frame, log, spec_for as random_spec
    from tidemark import Column, Link

    schema = {"parent": Column("bigint"), "who": Column("string")}
    link = Link({"parent": ":NEW_ID", "who": ":WHO"}, schema, {"WHO": "x"})
    spec = random_spec(link=link, quarantine=quarantine)
    rows = sorted(log(5, 300, 12), key=lambda r: r["id"])
    outcomes, target, blocked, links = model.run(rows, quarantine_on=quarantine)
    results = run_keyset(store, spec, frame(spark, rows), 170, skew=SOME_HOT)
    assert [r.rows_read for r in results] == [170, 130]
    assert {r.id: r.outcome for r in store.read("history").collect()} == outcomes
    got = {(r.k1, r.k2): {"id": r.row_id, "a": r.a, "b": r.b} for r in store.read("target").collect()}
    assert got == target
    assert {r.parent: r.link_id for r in store.read("links").collect()} == links
    if quarantine:
        assert {(r.k1, r.k2) for r in store.read("quarantine").collect()} == blocked


def test_key_type_of_a_later_page_may_differ(spark, store):
    spec = spec_for()
    run_keyset(store, spec, good(spark, (1, "I", 7)))
    later = good(spark, (2, "U", 7), (3, "D", 8)).withColumn("order_id", F.col("order_id").cast("int"))
    run_keyset(store, spec, later)
    assert sorted(target_of(store)) == [7]
    assert history_of(store) == {1: "INSERTED", 2: "UPDATED", 3: "DELETED"}


@pytest.mark.parametrize("size, queue", [(2, False), (None, False), (2, True)])
@pytest.mark.parametrize("keys", [(1, 2, 2, 3), (1, 2, None, 3)])
def test_null_and_repeated_keys_are_refused(spark, store, size, queue, keys):
    """Whatever the size of a page, and wherever its border falls."""
    log = good(spark, *[(k or 0, "I", n) for n, k in enumerate(keys)])
    log = log.withColumn("change_id", F.when(F.col("change_id") != 0, F.col("change_id")))
    run = run_queue if queue else run_keyset
    with pytest.raises(OrderKeyError):
        run(store, spec_for(queue=queue), log, batch_size=size)


def test_a_null_key_that_comes_later_is_refused(spark, store):
    run_keyset(store, spec_for(), good(spark, (1, "I", 1)))
    log = good(spark, (1, "I", 1), (2, "I", 2)).withColumn("change_id", F.when(F.col("change_id") == 1, F.col("change_id")))
    with pytest.raises(OrderKeyError):
        run_keyset(store, spec_for(), log)


def test_timestamps_resume_in_any_time_zone(spark, store):
    log = good(spark, *[(n, "I", n) for n in range(12)])
    log = log.withColumn("change_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("change_id") * 3600))
    spec = spec_for()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        run_keyset(store, spec, log, batch_size=4, max_cycles=1)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        run_keyset(store, spec, log, batch_size=4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(r.order_id for r in store.read("target").collect()) == list(range(12))


def test_the_resume_key_does_not_go_back(spark, store):
    spec = spec_for(queue=True)
    run_queue(store, spec, good(spark, (9, "I", 1), (10, "I", 2)))
    run_queue(store, spec, good(spark, (9, "I", 1), (10, "I", 2), (3, "I", 3)))
    assert store.latest().last_key == "10"
    assert sorted(target_of(store)) == [1, 2, 3]


def test_a_new_checkpoint_counts_from_the_start(spark, store):
    spec = spec_for()
    assert apply_batch(store, spec, good(spark, (1, "I", 1)), "a:1", 5) is not None
    assert apply_batch(store, spec, good(spark, (2, "I", 2)), "a:1", 5) is None
    assert apply_batch(store, spec, good(spark, (3, "I", 3)), "a:2", 0) is not None
    assert apply_batch(store, spec, good(spark, (2, "I", 2), (4, "I", 4)), "a:2", 1) is not None
    assert sorted(target_of(store)) == [1, 3, 4]
    assert [r.order_id for r in store.read("late").collect()] == [2]
