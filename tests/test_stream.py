"""The streaming loop against the batch run over the same files."""

import pytest

from tests.seed import TARGET, good, seed
from tests.test_state import EXPECTED_ON, history_of, held, target_of
from tidemark import Store, apply_batch, read_change_stream, run_keyset, run_stream
from tidemark.examples.orders import orders_spec


def append(log, folder, low, high):
    log.where(f"change_id between {low} and {high}").coalesce(1).write.mode("append").parquet(folder)


def drain(store, spec, folder, schema, checkpoint, **options):
    stream = read_change_stream(store.spark, folder, schema, max_files=1)
    query = run_stream(store, spec, stream, checkpoint, **options)
    query.awaitTermination(300)
    assert query.exception() is None


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / name) for name in ("state", "log", "checkpoint")]


def test_stream_equals_batch(spark, places, tmp_path):
    state, folder, checkpoint = places
    spec, log = orders_spec(), seed(spark)
    store = Store(spark, state, buckets=4)
    for low, high in ((1, 6), (7, 10)):
        append(log, folder, low, high)
    drain(store, spec, folder, log.schema, checkpoint)
    assert len(store.versions()) == 2
    # The next start goes on after the last committed key.
    append(log, folder, 11, 17)
    drain(store, spec, folder, log.schema, checkpoint)
    assert len(store.versions()) == 3

    batch = Store(spark, str(tmp_path / "batch"), buckets=4)
    run_keyset(batch, spec, spark.read.schema(log.schema).parquet(folder))
    assert history_of(store) == history_of(batch) == dict(enumerate(EXPECTED_ON, start=1))
    assert target_of(store) == target_of(batch) == TARGET
    assert held(store) == held(batch)
    assert store.latest().last_key == batch.latest().last_key == "17"


def test_crash_in_a_micro_batch_is_made_good(spark, places):
    state, folder, checkpoint = places
    spec, log = orders_spec(), seed(spark)
    store = Store(spark, state, buckets=4)
    append(log, folder, 1, 6)
    append(log, folder, 7, 17)
    crashed = []

    def stop(step):
        if step == "target" and store.latest().version == 1 and not crashed:
            crashed.append(step)
            raise RuntimeError("stop here")

    stream = read_change_stream(spark, folder, log.schema, max_files=1)
    query = run_stream(store, spec, stream, checkpoint, on_step=stop)
    with pytest.raises(Exception, match="stop here"):
        query.awaitTermination(300)
    assert crashed and store.latest().version == 1
    drain(store, spec, folder, log.schema, checkpoint)
    assert history_of(store) == dict(enumerate(EXPECTED_ON, start=1))
    assert target_of(store) == TARGET


def test_late_files_are_counted(spark, places):
    state, folder, checkpoint = places
    spec, log = orders_spec(), good(spark, *[(i, "I", 100 + i) for i in range(1, 9)])
    store = Store(spark, state, buckets=4)
    append(log, folder, 5, 8)
    drain(store, spec, folder, log.schema, checkpoint)
    append(log, folder, 1, 4)
    drain(store, spec, folder, log.schema, checkpoint)
    assert sorted(target_of(store)) == [105, 106, 107, 108]
    assert store.latest().late == 4


def test_paced_cycles(spark, places):
    state, folder, checkpoint = places
    spec, log = orders_spec(), good(spark, *[(i, "I", i) for i in range(1, 4)])
    store = Store(spark, state, buckets=4)
    append(log, folder, 1, 3)
    stream = read_change_stream(spark, folder, log.schema, max_files=1)
    query = run_stream(store, spec, stream, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(target_of(store)) == 3


def test_late_files_by_the_rules_of_a_queue(spark, places):
    """Late rows are applied with their batch, after higher keys; the resume key does not go back."""
    state, folder, checkpoint = places
    spec, log = orders_spec(), good(spark, (1, "I", 7), (2, "D", 8), (5, "I", 8), (6, "U", 7))
    store = Store(spark, state, buckets=2)
    append(log, folder, 5, 6)
    drain(store, spec, folder, log.schema, checkpoint, late_rows="apply")
    append(log, folder, 1, 2)
    drain(store, spec, folder, log.schema, checkpoint, late_rows="apply")
    assert history_of(store) == {5: "INSERTED", 6: "UPDATED", 1: "INSERTED", 2: "DELETED"}
    assert sorted(target_of(store)) == [7]
    assert store.latest().late == 0 and store.latest().last_key == "6" and store.read("late") is None
    with pytest.raises(ValueError):
        apply_batch(store, spec, log, "s", 0, late_rows="drop")
