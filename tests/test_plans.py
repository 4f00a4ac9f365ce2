"""Shape of the physical plans."""

import re

from pyspark.sql import functions as F

from tests.seed import good, seed
from tidemark import SkewPolicy, apply_final, replay
from tidemark.examples.orders import orders_spec
from tidemark.operators import audit
from tidemark.operators.links import dense_ids
from tidemark.sources.changelog import keyset_page, queue_page


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


def test_replay_has_one_exchange_on_the_business_key(spark):
    text = plan(replay(seed(spark).repartition(2), orders_spec()).select("change_id", "outcome"))
    assert exchanges(text).count("hashpartitioning") == 1
    assert "Exchange hashpartitioning(order_id" in text
    assert text.count("Window [") == 2 and text.count("+- Sort [") == 1


def test_final_image_adds_no_exchange_and_no_sort(spark, tmp_path):
    log = str(tmp_path / "log")
    seed(spark).write.parquet(log)
    text = plan(apply_final(spark.read.parquet(log), orders_spec()))
    assert exchanges(text) == ["hashpartitioning"]
    assert text.count("+- Sort [") == 1 and "SortAggregate" in text


def test_scan_reads_only_what_outcomes_need(spark, tmp_path):
    log = str(tmp_path / "log")
    seed(spark).write.parquet(log)
    text = plan(replay(spark.read.parquet(log), orders_spec()).select("change_id", "outcome"))
    assert "processed" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    totals = plan(audit.outcome_totals(replay(spark.read.parquet(log), orders_spec())))
    assert "partial_count" in totals


def test_keyset_filter_reaches_the_scan(spark, tmp_path):
    log = str(tmp_path / "log")
    seed(spark).write.parquet(log)
    text = plan(keyset_page(spark.read.parquet(log), orders_spec(), 5, 3))
    assert "GreaterThan(change_id,5)" in text and "LessThanOrEqual(change_id,8)" in text


def test_queue_filter_reaches_the_scan(spark, tmp_path):
    log = str(tmp_path / "log")
    seed(spark).write.parquet(log)
    text = plan(queue_page(spark.read.parquet(log), orders_spec(processed_column="processed")))
    assert "EqualTo(processed,0)" in text


def test_no_row_level_data_in_a_single_partition(spark):
    spec = orders_spec()
    outcomes = replay(seed(spark), spec)
    for df in (outcomes, apply_final(seed(spark), spec), audit.history_rows(outcomes, spec)):
        assert "SinglePartition" not in plan(df)
    # Ranks gather one row per range partition there, nothing else.
    text = plan(dense_ids(outcomes, spec))
    assert text.count("Exchange SinglePartition") == 1
    assert "partial_count(1)" in text.split("Exchange SinglePartition")[1]


def test_hot_keys_are_cut_into_slices(spark):
    log = good(spark, *[(i, "U", 1) for i in range(400)], *[(i, "I", i) for i in range(400, 420)])
    hot = SkewPolicy(hot_rows=100, sample=1.0, slice_rows=50)
    outcomes = replay(log, orders_spec(), skew=hot)
    text = plan(outcomes)
    assert "hashpartitioning(order_id" in text and "_slice" in text
    assert "BroadcastHashJoin" in text
    assert outcomes.where(F.col("outcome") == "UPDATED").count() == 400
