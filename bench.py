"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import SparkSession

from tidemark import Store, run_keyset
from tidemark.sources.scratch import shared_dir
from workload.catalog import QUERIES
from workload.logs import order_log, order_spec

HEADLINE = (
    "map_insert",
    "replay_outcomes",
    "replay_without_quarantine",
    "replay_orders",
    "composite_key",
    "replay_hot_keys",
    "apply_final",
    "apply_final_events",
    "apply_composite_key",
    "apply_in_two_cycles",
    "links_cascade",
    "history_rows",
    "history_merge",
    "quarantine_new",
    "mark_done",
    "batch_counts",
    "keyset_next",
    "queue_pending_clean",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cycle(spark: SparkSession, sf_dir: str) -> None:
    """A whole replay with all its writes and the commit."""
    store = Store(spark, f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}", buckets=8)
    run_keyset(store, order_spec(), order_log(spark, sf_dir))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cpus)
    names = [n for n in sys.argv[1:] if n in QUERIES] or list(HEADLINE)
    drain(QUERIES["replay_outcomes"](spark, sf_dir))  # start-up is not what is measured
    seconds = {name: timed(lambda n=name: drain(QUERIES[n](spark, sf_dir))) for name in names}
    if not sys.argv[1:]:
        seconds["keyset_cycle_with_commit"] = timed(lambda: cycle(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
