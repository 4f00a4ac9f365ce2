"""The replay loop as a structured stream: each micro-batch of files is one cycle."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.cycle import CycleResult, run_cycle
from ..plans.files import Files
from ..plans.store import Store
from ..spec import ChangeSpec


def read_change_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    source: str = "parquet",
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Change files appended to a folder; the limits bound a micro-batch."""
    reader = spark.readStream.format(source).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def apply_batch(
    store: Store, spec: ChangeSpec, batch: DataFrame, name: str, batch_id: int, late_rows: str = "keep", **options: Any
) -> CycleResult | None:
    """One micro-batch. A batch of this stream that is committed already is left alone.

    Rows inside the batch are put in key order by the replay. Rows at or below the committed
    key came too late for keyset paging: they are not applied, but kept in the table ``late``. With ``late_rows="apply"``
    the stream goes by the rules of a queue instead: late rows are applied with their batch, after the higher
    keys of earlier ones.
    """
    if late_rows not in ("keep", "apply"):
        raise ValueError("late_rows must be 'keep' or 'apply'")
    base = store.latest()
    if base.streams.get(name, -1) >= batch_id:
        return None
    batch = spec.canonical(batch)
    last, late = base.last_key_literal(), None
    if last is not None and late_rows == "keep":
        late = batch.where(F.col(spec.order_key) <= last)
        batch = batch.where((F.col(spec.order_key) > last) | F.col(spec.order_key).isNull())
    return run_cycle(store, spec, batch, base=base, stream=(name, batch_id), late=late, **options)


def stream_id(spark: SparkSession, checkpoint: str, name: str) -> str:
    """A stream is known by its name and the id in its checkpoint: a new checkpoint counts from 0 again."""
    text = Files(spark, checkpoint).read_text("metadata")
    return f"{name}:{json.loads(text)['id']}"


def run_stream(
    store: Store,
    spec: ChangeSpec,
    changes: DataFrame,
    checkpoint: str,
    name: str = "changes",
    every: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start the stream: once through what is there, or a cycle ``every`` so often."""

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_batch(store, spec, batch, stream_id(store.spark, checkpoint, name), batch_id, **options)

    writer = changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
