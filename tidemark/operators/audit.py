"""Audit trail, quarantine, processed marks and batch reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import DETAIL_LENGTH
from ..sources.scratch import Scratch
from ..spec import ChangeSpec
from .keys import key_join, key_types_of
from .names import (
    DELETED,
    DETAIL,
    FAILED,
    INSERT_FAILED,
    INSERTED,
    LINK_FAILED,
    OP,
    OUTCOME,
    SKIPPED_BADROW,
    UPDATED,
    own,
)
from .ranks import with_rank

RECORDED_AT = "recorded_at"


# -- history ---------------------------------------------------------------


def history_rows(outcomes: DataFrame, spec: ChangeSpec, as_of: datetime | None = None) -> DataFrame:
    """One audit record per change; the key is blank where the operation was unknown."""
    known = F.col(OUTCOME) != SKIPPED_BADROW
    out = [
        F.col(spec.order_key).alias(spec.order_key),
        *[F.when(known, F.col(k)).alias(k) for k in spec.business_keys],
        F.col(OP).alias("operation"),
        F.col(OUTCOME).alias(OUTCOME),
        F.substring(DETAIL, 1, DETAIL_LENGTH).alias(DETAIL),
    ]
    if as_of is not None:
        out.append(F.lit(as_of).alias(RECORDED_AT))
    return outcomes.select(*out)


def record_columns(as_of: datetime) -> dict[str, Column]:
    """The columns of an audit record that follow its keys, from rows that a replay has classified."""
    return {
        "operation": F.col(own(OP)),
        OUTCOME: F.col(own(OUTCOME)),
        DETAIL: F.substring(own(DETAIL), 1, DETAIL_LENGTH),
        RECORDED_AT: F.lit(as_of),
    }


def history_merge(history: DataFrame, fresh: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Upsert on change id: a change that was processed again shows its latest run."""
    return key_join(history, fresh, [spec.order_key], "left_anti", null_safe=False).unionByName(fresh)


def history_trace(history: DataFrame, spec: ChangeSpec, *key) -> DataFrame:
    """Life of one business key in change order."""
    rows = history
    for column, value in zip(spec.business_keys, key, strict=True):
        rows = rows.where(F.col(column).eqNullSafe(F.lit(value)))
    return rows.orderBy(spec.order_key)


def history_for_keys(history: DataFrame, keys: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Records of all listed business keys."""
    return key_join(history, keys.distinct(), list(spec.business_keys), "left_semi")


# -- quarantine ------------------------------------------------------------


def quarantine_keys(quarantine: DataFrame, spec: ChangeSpec) -> DataFrame:
    return quarantine.select(*spec.business_keys).distinct()


def quarantine_new(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Keys whose insert failed for the first time, with the change that did it."""
    failed = outcomes.where(F.col(INSERT_FAILED))
    return failed.groupBy(*spec.business_keys).agg(F.min(spec.order_key).alias(spec.order_key))


def quarantine_merge(quarantine: DataFrame, fresh: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Insert if absent."""
    keys = list(spec.business_keys)
    fresh = key_types_of(fresh, quarantine, keys).distinct()
    return quarantine.select(*keys).unionByName(key_join(fresh, quarantine, keys, "left_anti"))


def quarantine_clear(quarantine: DataFrame, cleared: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Quarantine without the cleared keys."""
    keys = list(spec.business_keys)
    return key_join(quarantine, key_types_of(cleared, quarantine, keys), keys, "left_anti")


# -- processed marks -------------------------------------------------------


def marks(outcomes: DataFrame, quarantine_after: DataFrame | None, spec: ChangeSpec) -> DataFrame:
    """Order keys of the rows to stamp as done.

    Every row that was read counts, except rows whose key is quarantined once the cycle is
    over: they stay pending, to flow again when the key is cleared. With
    ``mark_policy='applied_done'`` rows of such a key that did take effect are stamped too.
    """
    if quarantine_after is None or not spec.quarantine:
        return outcomes.select(spec.order_key)
    settled = F.col(OUTCOME) == SKIPPED_BADROW
    if spec.mark_policy == "applied_done":
        settled = settled | F.col(OUTCOME).isin(INSERTED, LINK_FAILED, UPDATED, DELETED)
    keys = list(spec.business_keys)
    held = key_types_of(quarantine_after, outcomes, keys)
    blocked = held.distinct().select(*[F.col(k).alias(f"_q_{k}") for k in keys], F.lit(True).alias("_held"))
    on = [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    joined = outcomes.join(blocked, condition, "left")
    return joined.where(settled | F.col("_held").isNull()).select(spec.order_key)


def mark_done(changes: DataFrame, done: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The change log with the flag of consumed rows set to done."""
    flag = spec.processed_column
    stamped = done.select(F.col(spec.order_key).alias("_done_key"), F.lit(True).alias("_done"))
    joined = changes.join(stamped, F.col(spec.order_key) == F.col("_done_key"), "left")
    new_flag = F.when(F.col("_done"), F.lit(spec.done).cast(changes.schema[flag].dataType))
    return joined.withColumn(flag, F.coalesce(new_flag, F.col(flag))).select(*changes.columns)


# -- reports ---------------------------------------------------------------


def _counts() -> list[Column]:
    return [
        F.count("*").alias("rows_read"),
        F.count_if(F.col(OUTCOME) == INSERTED).alias("inserted"),
        F.count_if(F.col(OUTCOME) == UPDATED).alias("updated"),
        F.count_if(F.col(OUTCOME) == DELETED).alias("deleted"),
        F.count_if(F.col(OUTCOME) == FAILED).alias("failed"),
    ]


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy(OUTCOME).agg(F.count("*").alias("rows"))


def run_counts(outcomes: DataFrame, *more: Column) -> DataFrame:
    """The counters of one cycle in a single row, and ``more``."""
    return outcomes.agg(*_counts(), *more)


def batch_counts(
    outcomes: DataFrame, spec: ChangeSpec, batch_size: int, scratch: Scratch | None = None
) -> DataFrame:
    """Counters per batch of ``batch_size`` changes in key order, with the batch's last key."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    ranked = with_rank(outcomes.select(spec.order_key, OUTCOME), [spec.order_key], scratch)
    batch = F.floor((F.col("rank") - 1) / F.lit(batch_size)) + 1
    return (
        ranked.withColumn("batch", batch.cast("long"))
        .groupBy("batch")
        .agg(*_counts(), F.max(spec.order_key).alias("last_key"))
    )


def batch_progress(batches: DataFrame, batch_size: int) -> DataFrame:
    """Running total of rows read. Only the last batch can be short, so no window is needed."""
    total = (F.col("batch") - 1) * F.lit(batch_size) + F.col("rows_read")
    return batches.select("batch", "rows_read", total.alias("total"), "last_key")
