"""Business keys that hold too many changes for one task, and how to cut them up."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from .names import own
from .ranks import with_rank

SLICE, _BLOCK, _OF_BLOCK = own("slice"), own("block"), own("of_block")
_LOW, _HIGH = own("low"), own("high")
_POINTS_PER_SLICE = 32
# Fixed value: parts of a block of slices.
_FAN = 16


@dataclass(frozen=True)
class SkewPolicy:
    """When a key's changes are spread over several tasks.

    ``hot_rows``: estimated changes from which a key counts as hot.
    ``sample``: share of rows looked at to estimate. It steers layout only, never results.
    ``slice_rows``: changes per slice of a hot key.
    ``chain``: slices of a key that are chained in one task; more are chained level by level.
    """

    hot_rows: int = 10_000_000
    sample: float = 0.001
    slice_rows: int = 5_000_000
    chain: int = 4_096


DEFAULT_SKEW = SkewPolicy()


@dataclass(frozen=True)
class HotKeys:
    """The slices of the hot keys: a stored table with a row per slice and the order keys between which it lies.

    ``most`` is the number of slices of the hottest key. ``null_safe`` tells whether a key with a null is among
    them; a plain comparison of key columns is a good deal faster. What is chained is kept in ``scratch``.
    """

    slices: DataFrame
    most: int
    chain: int
    null_safe: bool
    scratch: Scratch


def _bernoulli(rows: DataFrame, share: float, seed: int) -> DataFrame:
    return rows.sample(fraction=share, seed=seed) if share < 1 else rows


def find_hot_keys(
    rows: DataFrame, keys: Sequence[str], order: str, policy: SkewPolicy, scratch: Scratch | None = None
) -> HotKeys | None:
    """Hot keys and their slices; None if no key is hot.

    Two passes over samples of the key columns. Only the borders of slices come from the samples, so any
    draw gives the same results. There are at most rows / ``hot_rows`` hot keys and, beyond one for each, about rows /
    ``slice_rows`` slices. They stay in stored tables, so that every later use of them, and every retry, cuts
    alike; what comes to the driver is their largest number.
    """
    scratch = scratch or Scratch(rows.sparkSession)
    keys = list(keys)
    sample = _bernoulli(rows.select(*keys), policy.sample, seed=17)
    least = max(1, math.ceil(policy.hot_rows * policy.sample))
    counts = sample.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    hot = scratch.write(counts.select(*keys))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    found = hot.agg(F.count("*").alias("n"), F.max(any_null).alias("nulls")).first()
    if not found["n"]:
        return None
    null_safe = bool(found["nulls"])

    columns = rows.select(*keys, F.col(order).alias("_at")).where(F.col("_at").isNotNull())
    per_slice = max(1, min(_POINTS_PER_SLICE, policy.slice_rows))
    points = match_keys(_bernoulli(columns, per_slice / policy.slice_rows, seed=23), hot, keys, "inner", null_safe)
    # Every per_slice-th point of a key, in order, begins a new slice. Ranks run over all keys; a key's own begin at its first.
    ranked = with_rank(points, [*keys, "_at"], scratch)
    first = ranked.groupBy(*keys).agg(F.min("rank").alias("_first"))
    own_rank = match_keys(ranked, first, keys, "inner", null_safe)
    nth = F.col("rank") - F.col("_first") + 1
    borders = own_rank.where(nth % per_slice == 0).select(*keys, (nth / per_slice).cast("int").alias(SLICE), F.col("_at").alias(_LOW))
    open_ends = hot.select(*keys, F.lit(0).alias(SLICE), F.lit(None).cast(columns.schema["_at"].dataType).alias(_LOW))
    following = Window.partitionBy(*keys).orderBy(SLICE)
    slices = open_ends.unionByName(borders).withColumn(_HIGH, F.lead(_LOW).over(following))
    slices = scratch.write(slices)
    return HotKeys(slices, slices.agg(F.max(SLICE)).first()[0] + 1, policy.chain, null_safe, scratch)


def match_keys(
    rows: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool,
    also: Column | None = None,
) -> DataFrame:
    """Join a table of hot keys or their slices on the key columns, and on ``also`` if given.

    ``small`` is broadcast where Spark finds it small enough; where not, AQE splits the hot keys' side.
    """
    renamed = small.withColumnsRenamed({k: own(f"s_{k}") for k in keys})
    condition = F.lit(True) if also is None else also
    for k in keys:
        left, right = F.col(k), F.col(own(f"s_{k}"))
        condition = condition & (left.eqNullSafe(right) if null_safe else left == right)
    return rows.join(renamed, condition, how).drop(*[own(f"s_{k}") for k in keys])


def with_slice(rows: DataFrame, hot: HotKeys, keys: Sequence[str], order: str) -> DataFrame:
    """Add the slice number of each row of a hot key; null for ordinary keys.

    Slice n holds the rows from its lower border up to the next one's; rows without an order key come
    first. The right one is found from the top of a tree down: blocks of blocks of slices, then one of the at most
    ``_FAN`` parts of the block found. A row so meets ``_FAN`` candidates a level, whatever the number of slices.
    """
    levels = 1
    while _FAN**levels < hot.most:
        levels += 1
    at, low, high = F.col(order), F.col(_LOW), F.col(_HIGH)
    inside = low.isNull() | F.coalesce(at >= low, F.lit(False))
    inside = inside & (high.isNull() | F.coalesce(at < high, F.lit(True)))
    of_block = F.floor(F.col(SLICE) / _FAN).cast("int").alias(_OF_BLOCK)
    for level in reversed(range(levels)):
        parts = hot.slices
        if level:
            # A block is open below where its first slice is, and above where its last one is.
            first, last = F.min_by(_LOW, SLICE), F.max_by(_HIGH, SLICE)
            block = F.floor(F.col(SLICE) / _FAN**level).cast("int")
            parts = parts.groupBy(*keys, block.alias(_BLOCK)).agg(first.alias(_LOW), last.alias(_HIGH))
            parts = parts.withColumnRenamed(_BLOCK, SLICE)
        parts = parts.select(*keys, SLICE, of_block, _LOW, _HIGH)
        if level == levels - 1:
            rows = match_keys(rows, parts, keys, "left", hot.null_safe, inside)
        else:
            rows = rows.withColumnRenamed(SLICE, _BLOCK)
            rows = match_keys(rows, parts, keys, "left", hot.null_safe, inside & (F.col(_BLOCK) == F.col(_OF_BLOCK)))
        rows = rows.drop(_LOW, _HIGH, _BLOCK, _OF_BLOCK)
    return rows
