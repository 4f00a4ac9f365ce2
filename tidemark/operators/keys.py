"""Business key helpers: composite keys, with null equal to null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool = True,
) -> DataFrame:
    """Semi or anti join of ``left`` on the key columns.

    Catalyst and AQE choose how by the measured size of the right side, and AQE splits
    partitions of ``left`` that a hot key has made too large.
    """
    l, r = left.alias("l"), right.select(*keys).alias("r")
    parts = []
    for k in keys:
        a, b = F.col(f"l.`{k}`"), F.col(f"r.`{k}`")
        parts.append(a.eqNullSafe(b) if null_safe else a == b)
    return l.join(r, reduce(lambda a, b: a & b, parts), how).select("l.*")


def key_types_of(df: DataFrame, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cast key columns to the types they have in ``like``."""
    return df.select(*[F.col(k).cast(like.schema[k].dataType).alias(k) for k in keys])


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def key_to_text(key: Column, kind: str) -> Column:
    """An order key as it is recorded: instants in microseconds, so that no time zone comes in."""
    return F.unix_micros(key).cast("string") if kind == "timestamp" else key.cast("string")


def text_to_key(text: Column | str, kind: str) -> Column:
    """The order key that :func:`key_to_text` has written."""
    text = F.lit(text) if isinstance(text, str) else text
    return F.timestamp_micros(text.cast("long")) if kind == "timestamp" else text.cast(kind)
