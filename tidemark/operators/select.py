"""The n-th smallest key by counting: no sort, no exchange of rows, nothing written."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4_096  # ranges that keys are counted in, and keys that are looked at one by one in the end


def ordinal(key: str, kind: T.DataType) -> tuple[Column, Any] | None:
    """The key as a long in the same order, and the way back; None for types that have no such number."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(key).cast("long"), lambda n: F.lit(n).cast(kind)
    if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 18:
        return F.col(key).cast("long"), lambda n: F.lit(n).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key), lambda n: F.timestamp_micros(F.lit(n))
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long"), lambda n: F.date_from_unix_date(F.lit(n).cast("int"))
    return None


def nth_key(rows: DataFrame, key: str, n: int) -> Column | None:
    """The ``n``-th smallest key of ``rows``, repeated ones counted each; the greatest if there are fewer. None: no keys.

    Keys are counted per range of equal width, then within the range that holds the n-th, until few are left there. Each
    round aggregates into at most ``BINS`` rows and reads only the key column, the later ones only from that range.
    """
    number, back = ordinal(key, rows.schema[key].dataType)
    keys = rows.select(F.col(key), number.alias("_n")).where(F.col(key).isNotNull())
    ends = keys.agg(F.min("_n"), F.max("_n"), F.count("*")).first()
    if not ends[2]:
        return None
    low, high, count = ends
    if n >= count:
        return back(high)
    while count > BINS and high > low:
        width = (high - low) // BINS + 1
        within = keys.where((F.col(key) >= back(low)) & (F.col(key) <= back(high)))
        bins = within.groupBy(F.floor((F.col("_n") - low) / width).alias("bin")).count().collect()
        for b, size in sorted((r[0], r[1]) for r in bins):
            if n <= size:
                low, high, count = low + b * width, min(high, low + (b + 1) * width - 1), size
                break
            n -= size
    if high == low:
        return back(low)
    within = keys.where((F.col(key) >= back(low)) & (F.col(key) <= back(high))).select("_n")
    return back(sorted(r[0] for r in within.collect())[n - 1])  # at most BINS keys
