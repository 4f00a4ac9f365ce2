"""Which order keys are stamped as done, as ranges and bits.

Whole numbers are kept 64 to a row, a bit for each, and where all keys of a long stretch are stamped, as a range. A
scan leaves the ranges out by a filter that Parquet's statistics know, so stamped parts of a log are not read again. A key
that was not there when its neighbours were stamped has no bit: it is still to come.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import key_join

BLOCK, BITS = "block", "bits"
MOST_RANGES = 64  # ranges that become filters; the longest ones
_SPAN = 16  # as a power of two: numbers that one task looks at for runs


@dataclass(frozen=True)
class Stamps:
    """Stamped keys: ``ranges`` (low, high) of whole numbers that are all stamped, and a table of other ones:
    (block, bits), or the keys themselves where they are no whole numbers.
    """

    ranges: Sequence[tuple[int, int]]
    rest: DataFrame | None


def has_bits(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _block(key: str) -> Column:
    return F.shiftright(F.col(key).cast("long"), 6)


def _bit(key: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(key).cast("long").bitwiseAND(F.lit(63)).cast("int"))


def bits_of(keys: DataFrame, key: str) -> DataFrame:
    """A row for each 64 whole numbers, combined before they are exchanged."""
    return keys.groupBy(_block(key).alias(BLOCK)).agg(F.bit_or(_bit(key)).alias(BITS))


def merged(bits: DataFrame) -> DataFrame:
    return bits.groupBy(BLOCK).agg(F.bit_or(BITS).alias(BITS))


def runs(numbers: DataFrame, number: str) -> DataFrame:
    """Stretches (first, last) of consecutive distinct whole numbers, cut every 2 ** 16."""
    span = F.shiftright(number, _SPAN)
    place = F.row_number().over(Window.partitionBy(span).orderBy(number))
    islands = numbers.select(F.col(number).alias("_n"), (F.col(number) - place).alias("_island"), span.alias("_span"))
    return islands.groupBy("_span", "_island").agg(F.min("_n").alias("first"), F.max("_n").alias("last")).select("first", "last")


def longest_ranges(bits: DataFrame) -> list[tuple[int, int]]:
    """At most ``MOST_RANGES`` ranges of keys that are all stamped, the longest ones: runs of full blocks, and of runs that
    fill their span.
    """
    found = runs(bits.where(F.col(BITS) == -1), BLOCK)
    whole = (F.col("last") - F.col("first") + 1) == (1 << _SPAN)
    wide = runs(found.where(whole).select(F.shiftright("first", _SPAN).alias("_wide")), "_wide")
    wide = wide.select((F.col("first") * (1 << _SPAN)).alias("first"), ((F.col("last") + 1) * (1 << _SPAN) - 1).alias("last"))
    every = found.where(~whole).unionByName(wide)
    top = every.orderBy(F.desc(F.col("last") - F.col("first")), "first").limit(MOST_RANGES).collect()
    return sorted((r["first"] * 64, r["last"] * 64 + 63) for r in top)


def joined(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges, neighbouring and overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def longest(ranges: Sequence[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The ``MOST_RANGES`` longest ranges, and the others."""
    order = sorted(ranges, key=lambda r: r[0] - r[1])
    return sorted(order[:MOST_RANGES]), order[MOST_RANGES:]


def full_blocks(bits: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """``bits`` and the blocks of ``ranges``, all full."""
    for low, high in ranges:
        blocks = bits.sparkSession.range(low // 64, high // 64 + 1)
        bits = bits.unionByName(blocks.select(F.col("id").alias(BLOCK), F.lit(-1).cast("long").alias(BITS)))
    return bits


def outside(number: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """Whether a number lies in none of the ranges; true for null."""
    condition = F.lit(True)
    for low, high in ranges:
        condition = condition & ((number < F.lit(low)) | (number > F.lit(high)))
    return condition | number.isNull()


def without_ranges(bits: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of blocks that no range holds."""
    return bits.where(outside(F.col(BLOCK), [(low // 64, high // 64) for low, high in ranges]))


def unstamped(log: DataFrame, key: str, stamps: Stamps) -> DataFrame:
    """Rows of the log whose key is not stamped, or null."""
    kind = log.schema[key].dataType
    low, high = _limits(kind)
    clipped = [(max(a, low), min(b, high)) for a, b in stamps.ranges if a <= high and b >= low]
    if clipped:
        log = log.where(outside(F.col(key), [(F.lit(a).cast(kind), F.lit(b).cast(kind)) for a, b in clipped]))
    if stamps.rest is None:
        return log
    if BITS not in stamps.rest.columns:
        return key_join(log, stamps.rest, [key], "left_anti", null_safe=False)
    rest = stamps.rest.select(F.col(BLOCK).alias("_block"), F.col(BITS).alias("_bits"))
    stamped = F.col("_bits").bitwiseAND(_bit(key)) != 0
    return log.join(rest, (_block(key) == F.col("_block")) & stamped, "left_anti")


def _limits(kind: T.DataType) -> tuple[int, int]:
    size = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31}.get(type(kind), 63)
    return -(1 << size), (1 << size) - 1
