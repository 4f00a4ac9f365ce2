"""Corpus-wide token totals, and a value per document summed over its tokens.

A value that depends on the token alone is looked up in a broadcast table for the frequent tokens (their
number is a parameter, whatever the corpus). All other tokens of a document are kept beside it as
(token, times) pairs and joined to the table of totals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Split = Callable[[str], Iterable[bytes]]

HELD = 100_000  # distinct tokens that a task holds before it passes them on


def merged_totals(texts: Iterator[list[str]], split: Split) -> Iterator[Counter]:
    """Token totals of many texts, in counters of about ``HELD`` tokens at most."""
    totals: Counter = Counter()
    for some in texts:
        for text in some:
            totals.update(split(text))
            if len(totals) > HELD:
                yield totals
                totals = Counter()
    if totals:
        yield totals


def row_ids() -> Iterator[int]:
    """Numbers that are unique over all tasks of a stage; they hold once the rows are stored."""
    context = TaskContext.get()
    at = (context.partitionId() if context else 0) << 40
    while True:
        yield at
        at += 1


def pairs_array(rows: list[list[tuple[bytes, int]]]) -> pa.Array:
    """An array of (token, times) per row."""
    flat = [pair for row in rows for pair in row]
    ends = np.cumsum([0] + [len(row) for row in rows]).astype(np.int32)
    pairs = pa.StructArray.from_arrays(
        [pa.array([p[0] for p in flat], pa.binary()), pa.array([p[1] for p in flat], pa.int64())], ["token", "times"]
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


REST = "rest array<struct<token: binary, times: bigint>>"


def add_rest(rows: DataFrame, totals: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``rows`` (stored, with row and rest) with ``sums`` over the rest's tokens, joined to ``totals``.

    An expression may use ``times`` and the columns of ``totals``, null where a token has no total. Rows
    without a rest get null.
    """
    rest = rows.select("row", F.explode("rest").alias("pair")).select("row", "pair.token", "pair.times")
    found = rest.join(totals, "token", "left").groupBy("row").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return rows.drop("rest").join(found, "row", "left")
