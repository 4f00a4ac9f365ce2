"""Global positions in key order without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import Scratch

# monotonically_increasing_id puts the partition above, the row within it below, this bit.
_ROW_BITS = 33


def with_rank(
    df: DataFrame,
    order: Sequence[str],
    scratch: Scratch | None = None,
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in the order of ``order``.

    One range exchange sorts the rows, numbered within their partition. The result is
    written, because the range borders are sampled and must be used only once; then each
    partition's offset, one row per partition, is joined back.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    numbered = ranged.sortWithinPartitions(*keys).withColumn("_position", F.monotonically_increasing_id())
    numbered = (scratch or Scratch(df.sparkSession)).write(
        numbered.withColumn("_part", F.shiftright("_position", _ROW_BITS).cast("int")).withColumn(
            "_row", F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        ).drop("_position")
    )
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    # One row per range partition: bounded by the number of tasks of the sort.
    placed = numbered.join(F.broadcast(offsets), "_part")
    return placed.select(*df.columns, (F.col("_offset") + F.col("_row") + 1).alias(name))
