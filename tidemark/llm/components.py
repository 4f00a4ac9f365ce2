"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and its component's least node (``label``) for every node in ``edges`` (a, b; long).

    Alternates two steps until nothing changes: each node links its larger neighbours to its least one
    (and itself), then its smaller neighbours. Labels are aggregated before they are joined back, so the
    neighbours of a node never meet in one place. Every round is written, so a lost executor costs one.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.filter("a <> b").distinct())
        now = links.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = links.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
