"""Change log in a remote database."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    order_key: str,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options: parallel ranges of the order key, rows fetched in large blocks.

    The bounds only shape the ranges; rows outside them are read by the first and last task.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partitions and partitions > 1:
        if lower is None or upper is None:
            raise ValueError("parallel reads need the lower and upper bound of the order key")
        options |= {
            "partitionColumn": order_key,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_changes(spark: SparkSession, url: str, table: str, order_key: str, **options: Any) -> DataFrame:
    """Scan a database table; key and flag filters are pushed into its WHERE clause."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, order_key, **options)).load()
