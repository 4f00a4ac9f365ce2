"""Bulk change log for stress tests, in the shape of the orders example."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_DATE = date(2026, 6, 30)
PAYLOAD = (
    "cust_first_name", "cust_last_name", "order_day", "order_month", "order_year",
    "unit_price", "quantity", "status_code", "country_code",
)


def _draw(key: Column, seed: int, below: int) -> Column:
    """Repeatable stand-in for a random whole number from 0 to below - 1: the first 32 bits of the MD5 of ``seed:key``."""
    drawn = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8)
    return F.pmod(F.conv(drawn, 16, 10).cast("long"), F.lit(below))


def _pick(remainder: Column, labels: tuple[str, ...], otherwise: str) -> Column:
    choice = F.when(remainder == 0, labels[0])
    for i, label in enumerate(labels[1:], start=1):
        choice = choice.when(remainder == i, label)
    return choice.otherwise(otherwise)


def order_inserts(ids: DataFrame, base: date = BASE_DATE) -> DataFrame:
    """One insert per id in column ``order_id``."""
    key = F.col("order_id")
    day = F.date_sub(F.lit(base), F.pmod(key, F.lit(365)).cast("int"))
    return ids.select(
        F.lit("I").alias("operation"),
        key,
        F.concat(F.lit("First"), key.cast("string")).alias("cust_first_name"),
        F.concat(F.lit("Last"), key.cast("string")).alias("cust_last_name"),
        F.date_format(day, "dd").alias("order_day"),
        F.date_format(day, "MM").alias("order_month"),
        F.date_format(day, "yyyy").alias("order_year"),
        ((_draw(key, 1, 49_901) + 100) / F.lit(100)).cast("decimal(12,2)").alias("unit_price"),
        (_draw(key, 2, 9) + 1).cast("decimal(8,0)").alias("quantity"),
        _pick(F.pmod(key, F.lit(4)), ("NW", "SH", "DL"), "CN").alias("status_code"),
        _pick(F.pmod(key, F.lit(5)), ("US", "GB", "AE", "IN"), "ZZ").alias("country_code"),
    )


def generate_from(ids: DataFrame, spacing: int) -> DataFrame:
    """Inserts for all ids, then a shipped update for every 10th and a delete for every 100th.

    ``spacing`` exceeds every id, so that updates follow inserts and deletes follow updates
    in change order: change ids are id, spacing + id and 2 * spacing + id.
    """
    inserts = order_inserts(ids)
    key = F.col("order_id")
    updates = inserts.where(F.pmod(key, F.lit(10)) == 0).withColumns(
        {"operation": F.lit("U"), "status_code": F.lit("SH")}
    )
    gone = inserts.where(F.pmod(key, F.lit(100)) == 0).select("order_id").distinct()
    deletes = gone.select(F.lit("D").alias("operation"), "order_id")

    def placed(rows: DataFrame, step: int) -> DataFrame:
        return rows.withColumn("change_id", key + F.lit(step * spacing))

    log = placed(inserts, 0).unionByName(placed(updates, 1))
    log = log.unionByName(placed(deletes, 2), allowMissingColumns=True)
    return log.select("change_id", "operation", "order_id", *PAYLOAD)


def generate_changes(spark: SparkSession, orders: int = 100_000) -> DataFrame:
    """Change log of ``orders`` inserts with ids 1..orders, and their updates and deletes."""
    ids = spark.range(1, orders + 1).withColumnRenamed("id", "order_id")
    return generate_from(ids, spacing=orders + 1)
