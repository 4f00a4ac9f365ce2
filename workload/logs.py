"""Change logs derived from the given tables, and the specs they are replayed with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.examples.orders import REGION, orders_spec, user_link
from tidemark.operators.ranks import with_rank
from tidemark.spec import ChangeSpec, Column, Mapping

COUNTRIES = (*REGION, "ZZ")
# Change ids of updates and deletes follow those of all inserts, whatever the table's size.
UPDATE_BASE, DELETE_BASE = 10**15, 2 * 10**15
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- events: hot keys, repeated inserts, unknown operations --------------------


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table(spark, sf_dir, "events"))


def event_columns(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    op = (
        F.when(kind == "signup", "I")
        .when(kind.isin("click", "purchase"), "U")
        .when(kind == "error", "D")
        .otherwise("X")
    )
    return events.select(
        F.col("event_id").alias("change_id"),
        op.alias("operation"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value"),
        _queue_flag().alias("processed"),
    )


def _queue_flag():
    """0 pending, 1 done; 2 breaks the rule on flags."""
    k = F.get_json_object("props", "$.k").cast("int")
    return F.when(k < 20, 1).when(k == 50, 2).otherwise(0)


def event_spec(**changed) -> ChangeSpec:
    columns = {"k": ":K", "amount": ":VALUE"}
    checks = {"k": "coalesce(:K, 99) >= 98"}
    settings = {
        "business_keys": ("user_id",),
        "id_column": "profile_id",
        "target": {"k": Column("int", nullable=True), "amount": Column("double", nullable=True)},
        "insert": Mapping(columns, checks),
        "update": Mapping(columns, checks),
    }
    return ChangeSpec(**{**settings, **changed})


# -- orders joined with customer: the shape of the orders example ---------------


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    key = F.col("o_orderkey")
    name = F.split("c_name", "#")
    country = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (F.col("c_nationkey") % 14 + 1).cast("int"))
    inserts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        (key + 1).alias("change_id"),
        F.lit("I").alias("operation"),
        key.alias("order_id"),
        F.when(key % 11 != 0, name.getItem(0)).alias("cust_first_name"),
        F.when(key % 7 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), name.getItem(1)))
        .alias("cust_last_name"),
        F.date_format("o_orderdate", "dd").alias("order_day"),
        F.when(key % 97 == 5, "13").otherwise(F.date_format("o_orderdate", "MM")).alias("order_month"),
        F.date_format("o_orderdate", "yyyy").alias("order_year"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("unit_price"),
        (key % 9 + 1).cast("decimal(8,0)").alias("quantity"),
        F.when(key % 13 == 0, "CN")
        .when(key % 17 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "P", "NW")
        .when(F.col("o_orderstatus") == "O", "SH")
        .when(F.col("o_orderstatus") == "F", "DL")
        .alias("status_code"),
        country.alias("country_code"),
    )
    order_id = F.col("order_id")
    updates = inserts.where(order_id % 10 == 0).withColumns(
        {
            "change_id": order_id + UPDATE_BASE,
            "operation": F.lit("U"),
            "status_code": F.lit("SH"),
        }
    )
    deletes = table(spark, sf_dir, "orders").where(key % 100 == 0).select(
        (key + DELETE_BASE).alias("change_id"), F.lit("D").alias("operation"), key.alias("order_id")
    )
    return inserts.unionByName(updates).unionByName(deletes, allowMissingColumns=True)


def order_spec(**changed) -> ChangeSpec:
    return orders_spec(**changed)


BAD_LINK = user_link("u" * 65, "orders")


# -- lineitem: composite business key -------------------------------------------


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no change id: number its rows in a total order."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    flag = F.col("l_returnflag")
    op = F.when(flag == "A", "I").when(flag == "N", "U").when(flag == "R", "D")
    return with_rank(lines, LINE_ORDER, name="change_id").select(
        "change_id",
        op.alias("operation"),
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def line_spec(**changed) -> ChangeSpec:
    columns = {"quantity": ":QUANTITY", "price": ":PRICE"}
    checks = {"quantity": ":QUANTITY >= 40"}
    settings = {
        "business_keys": ("l_orderkey", "l_linenumber"),
        "id_column": "line_id",
        "target": {"quantity": Column("double"), "price": Column("double")},
        "insert": Mapping(columns, checks),
        "update": Mapping(columns, checks),
    }
    return ChangeSpec(**{**settings, **changed})
