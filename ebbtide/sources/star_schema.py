"""Views that shape a star schema (orders, lineitem, customer, nation, region) like shop tables.

Pure projections: every view reads only the columns it needs. Two customer keys share one person,
and the order's seconds of day come from its key, because the star schema stores midnight only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.shop import ShopTables


def _decimal(column: str, precision: int, scale: int = 2):
    return F.col(column).cast(f"decimal({precision},{scale})")


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.col("c_custkey") / 2).cast("bigint").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def orders(orders: DataFrame) -> DataFrame:
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=seconds)).alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_purchase_day"),
    )


def payments(lineitem: DataFrame) -> DataFrame:
    value = _decimal("l_extendedprice", 12) * (1 - _decimal("l_discount", 4)) * (1 + _decimal("l_tax", 4))
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (1 + F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
        value.cast("decimal(12,2)").alias("payment_value"),
    )


def items(lineitem: DataFrame) -> DataFrame:
    freight = _decimal("l_extendedprice", 12) * _decimal("l_tax", 4)
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _decimal("l_extendedprice", 12).alias("price"),
        freight.cast("decimal(12,2)").alias("freight_value"),
    )


def reviews(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (1 + F.col("l_quantity").cast("int") % 5).alias("review_score"),
    )


def shop_tables(spark: SparkSession, directory: str) -> ShopTables:
    """Open the five views over the parquet files in ``directory``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}.parquet")

    lineitem = table("lineitem")
    return ShopTables(
        customers=customers(table("customer"), table("nation"), table("region")),
        orders=orders(table("orders")),
        payments=payments(lineitem),
        items=items(lineitem),
        reviews=reviews(lineitem),
    )
