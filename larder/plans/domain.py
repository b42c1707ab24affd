"""The food-delivery frames the jobs work on, mapped from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restaurants_from(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("restaurant_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("cuisine_type"),
        F.col("p_type").alias("city"),
        F.col("p_retailprice").alias("average_rating"),
        F.col("p_size").cast("bigint").alias("monthly_orders"),
    )


def tickets_from(lineitem: DataFrame) -> DataFrame:
    """Orders of the domain; one row per order line."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("restaurant_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("order_date"),
    )


def users_from(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower(F.col("c_mktsegment")), F.lit("@"), F.col("c_custkey")).alias("email"),
        phone_of(F.col("c_nationkey"), F.col("c_custkey")).alias("phone_number"),
    )


def drivers_from(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("driver_id"),
        F.col("s_name").alias("driver_name"),
        F.col("s_nationkey").alias("license_nation"),
    )


def phone_of(area, number):
    """A written phone number, as the tables hold none: ``+(07) 3127-123``."""
    area, number = area.cast("string"), number.cast("string")
    return F.concat(F.lit("+("), F.lpad(area, 2, "0"), F.lit(") 3127-"), number)
