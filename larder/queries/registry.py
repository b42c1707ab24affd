"""Registration of queries, and the frames and SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..plans import domain
from ..session import prepare, size_shuffle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
# The tables of the query that is being built.
_loaded: list[DataFrame] = []


def query(name: str, check: str | None = None):
    """Register ``function(spark, sf_dir)`` under a name, with the SQL that must agree."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(function)
        def alone(spark, sf_dir, *more, **named):
            _loaded.clear()
            return function(spark, sf_dir, *more, **named)

        QUERIES[name] = alone
        if check is not None:
            CHECKS[name] = " ".join(check.split())
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also sizes the shuffle for all tables the query has loaded so far."""
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    _loaded.append(df)
    size_shuffle(spark, *_loaded)
    return df


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.restaurants_from(table(spark, sf_dir, "part"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.users_from(table(spark, sf_dir, "customer"))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.drivers_from(table(spark, sf_dir, "supplier"))


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.tickets_from(table(spark, sf_dir, "lineitem"))


# --- the same frames and expressions in the checking SQL -----------------------------

RESTAURANTS = """restaurants AS (
  SELECT p_partkey AS restaurant_id, p_name AS name, p_brand AS cuisine_type, p_type AS city,
         p_retailprice AS average_rating, CAST(p_size AS BIGINT) AS monthly_orders FROM part)"""

TICKETS = """tickets AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS restaurant_id, l_suppkey AS driver_id,
         l_extendedprice AS amount, l_shipdate AS order_date FROM lineitem)"""

PHONE = "'+(' || LPAD(CAST(c_nationkey AS VARCHAR), 2, '0') || ') 3127-' || CAST(c_custkey AS VARCHAR)"

USERS = f"""users AS (
  SELECT c_custkey AS user_id, LOWER(c_mktsegment) || '@' || CAST(c_custkey AS VARCHAR) AS email,
         {PHONE} AS phone_number FROM customer)"""

PRICE_LABEL = """CASE WHEN average_rating >= 975 THEN 'Excellent' WHEN average_rating >= 950 THEN 'Good'
                 ELSE 'Average' END"""


def cents(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(12,2))"


def sql_money(expression: str) -> str:
    return f"CAST(SUM({cents(expression)}) AS DOUBLE)"


def sql_money_avg(expression: str, digits: int = 2) -> str:
    return f"ROUND({sql_money(expression)} / COUNT({expression}), {digits})"
