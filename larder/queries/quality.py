"""Data-quality rules as result frames: rule, column, failures, passed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import (
    check, counting, enforce, min_rows, no_nulls, profile, required_columns, split_null_keys, typed_columns,
)
from ..session import union_all
from .registry import RESTAURANTS, TICKETS, USERS, query, restaurants, tickets, users

_DIRTY = """dirty AS (SELECT restaurant_id, NULLIF(name, 'red widget') AS name,
  NULLIF(cuisine_type, 'Brand#5') AS cuisine_type, average_rating FROM restaurants)"""


def _dirty(spark, sf_dir):
    return restaurants(spark, sf_dir).select(
        "restaurant_id",
        F.nullif(F.col("name"), F.lit("red widget")).alias("name"),
        F.nullif(F.col("cuisine_type"), F.lit("Brand#5")).alias("cuisine_type"),
        "average_rating",
    )


@query("null_check", f"""
WITH {RESTAURANTS}, {_DIRTY}, counted AS (
  SELECT 'name' AS "column", COUNT(*) - COUNT(name) AS failures FROM dirty UNION ALL
  SELECT 'cuisine_type', COUNT(*) - COUNT(cuisine_type) FROM dirty UNION ALL
  SELECT 'average_rating', COUNT(*) - COUNT(average_rating) FROM dirty)
SELECT 'no_nulls' AS rule, "column", failures, failures = 0 AS passed FROM counted""")
def null_check(spark, sf_dir):
    return check(_dirty(spark, sf_dir), no_nulls("name", "cuisine_type", "average_rating"))


@query("row_count_check", f"""
WITH {TICKETS}, needed AS (SELECT UNNEST([1, 1000, 1000000000]) AS least)
SELECT 'min_rows' AS rule, '*' AS "column", GREATEST(least - (SELECT COUNT(*) FROM tickets), 0) AS failures,
       (SELECT COUNT(*) FROM tickets) >= least AS passed FROM needed""")
def row_count_check(spark, sf_dir):
    return check(tickets(spark, sf_dir), min_rows(1) + min_rows(1000) + min_rows(1_000_000_000))


@query("schema_check", """
WITH checks(rule, "column", n) AS (
  VALUES ('required_column', 'user_id', 0), ('required_column', 'birthday', 1), ('column_type', 'user_id', 0),
         ('column_type', 'email', 0), ('column_type', 'phone_number', 1))
SELECT rule, "column", CAST(n AS BIGINT) AS failures, n = 0 AS passed FROM checks
WHERE (SELECT COUNT(*) FROM customer) > 0""")
def schema_check(spark, sf_dir):
    people = users(spark, sf_dir)
    expected = T.StructType().add("user_id", "long").add("email", "string").add("phone_number", "integer")
    return check(people, required_columns(people, "user_id", "birthday") + typed_columns(people, expected))


@query("profile", f"""
WITH {RESTAURANTS}, {_DIRTY}
SELECT 'name' AS "column", 'string' AS type, COUNT(*) AS rows, COUNT(*) - COUNT(name) AS nulls, MIN(name) AS min_value,
       MAX(name) AS max_value FROM dirty UNION ALL
SELECT 'cuisine_type', 'string', COUNT(*), COUNT(*) - COUNT(cuisine_type), MIN(cuisine_type), MAX(cuisine_type) FROM dirty
UNION ALL SELECT 'restaurant_id', 'bigint', COUNT(*), 0, CAST(MIN(restaurant_id) AS VARCHAR),
       CAST(MAX(restaurant_id) AS VARCHAR) FROM dirty""")
def profile_query(spark, sf_dir):
    return profile(_dirty(spark, sf_dir).drop("average_rating")).drop("approx_distinct")


_PROFILED = ["order_id", "line", "restaurant_id", "driver_id", "amount", "order_date"]


@query("profile_distinct", f"WITH {TICKETS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(DISTINCT {c}) AS exact, true AS within FROM tickets""" for c in _PROFILED))
def profile_distinct(spark, sf_dir):
    """The profile's approximate distinct counts beside exact ones; its standard error is 5 %."""
    lines = tickets(spark, sf_dir)
    rough = profile(lines).select("column", "approx_distinct")
    exact = union_all(
        [lines.select(c).distinct().agg(F.lit(c).alias("column"), F.count(c).alias("exact")) for c in _PROFILED]
    )
    within = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.15 * F.col("exact")
    return exact.join(rough, "column").select("column", "exact", within.alias("within"))


@query("quality_gate", f"""
WITH {RESTAURANTS}, {USERS}, {TICKETS}, checks AS (
  SELECT 'users' AS source, 'required_column' AS rule, 'email' AS "column", 0 AS failures UNION ALL
  SELECT 'users', 'no_nulls', 'user_id', COUNT(*) - COUNT(user_id) FROM users UNION ALL
  SELECT 'users', 'no_nulls', 'email', COUNT(*) - COUNT(email) FROM users UNION ALL
  SELECT 'restaurants', 'required_column', 'restaurant_id', 0 UNION ALL
  SELECT 'restaurants', 'min_rows', '*', GREATEST(10 - COUNT(*), 0) FROM restaurants UNION ALL
  SELECT 'tickets', 'no_nulls', 'amount', COUNT(*) - COUNT(amount) FROM tickets UNION ALL
  SELECT 'tickets', 'min_rows', '*', GREATEST(1 - COUNT(*), 0) FROM tickets)
SELECT source, rule, "column", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM checks""")
def quality_gate(spark, sf_dir):
    """All rules of three inputs, one pass over each."""
    people, places, lines = users(spark, sf_dir), restaurants(spark, sf_dir), tickets(spark, sf_dir)
    gates = {
        "users": (people, required_columns(people, "email") + no_nulls("user_id", "email")),
        "restaurants": (places, required_columns(places, "restaurant_id") + min_rows(10)),
        "tickets": (lines, no_nulls("amount") + min_rows(1)),
    }
    return union_all(
        [check(df, rules).select(F.lit(name).alias("source"), "*") for name, (df, rules) in gates.items()]
    )


@query("gate_then_measure", f"""
WITH {RESTAURANTS} SELECT city, COUNT(*) AS total FROM restaurants GROUP BY city""")
def gate_then_measure(spark, sf_dir):
    """The gate raises before any transform is planned."""
    places = restaurants(spark, sf_dir)
    rules = required_columns(places, "restaurant_id", "city") + no_nulls("restaurant_id", "city") + min_rows(5)
    return enforce(places, rules, "restaurants").groupBy("city").agg(F.count("*").alias("total"))


@query("drop_null_keys", f"""
WITH {RESTAURANTS}, {_DIRTY}
SELECT CASE WHEN name IS NULL OR cuisine_type IS NULL THEN 'quarantine' ELSE 'kept' END AS part, COUNT(*) AS rows,
       MIN(restaurant_id) AS first_id, MAX(restaurant_id) AS last_id FROM dirty GROUP BY 1""")
def drop_null_keys(spark, sf_dir):
    kept, quarantine = split_null_keys(_dirty(spark, sf_dir), ["name", "cuisine_type"])
    return union_all(
        [
            df.groupBy(F.lit(part).alias("part")).agg(
                F.count("*").alias("rows"),
                F.min("restaurant_id").alias("first_id"),
                F.max("restaurant_id").alias("last_id"),
            )
            for part, df in (("kept", kept), ("quarantine", quarantine))
        ]
    )


@query("observe_steps", f"""
WITH {TICKETS}
SELECT 'source' AS step, COUNT(*) AS rows FROM tickets UNION ALL
SELECT 'large', COUNT(*) FROM tickets WHERE amount > 50000 UNION ALL
SELECT 'large and late', COUNT(*) FROM tickets WHERE amount > 50000 AND order_date >= DATE '1999-01-01'""")
def observe_steps(spark, sf_dir):
    """Row counts of three steps from the one job that runs the chain."""
    source, first = counting(tickets(spark, sf_dir).select("amount", "order_date"), "source")
    large, second = counting(source.filter(F.col("amount") > 50000), "large")
    late, third = counting(large.filter(F.col("order_date") >= F.lit("1999-01-01").cast("timestamp_ntz")), "late")
    late.write.format("noop").mode("overwrite").save()
    counts = [("source", first.get["rows"]), ("large", second.get["rows"]), ("large and late", third.get["rows"])]
    return spark.createDataFrame(counts, "step string, rows bigint")
