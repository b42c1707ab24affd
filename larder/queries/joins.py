"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import money, money_avg, money_sum
from ..operators.joins import (
    aggregate_then_join, equi_join, hinted_join, join_dimension, rows_without_match, salted_join, salted_join_all,
    skew_report, strategy_fits,
)
from ..operators.windows import rank_rows, with_group_stats
from ..plans.jobs import order_metrics
from ..session import union_all
from .registry import (
    RESTAURANTS, TICKETS, cents, drivers, query, restaurants, sql_money, sql_money_avg, table, tickets,
)


@query("order_metrics", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT cuisine_type, city, {sql_money("amount")} AS total_revenue, COUNT(*) AS total_orders,
       {sql_money_avg("amount")} AS avg_order_value
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY cuisine_type, city""")
def order_metrics_query(spark, sf_dir):
    places = restaurants(spark, sf_dir)
    return order_metrics(tickets(spark, sf_dir), places)


@query("inner_join_keys", """
SELECT l_orderkey, o_orderkey, o_custkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def inner_join_keys(spark, sf_dir):
    """Keys of different names; only the named columns are read."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    return join_dimension(lines, orders, ("l_orderkey", "o_orderkey"))


@query("inner_join_shared_key", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT restaurant_id, name, order_id, line, driver_id, amount FROM tickets JOIN restaurants USING (restaurant_id)""")
def inner_join_shared_key(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "name")
    lines = tickets(spark, sf_dir).select("restaurant_id", "order_id", "line", "driver_id", "amount")
    return join_dimension(lines, places, "restaurant_id")


@query("left_join_count", f"""
SELECT o_orderkey, COUNT(l_orderkey) AS lines, {sql_money("l_extendedprice")} AS revenue
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def left_join_count(spark, sf_dir):
    """Lines are counted per order first: one row per key meets the join."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    counted = lines.agg(F.count("l_orderkey").alias("lines"), money_sum(F.col("l_extendedprice")).alias("revenue"))
    return equi_join(orders, counted, "o_orderkey", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


@query("three_way_join", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT t.order_id, t.line, t.amount, r.name, r.cuisine_type, s_name || ' / ' || CAST(s_nationkey AS VARCHAR) AS driver
FROM tickets t JOIN restaurants r ON t.restaurant_id = r.restaurant_id JOIN supplier ON t.driver_id = s_suppkey""")
def three_way_join(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "name", "cuisine_type")
    people = drivers(spark, sf_dir).select(
        "driver_id", F.concat("driver_name", F.lit(" / "), F.col("license_nation").cast("string")).alias("driver")
    )
    lines = tickets(spark, sf_dir)
    joined = join_dimension(join_dimension(lines, places, "restaurant_id"), people, "driver_id")
    return joined.select("order_id", "line", "amount", "name", "cuisine_type", "driver")


@query("join_hints", f"""
WITH {RESTAURANTS}, {TICKETS}, one AS (
  SELECT r.city, COUNT(*) AS orders, {sql_money("t.amount")} AS revenue
  FROM tickets t JOIN restaurants r ON t.restaurant_id = r.restaurant_id GROUP BY r.city)
SELECT strategy, one.* FROM one, (VALUES ('broadcast'), ('merge'), ('shuffle_hash'), ('sql_merge'), ('sql_broadcast')) ways(strategy)""")
def join_hints(spark, sf_dir):
    """The same join by every physical strategy, and by a SQL hint that names the alias.

    A strategy that the size of the side forbids gives one row without a city and without orders.
    """
    places = restaurants(spark, sf_dir).select("restaurant_id", "city")
    lines = tickets(spark, sf_dir).select("restaurant_id", "amount")

    def by_sql(hint):
        return spark.sql(
            f"SELECT /*+ {hint}(r) */ o.restaurant_id, o.amount, r.city "
            "FROM {lines} o JOIN {places} r ON o.restaurant_id = r.restaurant_id",
            lines=lines,
            places=places,
        )

    results = []
    for name in ("broadcast", "merge", "shuffle_hash", "sql_merge", "sql_broadcast"):
        strategy = name.removeprefix("sql_")
        if not strategy_fits(places, strategy):
            results.append(refused(spark, name))
            continue
        joined = by_sql(strategy.upper()) if name != strategy else hinted_join(lines, places, "restaurant_id", strategy, checked=True)
        grouped = joined.groupBy("city")
        totals = grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))
        results.append(totals.withColumn("strategy", F.lit(name)))
    return union_all(results)


def refused(spark, strategy):
    none = spark.range(1).select(F.lit(None).cast("string").alias("city"), F.lit(0).cast("bigint").alias("orders"))
    return none.select("city", "orders", F.lit(None).cast("double").alias("revenue"), F.lit(strategy).alias("strategy"))


_BY_CUISINE = f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT cuisine_type, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY cuisine_type"""


def _by_cuisine(joined):
    return joined.groupBy("cuisine_type").agg(
        F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue")
    )


@query("salted_join", f"""
WITH {RESTAURANTS}, {TICKETS}, skewed AS (
  SELECT CASE WHEN order_id % 5 < 4 THEN (SELECT MIN(restaurant_id) FROM restaurants) ELSE restaurant_id END
         AS restaurant_id, amount FROM tickets)
SELECT cuisine_type, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM skewed JOIN restaurants USING (restaurant_id) GROUP BY cuisine_type""")
def salted_join_query(spark, sf_dir):
    """Four fifths of the orders are moved to one key; only keys above their share are salted."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type")
    first = places.agg(F.min("restaurant_id").alias("k")).first()["k"]
    lines = tickets(spark, sf_dir)
    key = F.when(F.col("order_id") % 5 < 4, F.lit(first)).otherwise(F.col("restaurant_id"))
    return _by_cuisine(salted_join(lines.withColumn("restaurant_id", key), places, "restaurant_id"))


@query("salted_join_all", _BY_CUISINE)
def salted_join_all_query(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type")
    spread = ["order_id", "line", "driver_id"]
    return _by_cuisine(salted_join_all(tickets(spark, sf_dir), places, "restaurant_id", spread_by=spread))


@query("skew_report", f"""
WITH {TICKETS}, counts AS (SELECT restaurant_id, COUNT(*) AS rows FROM tickets GROUP BY restaurant_id)
SELECT restaurant_id, rows, ROUND(rows / (SELECT SUM(rows) FROM counts), 6) AS share,
       ROUND(rows / (SELECT quantile_disc(rows, 0.5) FROM counts), 6) AS times_median
FROM counts""")
def skew_report_query(spark, sf_dir):
    return skew_report(tickets(spark, sf_dir), "restaurant_id")


@query("group_stats_join", f"""
WITH {RESTAURANTS}, ranked AS (
  SELECT *, RANK() OVER (PARTITION BY cuisine_type ORDER BY average_rating DESC) AS rank_in_cuisine FROM restaurants)
SELECT restaurant_id, name, cuisine_type, average_rating, rank_in_cuisine, cuisine_avg, cuisine_orders,
       ROUND(average_rating - cuisine_avg, 2) AS above_avg
FROM ranked JOIN (SELECT cuisine_type, {sql_money_avg("average_rating")} AS cuisine_avg,
                  CAST(SUM(monthly_orders) AS BIGINT) AS cuisine_orders FROM restaurants GROUP BY cuisine_type)
USING (cuisine_type)""")
def group_stats_join(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "name", "cuisine_type", "average_rating", "monthly_orders")
    ranked = rank_rows(places, "cuisine_type", "average_rating desc", rank="rank_in_cuisine")
    stats = {"cuisine_avg": money_avg(F.col("average_rating")), "cuisine_orders": F.sum("monthly_orders")}
    compared = with_group_stats(ranked, "cuisine_type", stats)
    above = F.round(F.col("average_rating") - F.col("cuisine_avg"), 2)
    return compared.withColumn("above_avg", above).drop("monthly_orders")


@query("preagg_join", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT restaurant_id, name, COUNT(*) AS orders, {sql_money("amount")} AS revenue, MAX(amount) AS best
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY restaurant_id, name""")
def preagg_join(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "name")
    totals = [
        F.count("*").alias("orders"),
        money_sum(F.col("amount")).alias("revenue"),
        F.max("amount").alias("best"),
    ]
    return aggregate_then_join(tickets(spark, sf_dir), places, "restaurant_id", totals)


@query("filter_before_join", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT r.name, r.cuisine_type, COUNT(*) AS orders, CAST(MAX({cents("t.amount")}) AS DOUBLE) AS largest
FROM tickets t JOIN restaurants r ON t.restaurant_id = r.restaurant_id
WHERE r.average_rating > 975 AND t.amount > 20000 GROUP BY r.name, r.cuisine_type""")
def filter_before_join(spark, sf_dir):
    """The filters are written after the join; Catalyst moves them to the scans."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "name", "cuisine_type", "average_rating")
    small = places.filter(F.col("average_rating") > 975)
    joined = join_dimension(tickets(spark, sf_dir), small, "restaurant_id").filter(F.col("amount") > 20000)
    return joined.groupBy("name", "cuisine_type").agg(
        F.count("*").alias("orders"), F.max(money(F.col("amount"))).cast("double").alias("largest")
    )


@query("anti_join_orphans", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def anti_join_orphans(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows_without_match(orders, table(spark, sf_dir, "lineitem"), ("o_orderkey", "l_orderkey"))
