"""Window functions and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import money, money_sum, money_total
from ..operators.windows import (
    change_from_previous, latest_per_key, neighbours, ntile_of, percent_rank_of, place_rows, rolling_mean, running_total,
    top_n, with_group_stats,
)
from .registry import RESTAURANTS, TICKETS, query, restaurants, sql_money, table, tickets

_CUISINE = "PARTITION BY cuisine_type ORDER BY"


@query("ranks", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, cuisine_type, monthly_orders,
       ROW_NUMBER() OVER ({_CUISINE} monthly_orders DESC, restaurant_id) AS row_number,
       RANK() OVER ({_CUISINE} monthly_orders DESC) AS rank,
       DENSE_RANK() OVER ({_CUISINE} monthly_orders DESC) AS dense_rank FROM restaurants""")
def ranks(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "monthly_orders")
    return place_rows(
        places, "cuisine_type", ["monthly_orders desc", "restaurant_id"], ties="monthly_orders desc",
        row_number="row_number", rank="rank", dense_rank="dense_rank",
    )


@query("lag_lead_diff", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, cuisine_type, monthly_orders,
       LAG(monthly_orders) OVER w AS previous, LEAD(monthly_orders) OVER w AS following,
       LAG(monthly_orders, 2) OVER w AS before_previous, monthly_orders - LAG(monthly_orders) OVER w AS diff_from_prev
FROM restaurants WINDOW w AS ({_CUISINE} monthly_orders DESC, restaurant_id)""")
def lag_lead_diff(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "monthly_orders")
    order = ["monthly_orders desc", "restaurant_id"]
    fetch = {
        "previous": ("monthly_orders", -1),
        "following": ("monthly_orders", 1),
        "before_previous": ("monthly_orders", -2),
    }
    shifted = neighbours(places, "cuisine_type", order, fetch)
    return shifted.withColumn("diff_from_prev", F.col("monthly_orders") - F.col("previous"))


@query("running_rows", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, cuisine_type, monthly_orders,
       CAST(SUM(monthly_orders) OVER ({_CUISINE} monthly_orders DESC, restaurant_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total FROM restaurants""")
def running_rows(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "monthly_orders")
    order = ["monthly_orders desc", "restaurant_id"]
    return running_total(places, "cuisine_type", order, F.col("monthly_orders"), "running_total")


@query("running_range", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, cuisine_type, monthly_orders,
       CAST(SUM(monthly_orders) OVER ({_CUISINE} monthly_orders DESC) AS BIGINT) AS running_total FROM restaurants""")
def running_range(spark, sf_dir):
    """SQL's default frame: rows of equal order share their total."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "monthly_orders")
    orders = F.col("monthly_orders")
    return running_total(places, "cuisine_type", "monthly_orders desc", orders, "running_total", ties="range")


@query("ntile_percent_rank", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, average_rating, NTILE(4) OVER (ORDER BY average_rating DESC, restaurant_id) AS quartile,
       ROUND(PERCENT_RANK() OVER (ORDER BY average_rating), 6) AS pct_rank FROM restaurants""")
def ntile_percent_rank(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "average_rating")
    order = ["average_rating desc", "restaurant_id"]
    placed = place_rows(places, [], order, ties=order[:1], row_number="rn", through="through", size="size")
    # The rank from below counts the rows behind the last peer.
    from_below = F.col("size") - F.col("through") + 1
    quartile, share = ntile_of(F.col("rn"), F.col("size"), 4), percent_rank_of(from_below, F.col("size"))
    return placed.select(*places.columns, quartile.alias("quartile"), F.round(share, 6).alias("pct_rank"))


@query("group_avg_diff", f"""
WITH {RESTAURANTS}, cents AS (
  SELECT *, CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) OVER (PARTITION BY cuisine_type) AS DOUBLE)
         / COUNT(*) OVER (PARTITION BY cuisine_type) AS mean, COUNT(*) OVER (PARTITION BY cuisine_type) AS cuisine_size
  FROM restaurants)
SELECT restaurant_id, cuisine_type, average_rating, ROUND(mean, 4) AS cuisine_avg, cuisine_size,
       ROUND(average_rating - mean, 4) AS diff_from_avg FROM cents""")
def group_avg_diff(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "average_rating")
    stats = {"cuisine_avg": money_sum(F.col("average_rating")) / F.count("*"), "cuisine_size": F.count("*")}
    compared = with_group_stats(places, "cuisine_type", stats)
    return compared.withColumns(
        {
            "diff_from_avg": F.round(F.col("average_rating") - F.col("cuisine_avg"), 4),
            "cuisine_avg": F.round("cuisine_avg", 4),
        }
    )


@query("monthly_running_mom", f"""
WITH {TICKETS}, months AS (
  SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
         COUNT(*) AS order_count, SUM(CAST(amount AS DECIMAL(12,2))) AS revenue FROM tickets GROUP BY 1, 2)
SELECT year, month, order_count, CAST(revenue AS DOUBLE) AS total_revenue,
       CAST(SUM(revenue) OVER (ORDER BY year, month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_revenue,
       CAST(revenue - COALESCE(LAG(revenue) OVER (ORDER BY year, month), revenue) AS DOUBLE) AS mom_change
FROM months""")
def monthly_running_mom(spark, sf_dir):
    """Windows over calendar months: a handful of rows, known small without counting them."""
    months = (
        tickets(spark, sf_dir)
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(F.count("*").alias("order_count"), money_total(F.col("amount")).alias("revenue"))
    )
    order = ["year", "month"]
    trend = running_total(months, [], order, F.col("revenue"), "cumulative_revenue", limit=None)
    trend = change_from_previous(trend, [], order, "revenue", "mom_change", limit=None)
    return trend.select(
        "year",
        "month",
        "order_count",
        F.col("revenue").cast("double").alias("total_revenue"),
        F.col("cumulative_revenue").cast("double").alias("cumulative_revenue"),
        F.col("mom_change").cast("double").alias("mom_change"),
    )


@query("daily_running_revenue", f"""
WITH {TICKETS}
SELECT order_id, line, restaurant_id, driver_id, order_date,
       CAST(SUM(CAST(amount AS DECIMAL(12,2))) OVER (
            PARTITION BY YEAR(order_date) ORDER BY order_date, order_id, line, restaurant_id, driver_id, amount
            ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS revenue_so_far
FROM tickets""")
def daily_running_revenue(spark, sf_dir):
    """A running total over the fact itself: each year is one group, far too large for a task."""
    lines = tickets(spark, sf_dir).withColumn("year", F.year("order_date"))
    order = ["order_date", "order_id", "line", "restaurant_id", "driver_id", "amount"]
    totals = running_total(lines, "year", order, money(F.col("amount")), "revenue_so_far")
    return totals.withColumn("revenue_so_far", F.col("revenue_so_far").cast("double")).drop("year", "amount")


@query("top_n_per_group", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, name, cuisine_type, monthly_orders, RANK() OVER ({_CUISINE} monthly_orders DESC) AS rank
FROM restaurants QUALIFY rank <= 2""")
def top_n_per_group(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "name", "cuisine_type", "monthly_orders")
    return top_n(places, "cuisine_type", "monthly_orders desc", 2, "rank", "rank")


@query("top_rows_per_group", f"""
WITH {TICKETS}
SELECT restaurant_id, order_id, line, driver_id, amount,
       ROW_NUMBER() OVER (PARTITION BY restaurant_id ORDER BY amount DESC, order_id, line, driver_id, order_date) AS place
FROM tickets QUALIFY place <= 3""")
def top_rows_per_group(spark, sf_dir):
    order = ["amount desc", "order_id", "line", "driver_id", "order_date"]
    return top_n(tickets(spark, sf_dir), "restaurant_id", order, 3, "place").drop("order_date")


@query("dedup_latest", f"""
WITH {TICKETS}
SELECT * FROM tickets QUALIFY ROW_NUMBER() OVER (
  PARTITION BY order_id, line ORDER BY order_date DESC, restaurant_id, driver_id, amount) = 1""")
def dedup_latest(spark, sf_dir):
    newest = ["order_date desc", "restaurant_id", "driver_id", "amount"]
    return latest_per_key(tickets(spark, sf_dir), ["order_id", "line"], newest)


@query("rolling_mean", """
SELECT event_id, event_type, CASE WHEN COUNT(value) OVER w = 3
       THEN ROUND(CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / 3, 3) END AS rolling
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def rolling_mean_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    rolled = rolling_mean(events, "event_type", ["ts", "event_id"], money(F.col("value")), 3, "rolling")
    return rolled.select("event_id", "event_type", F.round(F.col("rolling").cast("double"), 3).alias("rolling"))


@query("top_k", f"""
WITH {TICKETS}
SELECT order_id, line, restaurant_id, amount FROM tickets
ORDER BY amount DESC, order_id, line, restaurant_id LIMIT 10""")
def top_k(spark, sf_dir):
    """Ten best of all: every task keeps ten, no full sort."""
    slim = tickets(spark, sf_dir).select("order_id", "line", "restaurant_id", "amount")
    return slim.orderBy(F.col("amount").desc(), "order_id", "line", "restaurant_id").limit(10)


@query("sorted_delivery", f"""
WITH {TICKETS}
SELECT restaurant_id, COUNT(*) AS orders, {sql_money("amount")} AS revenue FROM tickets GROUP BY restaurant_id
ORDER BY revenue DESC, restaurant_id""")
def sorted_delivery(spark, sf_dir):
    """A global sort: a range shuffle over unique sort keys, so no range is heavy."""
    grouped = tickets(spark, sf_dir).groupBy("restaurant_id")
    totals = grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))
    return totals.orderBy(F.col("revenue").desc(), "restaurant_id")
