"""Counts, grouped statistics, subtotals, pivots, percentiles and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import ALL_LABEL, GRAND_TOTAL_LABEL, PRICE_STEPS, RATING_REST
from ..functions.columns import ladder, money_avg, money_sum, money_total
from ..operators.aggregates import (
    approximate_beside_exact, describe, exact_percentiles, kpi_by, members, pivot_mean, share_of_total, subtotals, summarise,
)
from ..operators.joins import join_dimension
from ..operators.windows import rank_rows, with_group_stats
from ..session import stash, union_all
from .registry import PRICE_LABEL, RESTAURANTS, TICKETS, query, restaurants, sql_money, sql_money_avg, tickets

@query("global_counts", f"""
WITH {RESTAURANTS}
SELECT COUNT(*) AS rows, COUNT(NULLIF(city, 'LARGE')) AS known_cities,
       {sql_money("average_rating")} AS total, {sql_money_avg("average_rating")} AS mean,
       MIN(average_rating) AS least, MAX(average_rating) AS best FROM restaurants""")
def global_counts(spark, sf_dir):
    rating = F.col("average_rating")
    return restaurants(spark, sf_dir).agg(
        F.count("*").alias("rows"),
        F.count(F.nullif(F.col("city"), F.lit("LARGE"))).alias("known_cities"),
        money_sum(rating).alias("total"),
        money_avg(rating).alias("mean"),
        F.min(rating).alias("least"),
        F.max(rating).alias("best"),
    )


@query("group_counts_having", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, city, COUNT(*) AS total, {sql_money_avg("average_rating")} AS avg_rating
FROM restaurants GROUP BY cuisine_type, city HAVING COUNT(*) >= 14 ORDER BY total DESC, cuisine_type, city""")
def group_counts_having(spark, sf_dir):
    grouped = restaurants(spark, sf_dir).groupBy("cuisine_type", "city")
    counted = grouped.agg(F.count("*").alias("total"), money_avg(F.col("average_rating")).alias("avg_rating"))
    return counted.filter(F.col("total") >= 14).orderBy(F.col("total").desc(), "cuisine_type", "city")


@query("grouped_kpi", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, COUNT(*) AS total, {sql_money_avg("average_rating")} AS avg_rating,
       MAX(average_rating) AS best_rating FROM restaurants GROUP BY cuisine_type ORDER BY avg_rating DESC, cuisine_type""")
def grouped_kpi(spark, sf_dir):
    return kpi_by(restaurants(spark, sf_dir), "cuisine_type", F.col("average_rating"))


@query("filter_group_mean", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, {sql_money_avg("average_rating")} AS avg_rating, COUNT(*) AS total FROM restaurants
WHERE average_rating > 940 GROUP BY cuisine_type ORDER BY avg_rating DESC, cuisine_type""")
def filter_group_mean(spark, sf_dir):
    """Filter, group, mean, sort: the question whose timings are on record for the original."""
    grouped = restaurants(spark, sf_dir).filter(F.col("average_rating") > 940).groupBy("cuisine_type")
    means = grouped.agg(money_avg(F.col("average_rating")).alias("avg_rating"), F.count("*").alias("total"))
    return means.orderBy(F.col("avg_rating").desc(), "cuisine_type")


@query("agg_dict", f"""
WITH {RESTAURANTS}
SELECT city, CAST(SUM(monthly_orders) AS BIGINT) AS total_orders, MAX(average_rating) AS best, COUNT(name) AS names
FROM restaurants GROUP BY city""")
def agg_dict(spark, sf_dir):
    """Aggregates named by a dict, whose columns are then given plain names."""
    wanted = {"monthly_orders": "sum", "average_rating": "max", "name": "count"}
    grouped = restaurants(spark, sf_dir).groupBy("city").agg(wanted)
    return grouped.withColumnsRenamed(
        {"sum(monthly_orders)": "total_orders", "max(average_rating)": "best", "count(name)": "names"}
    )


@query("distinct_values", f"""
WITH {RESTAURANTS}
SELECT city, COUNT(DISTINCT cuisine_type) AS cuisines, COUNT(DISTINCT name) AS names,
       COUNT(DISTINCT monthly_orders) AS sizes FROM restaurants GROUP BY city""")
def distinct_values(spark, sf_dir):
    return restaurants(spark, sf_dir).groupBy("city").agg(
        F.count_distinct("cuisine_type").alias("cuisines"),
        F.count_distinct("name").alias("names"),
        F.count_distinct("monthly_orders").alias("sizes"),
    )


@query("distinct_approx", f"""
WITH {TICKETS}
SELECT 'order_id' AS "column", COUNT(DISTINCT order_id) AS exact, true AS within FROM tickets UNION ALL
SELECT 'restaurant_id', COUNT(DISTINCT restaurant_id), true FROM tickets""")
def distinct_approx(spark, sf_dir):
    """Approximate counts beside exact ones; at most three standard errors apart."""
    lines = tickets(spark, sf_dir)
    return union_all([approximate_beside_exact(lines, c, 0.01) for c in ("order_id", "restaurant_id")])


@query("collect_members", f"""
WITH {RESTAURANTS}, numbered AS (
  SELECT cuisine_type, name, ROW_NUMBER() OVER (PARTITION BY cuisine_type ORDER BY name, restaurant_id) - 1 AS seat
  FROM restaurants)
SELECT cuisine_type, CAST((seat - seat % 1000) / 1000 AS BIGINT) AS chunk, STRING_AGG(name, '|' ORDER BY seat) AS members, COUNT(*) AS member_count
FROM numbered GROUP BY 1, 2""")
def collect_members(spark, sf_dir):
    collected = members(restaurants(spark, sf_dir), "cuisine_type", "name", "restaurant_id", chunk=1000)
    return collected.select(
        "cuisine_type",
        "chunk",
        F.concat_ws("|", "members").alias("members"),
        F.size("members").cast("bigint").alias("member_count"),
    )


@query("dispersion", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, ROUND(STDDEV_SAMP(average_rating), 4) AS std, ROUND(VAR_SAMP(average_rating), 4) AS variance,
       ROUND(STDDEV_SAMP(monthly_orders), 4) AS orders_std FROM restaurants GROUP BY cuisine_type""")
def dispersion(spark, sf_dir):
    return summarise(
        restaurants(spark, sf_dir),
        "cuisine_type",
        std=F.round(F.stddev_samp("average_rating"), 4),
        variance=F.round(F.var_samp("average_rating"), 4),
        orders_std=F.round(F.stddev_samp("monthly_orders"), 4),
    )


@query("quartiles", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, ROUND(QUANTILE_CONT(average_rating, 0.25), 4) AS q1,
       ROUND(QUANTILE_CONT(average_rating, 0.5), 4) AS median, ROUND(QUANTILE_CONT(average_rating, 0.75), 4) AS q3
FROM restaurants GROUP BY cuisine_type""")
def quartiles(spark, sf_dir):
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    exact = exact_percentiles(restaurants(spark, sf_dir), "cuisine_type", "average_rating", points)
    return exact.select("cuisine_type", *[F.round(p, 4).alias(p) for p in points])


@query("amount_quartiles", f"""
WITH {TICKETS}
SELECT ROUND(QUANTILE_CONT(amount, 0.25), 4) AS q1, ROUND(QUANTILE_CONT(amount, 0.5), 4) AS median,
       ROUND(QUANTILE_CONT(amount, 0.75), 4) AS q3 FROM tickets""")
def amount_quartiles(spark, sf_dir):
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    exact = exact_percentiles(tickets(spark, sf_dir), [], "amount", points)
    return exact.select(*[F.round(p, 4).alias(p) for p in points])


@query("approx_median", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, QUANTILE_DISC(average_rating, 0.5) AS median FROM restaurants GROUP BY cuisine_type""")
def approx_median(spark, sf_dir):
    """Exact as long as a group has fewer rows than the accuracy."""
    return restaurants(spark, sf_dir).groupBy("cuisine_type").agg(
        F.percentile_approx("average_rating", 0.5, 10_000).alias("median")
    )


_SUBTOTALS = """COUNT(*) AS total_restaurants, ROUND({sum} / COUNT(*), 2) AS avg_rating,
       CAST(SUM(monthly_orders) AS BIGINT) AS total_orders""".format(sum=sql_money("average_rating"))


def _totals():
    return {
        "total_restaurants": F.count("*"),
        "avg_rating": money_avg(F.col("average_rating")),
        "total_orders": F.sum("monthly_orders"),
    }


@query("rollup_report", f"""
WITH {RESTAURANTS}
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** ALL CUISINES **' ELSE cuisine_type END AS cuisine_type,
       CASE WHEN GROUPING(city) = 1 THEN '** ALL CITIES **' ELSE city END AS city, {_SUBTOTALS},
       CAST(GROUPING(cuisine_type) AS INTEGER) AS is_cuisine_subtotal, CAST(GROUPING(city) AS INTEGER) AS is_city_subtotal
FROM restaurants GROUP BY ROLLUP(cuisine_type, city)""")
def rollup_report(spark, sf_dir):
    rolled = subtotals(
        restaurants(spark, sf_dir),
        ["cuisine_type", "city"],
        _totals(),
        labels={"cuisine_type": "** ALL CUISINES **", "city": "** ALL CITIES **"},
        flags={"cuisine_type": "is_cuisine_subtotal", "city": "is_city_subtotal"},
    )
    return rolled.orderBy("is_cuisine_subtotal", F.col("cuisine_type").asc_nulls_last(), "is_city_subtotal", "city")


@query("rollup_null_keys", f"""
WITH {RESTAURANTS}, dirty AS (SELECT NULLIF(cuisine_type, 'Brand#4') AS cuisine_type FROM restaurants)
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** ALL **' ELSE cuisine_type END AS cuisine_type, COUNT(*) AS total,
       CAST(GROUPING(cuisine_type) AS INTEGER) AS is_total FROM dirty GROUP BY ROLLUP(cuisine_type)""")
def rollup_null_keys(spark, sf_dir):
    """A cuisine that is really null keeps its null beside the labelled total."""
    dirty = restaurants(spark, sf_dir).withColumn("cuisine_type", F.nullif(F.col("cuisine_type"), F.lit("Brand#4")))
    return subtotals(
        dirty,
        "cuisine_type",
        {"total": F.count("*")},
        labels={"cuisine_type": ALL_LABEL},
        flags={"cuisine_type": "is_total"},
    )


@query("rollup_single", f"""
WITH {RESTAURANTS}, {TICKETS}, per AS (
  SELECT r.restaurant_id, r.cuisine_type, r.average_rating, COUNT(t.order_id) AS orders,
         SUM(CAST(t.amount AS DECIMAL(12,2))) AS revenue
  FROM restaurants r LEFT JOIN tickets t ON r.restaurant_id = t.restaurant_id GROUP BY 1, 2, 3)
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** GRAND TOTAL **' ELSE cuisine_type END AS cuisine_type,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(SUM(orders) AS BIGINT) AS total_orders,
       {sql_money_avg("average_rating")} AS avg_rating FROM per GROUP BY ROLLUP(cuisine_type)""")
def rollup_single(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "average_rating")
    per = tickets(spark, sf_dir).groupBy("restaurant_id").agg(
        F.count("order_id").alias("orders"), money_total(F.col("amount")).alias("revenue")
    )
    joined = join_dimension(places, per, "restaurant_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return subtotals(
        joined,
        "cuisine_type",
        {
            "total_revenue": F.sum("revenue").cast("double"),
            "total_orders": F.sum("orders"),
            "avg_rating": money_avg(F.col("average_rating")),
        },
        labels={"cuisine_type": GRAND_TOTAL_LABEL},
    )


@query("cube_report", f"""
WITH {RESTAURANTS}
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** ALL **' ELSE cuisine_type END AS cuisine_type,
       CASE WHEN GROUPING(city) = 1 THEN '** ALL **' ELSE city END AS city, {_SUBTOTALS},
       CAST(GROUPING(cuisine_type) AS INTEGER) AS g_cuisine, CAST(GROUPING(city) AS INTEGER) AS g_city
FROM restaurants GROUP BY CUBE(cuisine_type, city)""")
def cube_report(spark, sf_dir):
    cubed = subtotals(
        restaurants(spark, sf_dir),
        ["cuisine_type", "city"],
        _totals(),
        kind="cube",
        labels={"cuisine_type": ALL_LABEL, "city": ALL_LABEL},
        flags={"cuisine_type": "g_cuisine", "city": "g_city"},
    )
    return cubed.orderBy(F.col("g_cuisine").desc(), F.col("g_city").desc(), "cuisine_type", "city")


@query("grouping_sets_report", f"""
WITH {RESTAURANTS}
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** ALL **' ELSE cuisine_type END AS cuisine_type,
       CASE WHEN GROUPING(city) = 1 THEN '** ALL **' ELSE city END AS city, COUNT(*) AS total
FROM restaurants GROUP BY GROUPING SETS ((cuisine_type, city), (cuisine_type), ())""")
def grouping_sets_report(spark, sf_dir):
    return subtotals(
        restaurants(spark, sf_dir),
        ["cuisine_type", "city"],
        {"total": F.count("*")},
        kind="sets",
        sets=[["cuisine_type", "city"], ["cuisine_type"], []],
        labels={"cuisine_type": ALL_LABEL, "city": ALL_LABEL},
    )


_HEADINGS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("pivot_avg", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, {", ".join(
    f"ROUND(AVG(CASE WHEN city = '{h}' THEN average_rating END), 2) AS {h.lower()}" for h in _HEADINGS)}
FROM restaurants GROUP BY cuisine_type""")
def pivot_avg(spark, sf_dir):
    pivoted = pivot_mean(restaurants(spark, sf_dir), "cuisine_type", "city", F.col("average_rating"), _HEADINGS)
    named = pivoted.withColumnsRenamed({h: h.lower() for h in _HEADINGS})
    return named.orderBy(F.col("economy").desc_nulls_last(), "cuisine_type")


@query("pivot_top", f"""
WITH {RESTAURANTS}
SELECT monthly_orders, {", ".join(
    f"ROUND(AVG(CASE WHEN city = '{h}' THEN average_rating END), 2) AS {h.lower()}" for h in _HEADINGS)}
FROM restaurants GROUP BY monthly_orders ORDER BY economy DESC NULLS LAST, monthly_orders LIMIT 10""")
def pivot_top(spark, sf_dir):
    """Pivot, null placement and limit together: a top-k of the pivoted rows."""
    pivoted = pivot_mean(restaurants(spark, sf_dir), "monthly_orders", "city", F.col("average_rating"), _HEADINGS)
    named = pivoted.withColumnsRenamed({h: h.lower() for h in _HEADINGS})
    return named.orderBy(F.col("economy").desc_nulls_last(), "monthly_orders").limit(10)


@query("share_of_total", f"""
WITH {RESTAURANTS}, labelled AS (SELECT {PRICE_LABEL} AS rating_label FROM restaurants)
SELECT rating_label, COUNT(*) AS total, ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM labelled), 1) AS pct
FROM labelled GROUP BY rating_label""")
def share_of_total_query(spark, sf_dir):
    label = ladder(F.col("average_rating"), PRICE_STEPS, RATING_REST)
    return share_of_total(restaurants(spark, sf_dir).select(label.alias("rating_label")), "rating_label")


@query("correlated_avg", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, name, cuisine_type, average_rating,
       (SELECT {sql_money_avg("r2.average_rating")} FROM restaurants r2 WHERE r2.cuisine_type = r.cuisine_type)
       AS cuisine_avg FROM restaurants r""")
def correlated_avg(spark, sf_dir):
    """A correlated scalar subquery, written as one aggregate joined back."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "name", "cuisine_type", "average_rating")
    return with_group_stats(places, "cuisine_type", {"cuisine_avg": money_avg(F.col("average_rating"))})


@query("describe_price", f"""
WITH {RESTAURANTS}
SELECT UNNEST(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS statistic,
       UNNEST([CAST(COUNT(*) AS DOUBLE), ROUND(AVG(average_rating), 4), ROUND(STDDEV_SAMP(average_rating), 4),
               MIN(average_rating), ROUND(QUANTILE_CONT(average_rating, 0.25), 4),
               ROUND(QUANTILE_CONT(average_rating, 0.5), 4), ROUND(QUANTILE_CONT(average_rating, 0.75), 4),
               MAX(average_rating)]) AS value FROM restaurants""")
def describe_price(spark, sf_dir):
    described = describe(restaurants(spark, sf_dir), "average_rating")
    return described.withColumn("value", F.round("value", 4))


@query("monthly_summary", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
       COUNT(*) AS order_count, {sql_money("amount")} AS total_revenue, {sql_money_avg("amount")} AS avg_order_value
FROM tickets GROUP BY 1, 2""")
def monthly_summary(spark, sf_dir):
    return (
        tickets(spark, sf_dir)
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(
            F.count("*").alias("order_count"),
            money_sum(F.col("amount")).alias("total_revenue"),
            money_avg(F.col("amount")).alias("avg_order_value"),
        )
        .orderBy("year", "month")
    )


@query("global_revenue_rank", f"""
WITH {RESTAURANTS}, {TICKETS}, rolled AS (
  SELECT cuisine_type, city, COUNT(*) AS orders, {sql_money("amount")} AS revenue, GROUPING(cuisine_type) AS gc,
         GROUPING(city) AS gt
  FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY ROLLUP(cuisine_type, city))
SELECT cuisine_type, city, orders, revenue, RANK() OVER (ORDER BY revenue DESC) AS revenue_rank
FROM rolled WHERE gc = 0 AND gt = 0""")
def global_revenue_rank(spark, sf_dir):
    """Rank of the detail rows of a rollup."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type", "city")
    joined = join_dimension(tickets(spark, sf_dir).select("restaurant_id", "amount"), places, "restaurant_id")
    rolled = subtotals(
        joined,
        ["cuisine_type", "city"],
        {"orders": F.count("*"), "revenue": money_sum(F.col("amount"))},
        flags={"cuisine_type": "is_cuisine_total", "city": "is_city_total"},
    )
    detail = rolled.filter("is_cuisine_total = 0 AND is_city_total = 0").drop("is_cuisine_total", "is_city_total")
    return rank_rows(stash(detail, "detail"), [], "revenue desc", rank="revenue_rank")
