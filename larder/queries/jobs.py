"""Complete batch jobs; each returns what it delivered, read back from storage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixed_values import PRICE_STEPS
from ..functions.columns import clean_phone
from ..plans import jobs, sql_modules
from ..plans.domain import phone_of
from ..session import scratch_path, stash, union_all
from ..sources.readers import read_source
from .registry import (
    PRICE_LABEL, RESTAURANTS, TICKETS, USERS, query, restaurants, sql_money, sql_money_avg, tickets, users,
)


def _with_phone(places):
    return places.withColumn("phone", phone_of(F.col("monthly_orders"), F.col("restaurant_id")))


_PHONE = "'+(' || LPAD(CAST(monthly_orders AS VARCHAR), 2, '0') || ') 3127-' || CAST(restaurant_id AS VARCHAR)"


@query("e2e_metrics", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT UPPER(TRIM(cuisine_type)) AS cuisine_type, city, {sql_money("amount")} AS total_revenue,
       COUNT(*) AS total_orders, {sql_money_avg("amount")} AS avg_order_value
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY 1, 2""")
def e2e_metrics(spark, sf_dir):
    people, places = users(spark, sf_dir), restaurants(spark, sf_dir)
    base = scratch_path(spark, "e2e")
    paths = jobs.end_to_end_job(people, places, tickets(spark, sf_dir), base, PRICE_STEPS)
    return read_source(spark, "parquet", paths["order_metrics"])


@query("e2e_users", rf"""
WITH {USERS} SELECT user_id, email, REGEXP_REPLACE(phone_number, '[()\-+]', '', 'g') AS phone_number FROM users""")
def e2e_users(spark, sf_dir):
    people, places = users(spark, sf_dir), restaurants(spark, sf_dir)
    base = scratch_path(spark, "e2e")
    paths = jobs.end_to_end_job(people, places, tickets(spark, sf_dir), base, PRICE_STEPS)
    return read_source(spark, "parquet", paths["users"])


@query("guarded_kpi", f"""
WITH {RESTAURANTS}, dirty AS (
  SELECT average_rating, COALESCE(NULLIF(cuisine_type, 'Brand#8'), 'Unknown') AS cuisine_type FROM restaurants)
SELECT cuisine_type, COUNT(*) AS total, {sql_money_avg("average_rating")} AS avg_rating,
       MAX(average_rating) AS best_rating FROM dirty GROUP BY cuisine_type""")
def guarded_kpi(spark, sf_dir):
    dirty = _with_phone(restaurants(spark, sf_dir)).withColumn(
        "cuisine_type", F.nullif(F.col("cuisine_type"), F.lit("Brand#8"))
    )
    path = jobs.guarded_job(dirty, f"{scratch_path(spark, 'guarded')}/kpi", steps=PRICE_STEPS)
    return read_source(spark, "parquet", path)


@query("medallion_paths", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, COUNT(*) AS total, {sql_money_avg("average_rating")} AS avg_rating,
       MAX(average_rating) AS best_rating FROM restaurants GROUP BY cuisine_type""")
def medallion_paths(spark, sf_dir):
    return jobs.medallion_by_path(restaurants(spark, sf_dir), scratch_path(spark, "layers"), PRICE_STEPS)


@query("medallion_tables", f"""
WITH {RESTAURANTS}, silver AS (
  SELECT *, CASE WHEN average_rating > 990 THEN 990.0 WHEN average_rating < 910 THEN 910.0 ELSE average_rating END
         AS validated_rating FROM restaurants)
SELECT restaurant_id, name, cuisine_type, city, validated_rating,
       ROUND(validated_rating * SQRT(monthly_orders / 1000.0), 4) AS popularity_score,
       CASE WHEN validated_rating >= 975 THEN 'Excelente' WHEN validated_rating >= 950 THEN 'Muito Bom'
            WHEN validated_rating >= 925 THEN 'Bom' ELSE 'Regular' END AS category FROM silver""")
def medallion_tables(spark, sf_dir):
    steps = [(975.0, "Excelente"), (950.0, "Muito Bom"), (925.0, "Bom")]
    prefix = f"larder_{uuid.uuid4().hex[:12]}"
    base = scratch_path(spark, "tables")
    return jobs.medallion_by_table(restaurants(spark, sf_dir), prefix, base, 910.0, 990.0, steps, "Regular")


@query("sql_clean_job", rf"""
WITH {RESTAURANTS}, dirty AS (
  SELECT NULLIF(restaurant_id, 7) AS restaurant_id, NULLIF(cuisine_type, 'Brand#6') AS cuisine_type,
         NULLIF(average_rating, 950.0) AS average_rating, {_PHONE} AS phone FROM restaurants),
clean AS (
  SELECT COALESCE(cuisine_type, 'Unknown') AS cuisine_type, COALESCE(average_rating, 0) AS average_rating,
         REGEXP_REPLACE(phone, '[()\s\-]', '', 'g') AS phone FROM dirty WHERE restaurant_id IS NOT NULL)
SELECT cuisine_type, COUNT(*) AS total, {sql_money_avg("average_rating")} AS avg_rating,
       MAX(average_rating) AS best_rating, COUNT(DISTINCT phone) AS phones FROM clean GROUP BY cuisine_type""")
def sql_clean_job(spark, sf_dir):
    dirty = _with_phone(restaurants(spark, sf_dir)).select(
        F.nullif(F.col("restaurant_id"), F.lit(7)).alias("restaurant_id"),
        "name",
        F.nullif(F.col("cuisine_type"), F.lit("Brand#6")).alias("cuisine_type"),
        F.nullif(F.col("average_rating"), F.lit(950.0)).alias("average_rating"),
        "phone",
    )
    return jobs.sql_cleaning_job(dirty, scratch_path(spark, "sql-clean"), dirty.schema)


_DELIVERED = f"""
WITH {RESTAURANTS}, scored AS (
  SELECT *, average_rating * SQRT(monthly_orders / 100.0) AS popularity_score FROM restaurants)
SELECT cuisine_type, {sql_money_avg("average_rating")} AS avg_rating,
       CAST(SUM(monthly_orders) AS BIGINT) AS total_reviews, ROUND(AVG(popularity_score), 4) AS avg_popularity,
       COUNT(name) AS restaurant_count FROM scored GROUP BY cuisine_type"""


@query("analytics_delivery", _DELIVERED)
def analytics_delivery(spark, sf_dir):
    """The CSV summary, read with the schema of its Parquet twin."""
    paths = jobs.analytics_delivery(restaurants(spark, sf_dir), scratch_path(spark, "analytics"))
    schema = read_source(spark, "parquet", paths["parquet"]).schema
    return read_source(spark, "csv", paths["csv"], schema=schema)


@query("analytics_partition", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, ROUND(average_rating * SQRT(monthly_orders / 100.0), 4) AS popularity_score
FROM restaurants WHERE city = 'SMALL' AND cuisine_type = 'Brand#2'""")
def analytics_partition(spark, sf_dir):
    """One directory of the detail delivery."""
    paths = jobs.analytics_delivery(restaurants(spark, sf_dir), scratch_path(spark, "analytics"))
    detail = read_source(spark, "parquet", paths["detail"])
    one = detail.filter((F.col("city") == "SMALL") & (F.col("cuisine_type") == "Brand#2"))
    return one.select("restaurant_id", F.round("popularity_score", 4).alias("popularity_score"))


@query("cte_chain", f"""
WITH {RESTAURANTS}, scored AS (
  SELECT restaurant_id, name, cuisine_type, ROUND(average_rating * SQRT(monthly_orders / 100.0), 2) AS popularity_score
  FROM restaurants),
means AS (SELECT cuisine_type, {sql_money_avg("popularity_score")} AS cuisine_avg FROM scored GROUP BY cuisine_type)
SELECT restaurant_id, name, cuisine_type, popularity_score, cuisine_avg,
       ROUND(popularity_score - cuisine_avg, 2) AS diff_from_avg FROM scored JOIN means USING (cuisine_type)""")
def cte_chain(spark, sf_dir):
    return jobs.score_against_group(restaurants(spark, sf_dir))


# --- the modular SQL job, one query per module output -------------------------------


def _views(spark, sf_dir):
    places = restaurants(spark, sf_dir)
    dated = tickets(spark, sf_dir).withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    return sql_modules.clean_views(places, dated, PRICE_STEPS)


@query("sql_best_per_cuisine", f"""
WITH {RESTAURANTS}, stats AS (
  SELECT cuisine_type, {sql_money_avg("average_rating")} AS cuisine_avg_rating,
         CAST(SUM(monthly_orders) AS BIGINT) AS cuisine_total_orders FROM restaurants GROUP BY cuisine_type),
ranked AS (
  SELECT *, {PRICE_LABEL} AS rating_label, RANK() OVER (PARTITION BY cuisine_type ORDER BY average_rating DESC)
         AS rank_in_cuisine FROM restaurants)
SELECT r.restaurant_id, r.name, UPPER(TRIM(r.cuisine_type)) AS cuisine_type, r.city, r.average_rating, r.rating_label,
       r.rank_in_cuisine, s.cuisine_avg_rating,
       ROUND(r.average_rating - s.cuisine_avg_rating, 2) AS above_cuisine_avg, s.cuisine_total_orders
FROM ranked r JOIN stats s ON r.cuisine_type = s.cuisine_type WHERE r.rank_in_cuisine <= 2""")
def sql_best_per_cuisine(spark, sf_dir):
    return sql_modules.best_per_cuisine(_views(spark, sf_dir)[0])


@query("sql_label_shares", f"""
WITH {RESTAURANTS}, labelled AS (SELECT {PRICE_LABEL} AS rating_label FROM restaurants)
SELECT rating_label, COUNT(*) AS total, ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM labelled), 1) AS pct
FROM labelled GROUP BY rating_label""")
def sql_label_shares(spark, sf_dir):
    return sql_modules.label_shares(_views(spark, sf_dir)[0])


@query("sql_monthly_trend", f"""
WITH {TICKETS}, months AS (
  SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
         COUNT(*) AS order_count, SUM(CAST(amount AS DECIMAL(12,2))) AS revenue FROM tickets GROUP BY 1, 2)
SELECT year, month, order_count, CAST(revenue AS DOUBLE) AS total_revenue,
       ROUND(CAST(revenue AS DOUBLE) / order_count, 2) AS avg_order_value,
       CAST(SUM(revenue) OVER (ORDER BY year, month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative_revenue,
       CAST(revenue - COALESCE(LAG(revenue) OVER (ORDER BY year, month), revenue) AS DOUBLE) AS mom_change
FROM months""")
def sql_monthly_trend(spark, sf_dir):
    return sql_modules.monthly_trend(_views(spark, sf_dir)[1])


@query("sql_weekday_pattern", f"""
WITH {TICKETS}
SELECT CAST(DAYOFWEEK(order_date) + 1 AS INTEGER) AS day_of_week,
       CASE DAYOFWEEK(order_date) WHEN 0 THEN 'Sun' WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed'
            WHEN 4 THEN 'Thu' WHEN 5 THEN 'Fri' ELSE 'Sat' END AS day_name,
       COUNT(*) AS orders, {sql_money("amount")} AS revenue FROM tickets GROUP BY 1, 2""")
def sql_weekday_pattern(spark, sf_dir):
    return sql_modules.weekday_pattern(_views(spark, sf_dir)[1])


_PER = """per AS (
  SELECT r.restaurant_id, r.cuisine_type, r.city, r.average_rating, COUNT(t.order_id) AS orders,
         SUM(CAST(t.amount AS DECIMAL(12,2))) AS revenue
  FROM restaurants r LEFT JOIN tickets t ON r.restaurant_id = t.restaurant_id GROUP BY 1, 2, 3, 4)"""


@query("sql_revenue_report", f"""
WITH {RESTAURANTS}, {TICKETS}, {_PER}, grouped AS (
  SELECT UPPER(TRIM(cuisine_type)) AS cuisine_type, city, COUNT(*) AS restaurant_count,
         CAST(SUM(orders) AS BIGINT) AS total_orders, CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
         ROUND(CAST(SUM(revenue) AS DOUBLE) / NULLIF(SUM(orders), 0), 2) AS avg_ticket FROM per GROUP BY 1, 2)
SELECT *, RANK() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank FROM grouped""")
def sql_revenue_report(spark, sf_dir):
    return sql_modules.revenue_report(*_views(spark, sf_dir))


@query("sql_cuisine_totals", f"""
WITH {RESTAURANTS}, {TICKETS}, {_PER}
SELECT CASE WHEN GROUPING(cuisine_type) = 1 THEN '** GRAND TOTAL **' ELSE UPPER(TRIM(cuisine_type)) END AS cuisine_type,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(SUM(orders) AS BIGINT) AS total_orders,
       {sql_money_avg("average_rating")} AS avg_rating FROM per GROUP BY ROLLUP(cuisine_type)""")
def sql_cuisine_totals(spark, sf_dir):
    return sql_modules.cuisine_totals(*_views(spark, sf_dir))


@query("sql_job_row_counts", f"""
WITH {RESTAURANTS}, {TICKETS},
ranked AS (SELECT RANK() OVER (PARTITION BY cuisine_type ORDER BY average_rating DESC) AS r FROM restaurants)
SELECT 'best_per_cuisine' AS module, (SELECT COUNT(*) FROM ranked WHERE r <= 2) AS rows UNION ALL
SELECT 'label_shares', (SELECT COUNT(DISTINCT {PRICE_LABEL}) FROM restaurants) UNION ALL
SELECT 'monthly_trend', (SELECT COUNT(DISTINCT DATE_TRUNC('month', order_date)) FROM tickets) UNION ALL
SELECT 'weekday_pattern', (SELECT COUNT(DISTINCT DAYOFWEEK(order_date)) FROM tickets) UNION ALL
SELECT 'revenue_report', (SELECT COUNT(*) FROM (SELECT DISTINCT cuisine_type, city FROM restaurants)) UNION ALL
SELECT 'cuisine_totals', (SELECT COUNT(DISTINCT cuisine_type) + 1 FROM restaurants)""")
def sql_job_row_counts(spark, sf_dir):
    """The whole modular job: every module over the same cleaned frames."""
    places = restaurants(spark, sf_dir)
    dated = tickets(spark, sf_dir).withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    reports = sql_modules.run_modules(places, dated, PRICE_STEPS)
    counted = [df.agg(F.lit(name).alias("module"), F.count("*").alias("rows")) for name, df in reports.items()]
    return union_all(counted)


@query("observed_job", f"""
WITH {USERS} SELECT user_id, REGEXP_REPLACE(phone_number, '[()\\-+]', '', 'g') AS phone_number,
       COUNT(*) OVER () AS source_rows FROM users""")
def observed_job(spark, sf_dir):
    """The template: a source, steps, and its row count taken on the way."""
    result, seen = jobs.run_job(
        users(spark, sf_dir),
        [
            lambda df: df.withColumn("phone_number", clean_phone(F.col("phone_number"))),
            lambda df: df.select("user_id", "phone_number"),
        ],
        name="users",
    )
    result = stash(result, "observed")  # the count is known once the rows have passed
    return result.withColumn("source_rows", F.lit(seen.get["rows"]).cast("bigint"))
