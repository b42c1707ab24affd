"""Projection, column shaping, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import (
    AMOUNT_NULL, AMOUNT_REST, CUISINE_DEFAULT, FILL_DEFAULTS, GRADE_NULL, GRADE_REST, PRICE_STEPS, RATING_REST,
    TIER_REST, WEEKDAYS,
)
from ..functions.columns import (
    clamp, clean_phone, date_parts, every_salt, ladder, log_score, lookup, money_avg, money_sum, money_total, normalized,
    parse_timestamp, random_salt, ratio, root_score, sentence_case, stable_salt, unit_scale,
)
from ..operators.joins import equi_join, join_dimension
from ..plans.jobs import rating_job
from ..sources.catalog import views_of
from .registry import (
    PRICE_LABEL, RESTAURANTS, TICKETS, USERS, query, restaurants, sql_money, sql_money_avg, table, tickets, users,
)


@query("select_filter_sort", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, name AS restaurant_name, cuisine_type, average_rating FROM restaurants
WHERE average_rating > 950 AND city = 'SMALL' ORDER BY average_rating DESC, restaurant_id""")
def select_filter_sort(spark, sf_dir):
    return (
        restaurants(spark, sf_dir)
        .filter((F.col("average_rating") > 950) & (F.col("city") == "SMALL"))
        .withColumnRenamed("name", "restaurant_name")
        .drop("city", "monthly_orders")
        .orderBy(F.col("average_rating").desc(), "restaurant_id")
    )


@query("predicates", f"""
WITH {RESTAURANTS}, dirty AS (
  SELECT *, NULLIF(city, 'LARGE') AS known_city FROM restaurants)
SELECT restaurant_id, name, cuisine_type, known_city, name LIKE '%bolt' AS is_bolt FROM dirty
WHERE cuisine_type IN ('Brand#1', 'Brand#7', 'Brand#12') AND average_rating BETWEEN 910 AND 985
  AND known_city IS NOT NULL AND (name LIKE 'small%' OR CONTAINS(name, 'bolt'))""")
def predicates(spark, sf_dir):
    dirty = restaurants(spark, sf_dir).withColumn("known_city", F.nullif(F.col("city"), F.lit("LARGE")))
    return dirty.filter(
        F.col("cuisine_type").isin("Brand#1", "Brand#7", "Brand#12")
        & F.col("average_rating").between(910, 985)
        & F.col("known_city").isNotNull()
        & (F.col("name").like("small%") | F.col("name").contains("bolt"))
    ).select("restaurant_id", "name", "cuisine_type", "known_city", F.col("name").like("%bolt").alias("is_bolt"))


@query("filter_then_project", f"""
WITH {RESTAURANTS} SELECT name, average_rating FROM restaurants WHERE average_rating >= 975""")
def filter_then_project(spark, sf_dir):
    return restaurants(spark, sf_dir).filter(F.col("average_rating") >= 975).select("name", "average_rating")


@query("rating_bucket", f"""
WITH {RESTAURANTS} SELECT restaurant_id, average_rating, {PRICE_LABEL} AS rating_category FROM restaurants""")
def rating_bucket(spark, sf_dir):
    label = ladder(F.col("average_rating"), PRICE_STEPS, RATING_REST)
    return restaurants(spark, sf_dir).select("restaurant_id", "average_rating", label.alias("rating_category"))


@query("rating_report", f"""
WITH {RESTAURANTS} SELECT *, {PRICE_LABEL} AS rating_category FROM restaurants""")
def rating_report(spark, sf_dir):
    return rating_job(restaurants(spark, sf_dir), PRICE_STEPS)


@query("bucket_variants", f"""
WITH {RESTAURANTS}, dirty AS (
  SELECT restaurant_id, average_rating, NULLIF(average_rating, 950.0) AS rating FROM restaurants)
SELECT restaurant_id,
  CASE WHEN rating IS NULL THEN 'Sem Avaliacao' WHEN rating >= 975 THEN 'Excelente' WHEN rating >= 950 THEN 'Muito Bom'
       WHEN rating >= 925 THEN 'Bom' ELSE 'Regular' END AS grade,
  CASE WHEN rating >= 975 THEN 'Excelente' WHEN rating >= 950 THEN 'Muito Bom' WHEN rating >= 910 THEN 'Bom'
       ELSE 'Regular' END AS grade_wide,
  CASE WHEN average_rating >= 975 THEN 'Tier 1 - Star' WHEN average_rating >= 950 THEN 'Tier 2 - Good'
       ELSE 'Tier 3 - Standard' END AS performance_tier
FROM dirty""")
def bucket_variants(spark, sf_dir):
    rating = F.nullif(F.col("average_rating"), F.lit(950.0))
    top, second = (975.0, "Excelente"), (950.0, "Muito Bom")
    grade = ladder(rating, [top, second, (925.0, "Bom")], GRADE_REST, null_label=GRADE_NULL)
    wide = ladder(rating, [top, second, (910.0, "Bom")], GRADE_REST)
    tier = ladder(F.col("average_rating"), [(975.0, "Tier 1 - Star"), (950.0, "Tier 2 - Good")], TIER_REST)
    return restaurants(spark, sf_dir).select(
        "restaurant_id", grade.alias("grade"), wide.alias("grade_wide"), tier.alias("performance_tier")
    )


@query("amount_bucket", f"""
WITH {TICKETS}, dirty AS (SELECT NULLIF(amount, 0) AS amount FROM tickets)
SELECT CASE WHEN amount IS NULL THEN 'Unknown' WHEN amount > 75000 THEN 'High' WHEN amount > 35000 THEN 'Medium'
       ELSE 'Low' END AS revenue_category, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM dirty GROUP BY 1""")
def amount_bucket(spark, sf_dir):
    label = ladder(
        F.col("amount"), [(75000.0, "High"), (35000.0, "Medium")], AMOUNT_REST, null_label=AMOUNT_NULL, inclusive=False
    )
    return (
        tickets(spark, sf_dir)
        .groupBy(label.alias("revenue_category"))
        .agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))
    )


@query("clamp", """
SELECT *, CASE WHEN c_acctbal > 5000 THEN 5000.0 WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS validated_balance
FROM (SELECT c_custkey, c_name, NULLIF(c_acctbal, 2547.4) AS c_acctbal FROM customer)""")
def clamp_balance(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_acctbal"), F.lit(2547.4)).alias("c_acctbal")
    )
    return customers.withColumn("validated_balance", clamp(F.col("c_acctbal"), 0.0, 5000.0))


@query("sql_param_postprocess", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT r.cuisine_type, r.city, COUNT(t.order_id) AS total_orders, {sql_money("t.amount")} AS total_revenue,
       CASE WHEN {sql_money("t.amount")} > 20000000 THEN 'Yes' ELSE 'No' END AS is_high_revenue
FROM restaurants r LEFT JOIN tickets t ON r.restaurant_id = t.restaurant_id
WHERE r.average_rating > 935 GROUP BY r.cuisine_type, r.city""")
def sql_param_postprocess(spark, sf_dir, threshold: float = 20_000_000.0):
    """SQL for the join and grouping, then a column that depends on a Python value."""
    places = restaurants(spark, sf_dir)
    per_restaurant = tickets(spark, sf_dir).groupBy("restaurant_id").agg(
        F.count("order_id").alias("orders"), money_total(F.col("amount")).alias("revenue")
    )
    grouped = spark.sql(
        """SELECT r.cuisine_type, r.city, COALESCE(SUM(o.orders), 0) AS total_orders,
                  CAST(SUM(o.revenue) AS DOUBLE) AS total_revenue
           FROM {places} r LEFT JOIN {orders} o ON r.restaurant_id = o.restaurant_id
           WHERE r.average_rating > :least GROUP BY r.cuisine_type, r.city""",
        args={"least": 935.0},
        places=places,
        orders=per_restaurant,
    )
    is_high = F.when(F.col("total_revenue") > threshold, "Yes").otherwise("No")
    return grouped.withColumn("is_high_revenue", is_high)


@query("expr_projection_agg", f"""
WITH {RESTAURANTS}, shaped AS (
  SELECT average_rating, {PRICE_LABEL} AS rating_label,
         FLOOR((2 * ROUND(average_rating * 100) + monthly_orders) / (2 * monthly_orders)) / 100 AS rating_per_order,
         UPPER(LEFT(name, 1)) || LOWER(SUBSTRING(name, 2)) AS capitalized FROM restaurants)
SELECT rating_label, COUNT(*) AS total, {sql_money_avg("rating_per_order", 4)} AS avg_per_order,
       MIN(capitalized) AS first_name FROM shaped GROUP BY rating_label""")
def expr_projection_agg(spark, sf_dir):
    shaped = restaurants(spark, sf_dir).select(
        F.expr(
            "CASE WHEN average_rating >= 975 THEN 'Excellent' WHEN average_rating >= 950 THEN 'Good' "
            "ELSE 'Average' END AS rating_label"
        ),
        F.expr("ROUND(try_divide(CAST(average_rating AS DECIMAL(12,2)), monthly_orders), 2) AS rating_per_order"),
        sentence_case(F.col("name")).alias("capitalized"),
    )
    return shaped.groupBy("rating_label").agg(
        F.expr("COUNT(*) AS total"),
        F.expr("ROUND(CAST(SUM(rating_per_order) AS DOUBLE) / COUNT(*), 4) AS avg_per_order"),
        F.expr("MIN(capitalized) AS first_name"),
    )


@query("transform_chain", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, UPPER(TRIM(cuisine_type)) AS cuisine_type, ROUND(average_rating / 1000, 4) AS rating_unit,
       average_rating >= 950 AS is_top, city || ', ' || name AS place, {PRICE_LABEL} AS rating_category
FROM restaurants WHERE monthly_orders > 25""")
def transform_chain(spark, sf_dir):
    def normalise(df):
        return df.withColumn("cuisine_type", normalized(F.col("cuisine_type"), CUISINE_DEFAULT))

    def enrich(df):
        return df.withColumns(
            {
                "rating_unit": F.round(unit_scale(F.col("average_rating"), 1000), 4),
                "is_top": F.col("average_rating") >= 950,
                "place": F.concat("city", F.lit(", "), "name"),
            }
        )

    def label(df):
        return df.withColumn("rating_category", ladder(F.col("average_rating"), PRICE_STEPS, RATING_REST))

    return (
        restaurants(spark, sf_dir)
        .transform(normalise)
        .filter(F.col("monthly_orders") > 25)
        .transform(enrich)
        .transform(label)
        .select("restaurant_id", "cuisine_type", "rating_unit", "is_top", "place", "rating_category")
    )


@query("regex_clean", rf"""
WITH {USERS}, dirty AS (SELECT user_id, NULLIF(phone_number, '+(19) 3127-1') AS phone FROM users)
SELECT user_id, REGEXP_REPLACE(phone, '[()\-+]', '', 'g') AS with_spaces,
       REGEXP_REPLACE(phone, '[()\s\-]', '', 'g') AS without_spaces FROM dirty""")
def regex_clean(spark, sf_dir):
    phone = F.nullif(F.col("phone_number"), F.lit("+(19) 3127-1"))
    return users(spark, sf_dir).select(
        "user_id",
        clean_phone(phone).alias("with_spaces"),
        clean_phone(phone, keep_spaces=False).alias("without_spaces"),
    )


@query("normalize_fill", f"""
WITH {RESTAURANTS}, dirty AS (
  SELECT restaurant_id, NULLIF('  ' || LOWER(cuisine_type) || ' ', '  brand#3 ') AS written,
         NULLIF(cuisine_type, 'Brand#5') AS cuisine_type, NULLIF(name, 'red widget') AS phone FROM restaurants)
SELECT restaurant_id, COALESCE(UPPER(TRIM(written)), 'UNKNOWN') AS normalized,
       COALESCE(cuisine_type, 'Unknown') AS cuisine_type, COALESCE(phone, 'N/A') AS phone FROM dirty""")
def normalize_fill(spark, sf_dir):
    written = F.concat(F.lit("  "), F.lower("cuisine_type"), F.lit(" "))
    dirty = restaurants(spark, sf_dir).select(
        "restaurant_id",
        normalized(F.nullif(written, F.lit("  brand#3 ")), CUISINE_DEFAULT).alias("normalized"),
        F.nullif(F.col("cuisine_type"), F.lit("Brand#5")).alias("cuisine_type"),
        F.nullif(F.col("name"), F.lit("red widget")).alias("phone"),
    )
    return dirty.fillna(FILL_DEFAULTS)


@query("concat_case_len", f"""
WITH {RESTAURANTS}, dirty AS (SELECT restaurant_id, name, city, NULLIF(cuisine_type, 'Brand#9') AS cuisine FROM restaurants)
SELECT restaurant_id, city || ', ' || cuisine AS strict, CONCAT_WS(', ', city, cuisine) AS lenient,
       UPPER(name) AS upper_name, LOWER(city) AS lower_city, CAST(LENGTH(name) AS INTEGER) AS name_len,
       CONTAINS(name, 'ring') AS has_ring, UPPER(LEFT(city, 1)) || LOWER(SUBSTRING(city, 2)) AS city_case
FROM dirty""")
def concat_case_len(spark, sf_dir):
    """``concat`` is null when a part is; ``concat_ws`` leaves the part out."""
    cuisine = F.nullif(F.col("cuisine_type"), F.lit("Brand#9"))
    return restaurants(spark, sf_dir).select(
        "restaurant_id",
        F.concat(F.col("city"), F.lit(", "), cuisine).alias("strict"),
        F.concat_ws(", ", F.col("city"), cuisine).alias("lenient"),
        F.upper("name").alias("upper_name"),
        F.lower("city").alias("lower_city"),
        F.length("name").alias("name_len"),
        F.col("name").contains("ring").alias("has_ring"),
        sentence_case(F.col("city")).alias("city_case"),
    )


@query("scores", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, ROUND(average_rating * SQRT(monthly_orders / 1000.0), 4) AS score_thousand,
       ROUND(average_rating * SQRT(monthly_orders / 100.0), 4) AS score_hundred,
       ROUND(SQRT(monthly_orders) * average_rating / 5, 4) AS score_unit,
       ROUND(average_rating * average_rating * LN(1 + monthly_orders) / 10, 3) AS score_log,
       ROUND(average_rating / 5, 4) AS rating_unit FROM restaurants""")
def scores(spark, sf_dir):
    rating, reviews = F.col("average_rating"), F.col("monthly_orders")
    return restaurants(spark, sf_dir).select(
        "restaurant_id",
        F.round(root_score(rating, reviews), 4).alias("score_thousand"),
        F.round(root_score(rating, reviews, 100), 4).alias("score_hundred"),
        F.round(root_score(rating, reviews, 1, top=5), 4).alias("score_unit"),
        F.round(log_score(rating, reviews), 3).alias("score_log"),
        F.round(unit_scale(rating, 5), 4).alias("rating_unit"),
    )


@query("ratio_safe", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, ROUND(average_rating / NULLIF(monthly_orders - 10, 0), 3) AS per_order FROM restaurants""")
def ratio_safe(spark, sf_dir):
    per_order = ratio(F.col("average_rating"), F.col("monthly_orders") - 10, 3)
    return restaurants(spark, sf_dir).select("restaurant_id", per_order.alias("per_order"))


@query("date_parts", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month,
       CAST(DAYOFWEEK(order_date) + 1 AS INTEGER) AS dayofweek, COUNT(*) AS orders
FROM tickets GROUP BY 1, 2, 3""")
def date_parts_count(spark, sf_dir):
    """Dates arrive as ISO text, as in the original feed."""
    written = tickets(spark, sf_dir).withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    return (
        date_parts(written, "order_date").groupBy("year", "month", "dayofweek").agg(F.count("*").alias("orders"))
    )


@query("timestamp_parse", """
SELECT event_type, COUNT(*) AS events, CAST(SUM(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS BIGINT) AS parsed,
       MIN(CASE WHEN event_type <> 'error' THEN DATE_TRUNC('second', ts) END) AS first_ts,
       MAX(CASE WHEN event_type <> 'error' THEN DATE_TRUNC('second', ts) END) AS last_ts
FROM events GROUP BY event_type""")
def timestamp_parse(spark, sf_dir):
    """Text to timestamp; text that is no timestamp becomes null instead of ending the job."""
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    )
    parsed = table(spark, sf_dir, "events").withColumn(
        "parsed_ts", parse_timestamp(text, "yyyy/MM/dd HH:mm:ss").cast("timestamp_ntz")
    )
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.count("parsed_ts").alias("parsed"),
        F.min("parsed_ts").alias("first_ts"),
        F.max("parsed_ts").alias("last_ts"),
    )


@query("casts", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, CAST(SPLIT_PART(cuisine_type, '#', 2) AS INTEGER) AS cuisine_number,
       TRY_CAST(city AS INTEGER) AS city_number, CAST(FLOOR(average_rating) AS INTEGER) AS whole_rating
FROM restaurants""")
def casts(spark, sf_dir):
    return restaurants(spark, sf_dir).select(
        "restaurant_id",
        F.split_part("cuisine_type", F.lit("#"), F.lit(2)).cast("int").alias("cuisine_number"),
        F.col("city").try_cast("int").alias("city_number"),
        F.col("average_rating").cast("int").alias("whole_rating"),
    )


@query("weekday_names", f"""
WITH {TICKETS}
SELECT CAST(DAYOFWEEK(order_date) + 1 AS INTEGER) AS day_of_week,
       CASE DAYOFWEEK(order_date) WHEN 0 THEN 'Sun' WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed'
            WHEN 4 THEN 'Thu' WHEN 5 THEN 'Fri' ELSE 'Sat' END AS day_name,
       COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM tickets GROUP BY 1, 2""")
def weekday_names(spark, sf_dir):
    return (
        tickets(spark, sf_dir)
        .groupBy(F.dayofweek("order_date").alias("day_of_week"))
        .agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))
        .select("day_of_week", lookup(F.col("day_of_week"), WEEKDAYS).alias("day_name"), "orders", "revenue")
        .orderBy("day_of_week")
    )


@query("salted_counts", f"""
WITH {TICKETS} SELECT restaurant_id, COUNT(*) AS orders FROM tickets GROUP BY restaurant_id""")
def salted_counts(spark, sf_dir):
    """Two-step count: by key and bucket, then by key, with the buckets as exploded rows."""
    buckets = 8
    places = restaurants(spark, sf_dir).select("restaurant_id", every_salt(buckets).alias("salt"))
    salted = tickets(spark, sf_dir).withColumn("salt", stable_salt(buckets, "order_id", "line", "driver_id"))
    partial = salted.groupBy("restaurant_id", "salt").agg(F.count("*").alias("rows"))
    # Merged, as the estimate of the places leaves their copies out: each task would hold all of them.
    joined = equi_join(partial, places.hint("merge"), ["restaurant_id", "salt"])
    return joined.groupBy("restaurant_id").agg(F.sum("rows").alias("orders"))


@query("random_salt_spread", f"WITH {TICKETS} SELECT CAST(8 AS BIGINT) AS buckets, COUNT(*) AS orders FROM tickets")
def random_salt_spread(spark, sf_dir):
    """A seeded salt over a file scan repeats when a task does; counts only, no rows travel by it."""
    salted = tickets(spark, sf_dir).groupBy(random_salt(8, seed=42).alias("salt")).agg(F.count("*").alias("rows"))
    return salted.agg(F.count("*").alias("buckets"), F.sum("rows").alias("orders"))


@query("view_report", f"""
WITH {RESTAURANTS}, tiers AS (
  SELECT *, CASE WHEN average_rating >= 975 THEN 'Tier 1 - Star' WHEN average_rating >= 950 THEN 'Tier 2 - Good'
                 ELSE 'Tier 3 - Standard' END AS performance_tier FROM restaurants)
SELECT performance_tier, cuisine_type, COUNT(*) AS restaurant_count,
       ROUND(CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*), 2) AS avg_rating
FROM tiers GROUP BY performance_tier, cuisine_type""")
def view_report(spark, sf_dir):
    """Columns built in Python, handed to SQL as a view."""
    tier = ladder(F.col("average_rating"), [(975.0, "Tier 1 - Star"), (950.0, "Tier 2 - Good")], TIER_REST)
    with views_of(spark, enriched_restaurants=restaurants(spark, sf_dir).withColumn("performance_tier", tier)):
        return spark.sql(
            """SELECT performance_tier, cuisine_type, COUNT(*) AS restaurant_count,
                      ROUND(CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*), 2) AS avg_rating
               FROM enriched_restaurants GROUP BY performance_tier, cuisine_type
               ORDER BY performance_tier, cuisine_type"""
        )


@query("hybrid_equivalence", f"""
WITH {RESTAURANTS}, one AS (
  SELECT cuisine_type, COUNT(*) AS total, ROUND(CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*), 2)
         AS avg_rating FROM restaurants WHERE average_rating > 950 GROUP BY cuisine_type)
SELECT way, one.* FROM one, (VALUES ('dataframe'), ('expr'), ('sql')) ways(way)""")
def hybrid_equivalence(spark, sf_dir):
    """One question asked three ways; Catalyst sees the same plan each time."""
    places = restaurants(spark, sf_dir)
    mean_sql = "ROUND(CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*), 2) AS avg_rating"
    by_sql = spark.sql(
        f"SELECT cuisine_type, COUNT(*) AS total, {mean_sql} FROM {{places}} "
        "WHERE average_rating > 950 GROUP BY cuisine_type",
        places=places,
    )
    high = places.filter(F.col("average_rating") > 950).groupBy("cuisine_type")
    by_frame = high.agg(F.count("*").alias("total"), money_avg(F.col("average_rating")).alias("avg_rating"))
    by_expr = high.agg(F.expr("COUNT(*) AS total"), F.expr(mean_sql))
    ways = {"dataframe": by_frame, "expr": by_expr, "sql": by_sql}
    named = [df.select(F.lit(way).alias("way"), "cuisine_type", "total", "avg_rating") for way, df in ways.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("distinct_pairs", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT DISTINCT r.cuisine_type, t.driver_id FROM tickets t JOIN restaurants r ON t.restaurant_id = r.restaurant_id""")
def distinct_pairs(spark, sf_dir):
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type")
    joined = join_dimension(tickets(spark, sf_dir).select("restaurant_id", "driver_id"), places, "restaurant_id")
    return joined.select("cuisine_type", "driver_id").distinct()
