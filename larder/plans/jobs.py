"""Batch jobs: extract, validate, transform, load.

Every job reads its inputs once per output, checks all rules on an input in a single
aggregate, and replaces its outputs in one step, so it can simply be run again and a run that fails
half-way leaves the results of the last one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CUISINE_DEFAULT, FILL_DEFAULTS, RATING_REST, RATING_STEPS
from ..functions.columns import (
    clamp, clean_phone, ladder, money_avg, money_total, normalized, root_score,
)
from ..operators.aggregates import kpi_by, summarise
from ..operators.joins import equi_join, fits_broadcast
from ..operators.quality import counting, enforce, min_rows, no_nulls, required_columns, split_null_keys
from ..operators.windows import with_group_stats
from ..sources.catalog import create_database, create_table
from ..sources.publish import publish, publish_frames
from ..sources.readers import read_source
from ..sources.writers import deliver_formats, write_sink

# --- steps shared by the jobs ----------------------------------------------------


def rate(df: DataFrame, steps=RATING_STEPS, rest: str = RATING_REST) -> DataFrame:
    return df.withColumn("rating_category", ladder(F.col("average_rating"), steps, rest))


def normalise_cuisine(df: DataFrame) -> DataFrame:
    return df.withColumn("cuisine_type", normalized(F.col("cuisine_type"), CUISINE_DEFAULT))


def order_metrics(orders: DataFrame, restaurants: DataFrame, by=("cuisine_type", "city")) -> DataFrame:
    """Revenue, orders and mean order value per group of restaurants, best first.

    With a small restaurant table the orders are joined where they lie. With a large one
    they are first added up per restaurant, so a restaurant with a third of all orders
    travels as one row per task.
    """
    slim = restaurants.select("restaurant_id", *by)
    if fits_broadcast(slim):
        joined = orders.select("restaurant_id", "amount").join(F.broadcast(slim), "restaurant_id")
        revenue, rows = money_total(F.col("amount")), F.count("*")
    else:
        reduced = orders.groupBy("restaurant_id").agg(
            money_total(F.col("amount")).alias("revenue"), F.count("*").alias("rows")
        )
        joined = equi_join(reduced, slim, "restaurant_id")
        revenue, rows = F.sum("revenue"), F.sum("rows")
    return (
        joined.groupBy(*by)
        .agg(revenue.cast("double").alias("total_revenue"), rows.alias("total_orders"))
        .withColumn("avg_order_value", F.round(F.col("total_revenue") / F.col("total_orders"), 2))
        .orderBy(F.col("total_revenue").desc(), *by)
    )


def orders_per_restaurant(restaurants: DataFrame, orders: DataFrame) -> DataFrame:
    """Every restaurant with its order count and revenue; none gives 0 and null."""
    reduced = orders.groupBy("restaurant_id").agg(
        F.count("order_id").alias("order_count"), money_total(F.col("amount")).alias("revenue")
    )
    joined = equi_join(restaurants, reduced, "restaurant_id", "left")
    return joined.withColumn("order_count", F.coalesce("order_count", F.lit(0)))


# --- jobs ------------------------------------------------------------------------


def run_job(source: DataFrame, steps, sink=None, name: str = "job"):
    """Chain steps over a source and optionally write the result.

    Returns the result and the observation that holds the row count of the source once an
    action has run; counting costs no job of its own.
    """
    observed, rows = counting(source, f"{name} source")
    result = reduce(DataFrame.transform, steps, observed)
    if sink is not None:
        sink(result)
    return result, rows


def rating_job(restaurants: DataFrame, steps=RATING_STEPS) -> DataFrame:
    result, _ = run_job(restaurants, [lambda df: rate(df, steps)], name="rating")
    return result


def kpi_job(restaurants: DataFrame, location: str) -> str:
    """KPI per cuisine, published as Parquet; returns the folder of the new rows."""
    folders = []
    run_job(
        restaurants,
        [lambda df: kpi_by(df, "cuisine_type", F.col("average_rating"))],
        lambda df: folders.append(publish(df, location)),
        "kpi",
    )
    return folders[0]


def end_to_end_job(users: DataFrame, restaurants: DataFrame, orders: DataFrame, base: str,
                   steps=RATING_STEPS) -> dict[str, str]:
    """Three inputs: validate, clean and label, measure, publish one output each, all three at once."""
    enforce(users, required_columns(users, "user_id", "email", "phone_number") + no_nulls("user_id", "email"), "users")
    enforce(restaurants, required_columns(restaurants, "restaurant_id", "cuisine_type") + min_rows(1), "restaurants")
    enforce(orders, required_columns(orders, "order_id", "restaurant_id", "amount"), "orders")
    clean_users = users.withColumn("phone_number", clean_phone(F.col("phone_number")))
    clean_restaurants = rate(normalise_cuisine(restaurants), steps)
    return publish_frames(
        {
            "users": clean_users,
            "restaurants": clean_restaurants,
            "order_metrics": order_metrics(orders, clean_restaurants),
        },
        base,
    )


def guarded_job(restaurants: DataFrame, location: str, *, steps=RATING_STEPS, least: int = 5) -> str:
    """Validated read, cleaning, KPI per cuisine, a save that can be repeated; returns the folder of the new rows."""
    needed = ("restaurant_id", "name", "cuisine_type", "average_rating", "phone")
    rules = required_columns(restaurants, *needed) + min_rows(least) + no_nulls("restaurant_id")
    enforce(restaurants, rules, "restaurants")
    cleaned = rate(
        restaurants.withColumn("phone", clean_phone(F.col("phone"), keep_spaces=False)).fillna(FILL_DEFAULTS), steps
    )
    return publish(kpi_by(cleaned, "cuisine_type", F.col("average_rating")), location)


def medallion_by_path(restaurants: DataFrame, base: str, steps=RATING_STEPS) -> DataFrame:
    """bronze as received (three formats), silver labelled and partitioned, gold KPIs."""
    spark = restaurants.sparkSession
    bronze = write_sink(restaurants, "parquet", f"{base}/bronze/parquet")
    received = read_source(spark, "parquet", bronze, schema=restaurants.schema)
    for kind in ("json", "orc"):  # from the stored rows: the source is read once, nothing is cached
        write_sink(received, kind, f"{base}/bronze/{kind}")
    silver = write_sink(rate(received, steps), "parquet", f"{base}/silver", partition_by=["cuisine_type"])
    labelled = read_source(spark, "parquet", silver).select(*received.columns, "rating_category")
    gold = write_sink(
        kpi_by(labelled, "cuisine_type", F.col("average_rating")), "parquet", f"{base}/gold",
        partition_by=["cuisine_type"],
    )
    # A partitioned write keeps no row order: sort when reading.
    columns = ["cuisine_type", "total", "avg_rating", "best_rating"]
    kpis = read_source(spark, "parquet", gold).select(*columns)
    return kpis.orderBy(F.col("avg_rating").desc(), "cuisine_type")


def medallion_by_table(restaurants: DataFrame, prefix: str, base: str, low: float, high: float, steps,
                       rest: str) -> DataFrame:
    """The same layers as databases and tables, with a clamped rating and a popularity score."""
    spark = restaurants.sparkSession
    bronze, silver, gold = (
        create_database(spark, f"{prefix}_{layer}", f"{base}/{layer}") for layer in ("bronze", "silver", "gold")
    )
    raw = spark.table(create_table(restaurants, bronze, "restaurants"))
    checked = raw.withColumn("validated_rating", clamp(F.col("average_rating"), low, high))
    checked = spark.table(create_table(checked, silver, "restaurants"))
    kpis = checked.select(
        "restaurant_id",
        "name",
        "cuisine_type",
        "city",
        "validated_rating",
        F.round(root_score(F.col("validated_rating"), F.col("monthly_orders"), 1000), 4).alias("popularity_score"),
        ladder(F.col("validated_rating"), steps, rest).alias("category"),
    )
    return spark.table(create_table(kpis, gold, "restaurant_kpis"))


def sql_cleaning_job(raw: DataFrame, location: str, schema) -> DataFrame:
    """JSON in, SQL cleaning and grouping, Parquet out."""
    spark = raw.sparkSession
    received = read_source(spark, "json", write_sink(raw, "json", f"{location}/raw"), schema=schema)
    keyed, _ = split_null_keys(received, ["restaurant_id"])
    clean = spark.sql(
        r"""SELECT restaurant_id, name,
                   COALESCE(cuisine_type, 'Unknown') AS cuisine_type,
                   COALESCE(average_rating, 0D) AS average_rating,
                   REGEXP_REPLACE(phone, r'[()\s-]', '') AS phone
            FROM {keyed}""",
        keyed=keyed,
    )
    report = spark.sql(
        """SELECT cuisine_type, COUNT(*) AS total, ROUND(AVG(CAST(average_rating AS DECIMAL(12,2))), 2) AS mean,
                  MAX(average_rating) AS best_rating, COUNT(DISTINCT phone) AS phones
           FROM {clean} GROUP BY cuisine_type""",
        clean=clean,
    ).selectExpr("cuisine_type", "total", "CAST(mean AS DOUBLE) AS avg_rating", "best_rating", "phones")
    return read_source(spark, "parquet", write_sink(report, "parquet", f"{location}/report"))


def analytics_delivery(restaurants: DataFrame, base: str) -> dict[str, str]:
    """Score every restaurant, summarise per cuisine, deliver both to their readers."""
    score = root_score(F.col("average_rating"), F.col("monthly_orders"), 100)
    scored = restaurants.withColumn("popularity_score", score)
    summary = summarise(
        scored,
        "cuisine_type",
        avg_rating=money_avg(F.col("average_rating")),
        total_reviews=F.sum("monthly_orders"),
        avg_popularity=F.round(F.avg("popularity_score"), 4),
        restaurant_count=F.count("name"),
    ).orderBy(F.col("avg_popularity").desc(), "cuisine_type")
    return {
        "detail": write_sink(
            scored, "parquet", f"{base}/detail", partition_by=["city", "cuisine_type"], compression="gzip"
        ),
        "zstd": write_sink(scored, "parquet", f"{base}/zstd", compression="zstd"),
        **deliver_formats(summary, f"{base}/summary", ("csv", "json", "parquet")),
    }


def score_against_group(restaurants: DataFrame) -> DataFrame:
    """Metrics, then the group's mean of them, then the difference."""
    score = F.round(root_score(F.col("average_rating"), F.col("monthly_orders"), 100), 2)
    scored = restaurants.select("restaurant_id", "name", "cuisine_type", score.alias("popularity_score"))
    compared = with_group_stats(scored, "cuisine_type", {"cuisine_avg": money_avg(F.col("popularity_score"))})
    difference = F.round(F.col("popularity_score") - F.col("cuisine_avg"), 2)
    return compared.withColumn("diff_from_avg", difference)
