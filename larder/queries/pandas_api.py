"""pandas-on-Spark."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..fixed_values import PRICE_STEPS, RATING_REST
from ..functions.columns import log_score, money_sum
from ..operators.windows import groups_of, neighbours, rank_rows
from ..pandas_api import (
    assemble_features, cached, from_local, gather, join_local, merge, natively, read_json_lines, spread, to_local,
    to_native, to_pandas_api,
)
from ..session import scratch_path, stash
from ..sources.readers import read_source
from ..sources.writers import write_sink
from .registry import PRICE_LABEL, RESTAURANTS, TICKETS, query, restaurants, sql_money, tickets


@query("ps_filter_assign", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, average_rating, monthly_orders, average_rating / 5 AS rating_unit, average_rating >= 975 AS is_top,
       city || ', ' || name AS place, UPPER(name) AS upper_name, CAST(LENGTH(name) AS INTEGER) AS name_len,
       ROUND(SQRT(monthly_orders) * average_rating / 5, 4) AS score
FROM restaurants WHERE average_rating > 940""")
def ps_filter_assign(spark, sf_dir):
    """Mask, column list, assignment, assign, string methods and a NumPy function."""
    frame = to_pandas_api(restaurants(spark, sf_dir))
    frame = frame[frame["average_rating"] > 940]
    frame = frame[["restaurant_id", "name", "city", "average_rating", "monthly_orders"]]
    frame = frame.assign(
        rating_unit=frame["average_rating"] / 5,
        is_top=frame["average_rating"] >= 975,
        place=frame["city"] + ", " + frame["name"],
        upper_name=frame["name"].str.upper(),
        name_len=frame["name"].str.len(),
    )
    frame["score"] = (np.sqrt(frame["monthly_orders"]) * frame["average_rating"] / 5).round(4)
    return to_native(frame).drop("name", "city").withColumn("name_len", F.col("name_len").cast("int"))


@query("ps_groupby_agg", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, ROUND(AVG(average_rating), 4) AS avg_rating, CAST(SUM(monthly_orders) AS BIGINT) AS total_orders,
       MAX(average_rating) AS best, COUNT(name) AS restaurant_count FROM restaurants GROUP BY cuisine_type""")
def ps_groupby_agg(spark, sf_dir):
    frame = to_pandas_api(restaurants(spark, sf_dir))
    grouped = frame.groupby("cuisine_type").agg(
        {"average_rating": ["mean", "max"], "monthly_orders": "sum", "name": "count"}
    )
    summary = grouped.reset_index()
    summary.columns = ["cuisine_type", "avg_rating", "best", "total_orders", "restaurant_count"]
    summary = summary.sort_values(["avg_rating", "cuisine_type"], ascending=[False, True])
    return to_native(summary).withColumn("avg_rating", F.round("avg_rating", 4))


@query("ps_group_sizes", f"""
WITH {RESTAURANTS} SELECT city, COUNT(*) AS size, MAX(monthly_orders) AS largest FROM restaurants GROUP BY city""")
def ps_group_sizes(spark, sf_dir):
    groups = to_pandas_api(restaurants(spark, sf_dir)).groupby("city")
    sizes, largest = groups.size().reset_index(name="size"), groups["monthly_orders"].max().reset_index(name="largest")
    return to_native(merge(sizes, largest, "city"))


@query("ps_merge_rank_shift", f"""
WITH {RESTAURANTS}, {TICKETS}, per AS (
  SELECT restaurant_id, name, cuisine_type, monthly_orders, COUNT(*) AS orders
  FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY ALL)
SELECT restaurant_id, name, cuisine_type, monthly_orders, orders,
       RANK() OVER (PARTITION BY cuisine_type ORDER BY orders DESC) AS orders_rank,
       LAG(orders) OVER (PARTITION BY cuisine_type ORDER BY orders DESC, restaurant_id) AS shifted FROM per""")
def ps_merge_rank_shift(spark, sf_dir):
    """Merge, rank and shift as native steps: the pandas forms sort whole groups in one task."""
    places = to_pandas_api(restaurants(spark, sf_dir))[["restaurant_id", "name", "cuisine_type", "monthly_orders"]]
    counts = to_pandas_api(tickets(spark, sf_dir)).groupby("restaurant_id").size().reset_index(name="orders")

    def ranked_and_shifted(df):
        groups, order = groups_of(df, "cuisine_type"), ["orders desc", "restaurant_id"]
        ranked = rank_rows(df, "cuisine_type", "orders desc", rank="orders_rank", limit=groups)
        return neighbours(ranked, "cuisine_type", order, {"shifted": ("orders", -1)}, limit=groups)

    return to_native(natively(merge(counts, places, "restaurant_id"), stash, ranked_and_shifted))


@query("ps_apply", f"""
WITH {RESTAURANTS} SELECT restaurant_id, {PRICE_LABEL} AS category FROM restaurants""")
def ps_apply(spark, sf_dir):
    """A Python function per value; the return hint spares a run that would infer it."""
    steps, rest = PRICE_STEPS, RATING_REST

    def label(rating) -> str:
        return next((name for bound, name in steps if rating >= bound), rest)

    frame = to_pandas_api(restaurants(spark, sf_dir))
    frame["category"] = frame["average_rating"].apply(label)
    return to_native(frame[["restaurant_id", "category"]])


@query("ps_inspect", f"""
WITH {RESTAURANTS}
SELECT COUNT(*) AS rows, CAST(6 AS BIGINT) AS columns, CAST(3 AS BIGINT) AS head_rows,
       'restaurant_id,name,cuisine_type,city,average_rating,monthly_orders' AS names,
       'int64,object,object,object,float64,int64' AS types, MAX(average_rating) AS best FROM restaurants""")
def ps_inspect(spark, sf_dir):
    """shape, columns, dtypes, head and describe."""
    frame = to_pandas_api(restaurants(spark, sf_dir))
    rows, columns = frame.shape
    facts = {
        "rows": len(frame),
        "columns": columns,
        "head_rows": len(to_local(frame.head(3), 3)),
        "names": ",".join(frame.columns),
        "types": ",".join(str(kind) for kind in frame.dtypes),
        "best": float(frame["average_rating"].describe()["max"]),
    }
    assert rows == facts["rows"]
    return spark.createDataFrame(
        [tuple(facts.values())], "rows bigint, columns bigint, head_rows bigint, names string, types string, best double"
    )


@query("ps_roundtrip", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT city, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY city""")
def ps_roundtrip(spark, sf_dir):
    """A pandas-style column choice, a native join and grouping, then back; the report is cached and gathered."""
    places = to_pandas_api(restaurants(spark, sf_dir))[["restaurant_id", "city"]]
    lines = to_pandas_api(tickets(spark, sf_dir))
    joined = merge(lines, places, "restaurant_id")
    grouped = natively(
        joined,
        lambda df: df.groupBy("city").agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue")),
    )
    with cached(spread(grouped, 4)) as held:
        return stash(to_native(gather(held, 2)))


@query("ps_fused_export", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, ROUND(AVG(average_rating), 4) AS avg_rating, ROUND(AVG(average_rating * SQRT(monthly_orders / 100.0)), 3)
       AS avg_popularity, COUNT(*) AS restaurant_count FROM restaurants GROUP BY cuisine_type""")
def ps_fused_export(spark, sf_dir):
    """Score, group, sort, deliver as CSV."""
    frame = to_pandas_api(restaurants(spark, sf_dir))
    frame["popularity_score"] = frame["average_rating"] * np.sqrt(frame["monthly_orders"] / 100)
    summary = (
        frame.groupby("cuisine_type")
        .agg({"average_rating": "mean", "popularity_score": "mean", "name": "count"})
        .reset_index()
    )
    summary.columns = ["cuisine_type", "avg_rating", "avg_popularity", "restaurant_count"]
    summary = summary.sort_values("avg_popularity", ascending=False)
    path = write_sink(to_native(summary), "csv", f"{scratch_path(spark, 'export')}/summary")
    schema = "cuisine_type string, avg_rating double, avg_popularity double, restaurant_count bigint"
    delivered = read_source(spark, "csv", path, schema=schema)
    return delivered.withColumns(
        {"avg_rating": F.round("avg_rating", 4), "avg_popularity": F.round("avg_popularity", 3)}
    )


@query("ps_json", f"""
WITH {RESTAURANTS} SELECT restaurant_id, name, average_rating FROM restaurants""")
def ps_json(spark, sf_dir):
    places = restaurants(spark, sf_dir)
    path = write_sink(places, "json", f"{scratch_path(spark, 'lines')}/restaurants")
    frame = read_json_lines(spark, path, places.schema)
    return to_native(frame[["restaurant_id", "name", "average_rating"]])


@query("ps_local_dimension", f"""
WITH {RESTAURANTS}, {TICKETS}, zones(city, zone) AS (
  VALUES ('ECONOMY', 'south'), ('LARGE', 'north'), ('MEDIUM', 'north'), ('PROMO', 'south'),
         ('SMALL', 'north'), ('STANDARD', 'south'))
SELECT zone, COUNT(*) AS orders FROM tickets JOIN restaurants USING (restaurant_id) JOIN zones USING (city) GROUP BY zone""")
def ps_local_dimension(spark, sf_dir):
    """A small local table joined to the fact on the cluster."""
    cities = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    zones = pd.DataFrame({"city": cities, "zone": ["south", "north", "north", "south", "north", "south"]})
    placed = join_local(restaurants(spark, sf_dir).select("restaurant_id", "city"), zones, "city")
    lines = to_pandas_api(tickets(spark, sf_dir))[["restaurant_id", "order_id"]]
    joined = merge(lines, to_pandas_api(placed), "restaurant_id")
    return to_native(joined.groupby("zone").size().reset_index(name="orders"))


@query("ps_from_local", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, average_rating FROM restaurants ORDER BY average_rating DESC, restaurant_id LIMIT 5""")
def ps_from_local(spark, sf_dir):
    """A bounded top-k taken to local pandas and brought back."""
    best = restaurants(spark, sf_dir).orderBy(F.col("average_rating").desc(), "restaurant_id")
    local = to_local(to_pandas_api(best.select("restaurant_id", "average_rating").limit(5)), 5)
    return to_native(from_local(spark, local))


@query("feature_vector", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, average_rating AS first_feature, CAST(monthly_orders AS DOUBLE) AS second_feature,
       ROUND(average_rating * average_rating * LN(1 + monthly_orders) / 10, 3) AS third_feature FROM restaurants""")
def feature_vector(spark, sf_dir):
    places = restaurants(spark, sf_dir).withColumn("score", log_score(F.col("average_rating"), F.col("monthly_orders")))
    vectors = assemble_features(places, ["average_rating", "monthly_orders", "score"])
    values = vectors.withColumn("values", vector_to_array("features"))
    return values.select(
        "restaurant_id",
        F.col("values")[0].alias("first_feature"),
        F.col("values")[1].alias("second_feature"),
        F.round(F.col("values")[2], 3).alias("third_feature"),
    )
