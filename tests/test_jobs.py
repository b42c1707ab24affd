"""Complete jobs on the seed."""

import pytest
from pyspark.sql import functions as F

from larder.errors import QualityError, SchemaError
from larder.plans import jobs, sql_modules
from larder.sources.readers import read_source

from .conftest import rows

METRICS = [("grill", "Quito", 20.21, 3, 6.74), ("grill", "Turin", 55.55, 1, 55.55), ("vegan", "Turin", 1019.99, 3, 340.0)]


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(1, "a@x", "+1 (2)-3 "), (2, "b@x", "()"), (3, "c@x", None)],
        "user_id bigint, email string, phone_number string",
    )


@pytest.mark.parametrize("small", [True, False])
def test_order_metrics(restaurants, orders, small, monkeypatch):
    monkeypatch.setattr(jobs, "fits_broadcast", lambda df: small)
    metrics = jobs.order_metrics(orders, restaurants)
    assert rows(metrics) == METRICS
    best = metrics.first()
    assert (best["cuisine_type"], best["total_revenue"]) == ("vegan", 1019.99)


def test_end_to_end(users, restaurants, orders, folder):
    paths = jobs.end_to_end_job(users, restaurants, orders, folder)
    read = {name: read_source(users.sparkSession, "parquet", path) for name, path in paths.items()}
    assert rows(read["users"], "phone_number") == [("",), ("1 23 ",), (None,)]
    assert rows(read["order_metrics"]) == [(c.upper(), *rest) for c, *rest in METRICS]
    labels = dict(rows(read["restaurants"], "restaurant_id", "rating_category"))
    assert [labels[i] for i in range(10, 16)] == ["Excellent", "Good", "Average", "Good", "Excellent", "Average"]


def test_end_to_end_stops_at_the_gate(users, restaurants, orders, folder):
    with pytest.raises(SchemaError, match="users: required_column email"):
        jobs.end_to_end_job(users.drop("email"), restaurants, orders, folder)
    with pytest.raises(QualityError, match="users: no_nulls user_id"):
        jobs.end_to_end_job(users.withColumn("user_id", F.lit(None).cast("int")), restaurants, orders, folder)
    with pytest.raises(QualityError, match="restaurants: min_rows"):
        jobs.end_to_end_job(users, restaurants.limit(0), orders, folder)


def test_run_job_counts_its_source(restaurants):
    result, seen = jobs.run_job(restaurants, [lambda df: df.filter("city = 'Turin'"), jobs.rate])
    assert result.count() == 3 and seen.get["rows"] == 6


def test_rating_job(restaurants):
    counted = jobs.rating_job(restaurants).groupBy("rating_category").count()
    assert rows(counted) == [("Average", 2), ("Excellent", 2), ("Good", 2)]


def test_kpi_job_can_run_again(spark, restaurants, folder):
    for _ in range(2):
        path = jobs.kpi_job(restaurants, f"{folder}/kpi")
    assert read_source(spark, "parquet", path).count() == 3


def test_guarded_job(spark, restaurants, folder):
    dirty = restaurants.select(
        "restaurant_id", "name", F.when(F.col("restaurant_id") != 15, F.col("cuisine_type")).alias("cuisine_type"),
        "average_rating", F.when(F.col("restaurant_id") != 12, F.lit("(0)-")).alias("phone"),
    )
    kpi = read_source(spark, "parquet", jobs.guarded_job(dirty, f"{folder}/kpi"))
    assert ("Unknown", 1, 3.99, 3.99) in rows(kpi)
    with pytest.raises(SchemaError, match="phone"):
        jobs.guarded_job(dirty.drop("phone"), f"{folder}/kpi")
    with pytest.raises(QualityError, match="min_rows"):
        jobs.guarded_job(dirty, f"{folder}/kpi", least=100)


def test_medallion_by_path(restaurants, folder):
    gold = jobs.medallion_by_path(restaurants, folder)
    assert [r["cuisine_type"] for r in gold.collect()] == ["vegan", "bakery", "grill"]


def test_medallion_by_table(restaurants, folder):
    steps = [(4.5, "top"), (4.0, "good")]
    gold = jobs.medallion_by_table(restaurants, "larder_test", folder, 4.0, 4.75, steps, "rest")
    assert dict(rows(gold, "restaurant_id", "validated_rating"))[14] == 4.75
    assert rows(gold.groupBy("category").count()) == [("good", 4), ("top", 2)]


def test_score_against_group(restaurants):
    compared = {r["name"]: r for r in jobs.score_against_group(restaurants).collect()}
    assert compared["fifteen"]["diff_from_avg"] == 0.0  # alone in its group
    assert (compared["fourteen"]["popularity_score"], compared["thirteen"]["popularity_score"]) == (49.75, 0.0)


def test_sql_modules(restaurants, orders):
    out = sql_modules.run_modules(restaurants, orders)
    assert rows(out["label_shares"]) == [("Average", 2, 33.3), ("Excellent", 2, 33.3), ("Good", 2, 33.3)]
    assert [tuple(r) for r in out["monthly_trend"].collect()] == [
        (2021, 12, 2, 65.65, 32.83, 65.65, 0.0), (2022, 1, 3, 1010.1, 336.7, 1075.75, 944.45),
        (2022, 2, 2, 20.0, 10.0, 1095.75, -990.1),
    ]
    assert [tuple(r) for r in out["weekday_pattern"].collect()] == [
        (1, "Sun", 1, 999.99), (2, "Mon", 2, 20.0), (6, "Fri", 2, 65.65), (7, "Sat", 2, 10.11),
    ]
    report = [(r["cuisine_type"], r["city"], r["total_revenue"], r["revenue_rank"]) for r in out["revenue_report"].collect()]
    assert report[0] == ("VEGAN", "Turin", 1019.99, 1) and report[-1] == ("BAKERY", "Oulu", None, 4)
    assert [r[3] for r in report] == [1, 2, 3, 4]
    totals = {r["cuisine_type"]: r for r in out["cuisine_totals"].collect()}
    assert totals["** GRAND TOTAL **"]["total_revenue"] == 1095.75 and totals["VEGAN"]["avg_rating"] == 4.5
    assert out["cuisine_totals"].collect()[-1]["cuisine_type"] == "** GRAND TOTAL **"
    leaders = rows(out["best_per_cuisine"], "name", "rank_in_cuisine")
    assert ("fourteen", 1) in leaders and ("eleven", 2) in leaders and len(leaders) == 5


def test_restaurants_without_orders_count_zero(restaurants, orders):
    counted = jobs.orders_per_restaurant(restaurants, orders)
    assert rows(counted.filter("order_count = 0"), "restaurant_id", "revenue") == [(11, None), (15, None)]
