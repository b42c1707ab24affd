import random

import pytest
from pyspark.sql import functions as F

from larder.functions.columns import money_avg, steady_avg
from larder.operators import aggregates as a

from .conftest import rows


def test_kpi_on_the_seed(restaurants):
    kpi = [tuple(r) for r in a.kpi_by(restaurants, "cuisine_type", F.col("average_rating")).collect()]
    assert kpi == [("vegan", 2, 4.5, 5.0), ("bakery", 1, 3.99, 3.99), ("grill", 3, 3.33, 4.5)]


@pytest.mark.parametrize("kind,sets,expected", [
    ("rollup", None, 8), ("cube", None, 11), ("sets", [["cuisine_type", "city"], ["cuisine_type"], []], 8),
])
def test_subtotal_row_counts(restaurants, kind, sets, expected):
    out = a.subtotals(restaurants, ["cuisine_type", "city"], {"n": F.count("*")}, kind=kind, sets=sets)
    assert out.count() == expected


def test_rollup_is_the_union_of_its_groupings(restaurants):
    rolled = a.subtotals(
        restaurants, ["cuisine_type", "city"], {"n": F.count("*")}, labels={"cuisine_type": "all", "city": "all"}
    )
    detail = restaurants.groupBy("cuisine_type", "city").agg(F.count("*").alias("n"))
    cuisine = restaurants.groupBy("cuisine_type", F.lit("all").alias("city")).agg(F.count("*").alias("n"))
    total = restaurants.agg(F.count("*").alias("n")).select(F.lit("all"), F.lit("all"), "n")
    assert rows(rolled) == rows(detail.union(cuisine).union(total))


def test_real_null_keys_are_not_labelled(spark):
    df = spark.createDataFrame([("x",), (None,)], "k string")
    out = a.subtotals(df, "k", {"n": F.count("*")}, labels={"k": "all"}, flags={"k": "is_total"})
    assert rows(out) == [("all", 2, 1), ("x", 1, 0), (None, 1, 0)]


def test_pivot(restaurants):
    out = a.pivot_mean(restaurants, "city", "cuisine_type", F.col("average_rating"), ["grill", "vegan"])
    assert rows(out) == [("Oulu", None, None), ("Quito", 4.5, None), ("Turin", 1.0, 4.5)]


def test_share_of_total(restaurants):
    labelled = restaurants.selectExpr(
        "CASE WHEN average_rating >= 4.5 THEN 'Excellent' WHEN average_rating >= 4 THEN 'Good' ELSE 'Average' END label"
    )
    assert rows(a.share_of_total(labelled, "label")) == [
        ("Average", 2, 33.3), ("Excellent", 2, 33.3), ("Good", 2, 33.3),
    ]


def test_members_come_in_ordered_chunks(spark):
    names = [("a", f"n{i:03d}", i) for i in range(25)] + [("b", "z", 1), ("b", "z", 2)]
    df = spark.createDataFrame(names, "g string, name string, id int").repartition(4)
    out = {(r["g"], r["chunk"]): r["members"] for r in a.members(df, "g", "name", "id", chunk=10).collect()}
    assert sorted(out) == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert out["a", 0] + out["a", 1] + out["a", 2] == [f"n{i:03d}" for i in range(25)] and out["b", 0] == ["z", "z"]


@pytest.fixture(scope="module")
def measured(spark):
    draw = random.Random(3)
    made = [("a" if draw.random() < 0.5 else draw.choice("bcd"), draw.choice([None, 7.0, draw.uniform(0, 50)])) for _ in range(600)]
    return spark.createDataFrame(made + [("one", 4.0), ("none", None)], "g string, v double").cache()


@pytest.mark.parametrize("by", [["g"], []])
def test_percentiles_over_slices(measured, by):
    points = {"q0": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "q9": 0.937, "max": 1.0}
    hot = a.exact_percentiles(measured, by, "v", points, limit=10, slices=5)
    plain = a.exact_percentiles(measured, by, "v", points, limit=None)
    for one, two in zip(rows(hot), rows(plain), strict=True):
        assert [round(x, 9) if isinstance(x, float) else x for x in one] == [
            round(x, 9) if isinstance(x, float) else x for x in two
        ]


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert {r["statistic"]: round(r["value"], 6) for r in a.describe(df, "x").collect()} == {
        "count": 3.0, "mean": 2.333333, "std": 1.527525, "min": 1.0, "25%": 1.5, "50%": 2.0, "75%": 3.0, "max": 4.0,
    }


def test_summarise_names_every_column(restaurants):
    out = a.summarise(restaurants, "city", mean=money_avg(F.col("average_rating")), n=F.count("*"))
    assert out.columns == ["city", "mean", "n"]
    assert rows(out) == [("Oulu", 3.99, 1), ("Quito", 4.5, 2), ("Turin", 3.33, 3)]


def test_money_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(money_avg(F.col("x")).alias("m")).first()["m"] is None


def test_means_of_more_than_two_decimals(spark):
    df = spark.createDataFrame([("a", 0.004), ("a", 0.004), ("a", 0.014), ("b", float("nan")), ("c", None)], "g string, r double")
    out = {r["g"]: r["avg_rating"] for r in a.kpi_by(df, "g", F.col("r")).collect()}
    assert out["a"] == 0.01 and out["b"] != out["b"] and out["c"] is None


def test_steady_mean_of_values_beyond_the_decimal(spark):
    """Infinities and NaN act as in a plain mean, and a value too large for the decimal ends no job."""
    inf, nan = float("inf"), float("nan")
    given = {
        "finite": [1.25, 2.5, None], "up": [inf, 1.0], "down": [-inf, 1.0, None], "both": [inf, -inf], "nan": [nan, inf],
        "huge": [1e19, 3e19], "edge": [9.9e17, -9.9e17, 3.0], "none": [None], "huge and up": [1e300, inf],
    }
    df = spark.createDataFrame([(k, v) for k, values in given.items() for v in values], "k string, v double").repartition(3)
    found = {r["k"]: r["m"] for r in df.groupBy("k").agg(steady_avg(F.col("v"), 3).alias("m")).collect()}
    plain = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.round(F.avg("v"), 3).alias("m")).collect()}
    # Where large values cancel, the decimal is right and the plain mean is not.
    assert found.pop("edge") == 1.0 and plain.pop("edge") == 0.0
    assert {k: str(v) for k, v in found.items()} == {k: str(v) for k, v in plain.items()}
    assert found["up"] == inf and found["finite"] == 1.875 and found["huge"] == 2e19
