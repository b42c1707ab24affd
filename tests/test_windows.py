"""The sliced forms must equal Spark's own windows, whatever the slices cut through."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.operators import windows as w
from larder.operators.tuning import executed_plan

from .conftest import rows

HOT = {"limit": 20, "slices": 7}


@pytest.fixture(scope="module")
def data(spark):
    """Group 'a' holds over a third of the rows, many of equal value; nulls everywhere."""
    draw = random.Random(11)
    made = []
    for i in range(900):
        group = "a" if draw.random() < 0.4 else draw.choice(["b", "c", None] + [f"g{n}" for n in range(40)])
        value = 5 if draw.random() < 0.3 else draw.choice([None] + list(range(30)))
        made.append((group, value, i, draw.choice([None, draw.randrange(1000)])))
    return spark.createDataFrame(made, "g string, v int, id int, x bigint").repartition(5, "id").cache()


ORDERS = [["v", "id"], ["v desc", "id"], ["v desc", "id desc"]]


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", ORDERS)
def test_row_number(data, by, order):
    assert rows(w.number_rows(data, by, order, **HOT)) == rows(w.number_rows(data, by, order, limit=None))


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", ["v", "v desc"])
def test_ranks(data, by, order):
    hot = w.rank_rows(data, by, order, rank="r", dense_rank="d", limit=3, slices=6)
    assert rows(hot, *data.columns, "r", "d") == rows(w.rank_rows(data, by, order, rank="r", dense_rank="d", limit=None))


def test_rank_alone(data):
    hot = w.rank_rows(data, "g", "v", rank="r", **HOT)
    assert rows(hot, "id", "r") == rows(w.rank_rows(data, "g", "v", rank="r", limit=None), "id", "r")


@pytest.mark.parametrize("by", [["g"], []])
def test_percent_rank(data, by):
    hot = w.percent_rank(data, by, "v desc", **HOT)
    assert rows(hot) == rows(w.percent_rank(data, by, "v desc", limit=None))


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("tiles", [1, 4, 7, 2000])
def test_ntile(data, by, tiles):
    hot = w.ntile(data, by, ["v", "id"], tiles, **HOT)
    assert rows(hot) == rows(w.ntile(data, by, ["v", "id"], tiles, limit=None))


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", ORDERS)
def test_running_total_by_rows(data, by, order):
    hot = w.running_total(data, by, order, F.col("x"), "t", **HOT)
    assert rows(hot) == rows(w.running_total(data, by, order, F.col("x"), "t", limit=None))


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", [["d", "id"], ["d desc", "id desc"], ["g", "d desc", "id"]])
@pytest.mark.parametrize("kind", ["decimal(12,2)", "double", "bigint"])
def test_running_totals_of_few_days_need_one_shuffle(spark, monkeypatch, by, order, kind):
    """Large groups of few days: rows travel once and are never written, whatever is null or a copy of another row."""
    made = [("a" if i % 3 else None, i % 11 or None, i // 2, None if i % 7 == 0 or i % 11 == 1 else i % 50) for i in range(600)]
    df = spark.createDataFrame(made + made[:40], "g string, d int, id int, x bigint").withColumn("x", F.col("x").cast(kind))
    written, stash = [], w.stash
    monkeypatch.setattr(w, "stash", lambda df, name: written.append(name) or stash(df, name))
    hot = w.running_total(df, by, order, F.col("x"), "t", limit=150, slices=5)
    small = by == [] and order[0] == "g"
    assert written == (["leads"] if not small else ["leads", "numbered", "slices"])
    assert small or executed_plan(hot).count("hashpartitioning") <= 2 and "rangepartitioning" not in executed_plan(hot)
    plain = w.running_total(df, by, order, F.col("x"), "t", limit=None)
    assert hot.dtypes == plain.dtypes
    assert rows(hot) == rows(plain)


@pytest.mark.parametrize("by", [["g"], []])
def test_running_total_by_range(data, by):
    hot = w.running_total(data, by, "v desc", F.col("x"), "t", ties="range", limit=3, slices=5)
    plain = w.running_total(data, by, "v desc", F.col("x"), "t", ties="range", limit=None)
    assert rows(hot, *plain.columns) == rows(plain)


def test_running_decimal_keeps_its_type(data):
    value = F.col("x").cast("decimal(12,2)")
    hot = w.running_total(data, "g", ["v", "id"], value, "t", **HOT)
    plain = w.running_total(data, "g", ["v", "id"], value, "t", limit=None)
    assert hot.schema["t"].dataType == plain.schema["t"].dataType and rows(hot) == rows(plain)


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("limit", [4, 20])
def test_neighbours(data, by, limit):
    fetch = {"p": ("x", -1), "p3": ("x", -3), "n": ("id", 1), "n2": ("v", 2)}
    hot = w.neighbours(data, by, ["v desc", "id"], fetch, limit=limit, slices=9)
    assert rows(hot) == rows(w.neighbours(data, by, ["v desc", "id"], fetch, limit=None))


@pytest.mark.parametrize("rows_in_frame", [1, 3, 5])
def test_rolling_mean(data, rows_in_frame):
    hot = w.rolling_mean(data, "g", ["v", "id"], F.col("id"), rows_in_frame, "m", limit=6, slices=4)
    assert rows(hot) == rows(w.rolling_mean(data, "g", ["v", "id"], F.col("id"), rows_in_frame, "m", limit=None))


PLACES = {"row_number": "rn", "rank": "r", "dense_rank": "d", "through": "t", "size": "s"}


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("slices", [3, 40])
def test_all_places_at_once(data, by, order, slices):
    """Peers that run over several slices, slices inside one value, nulls, and groups of one row."""
    peers = order[:1]
    hot = w.place_rows(data, by, order, ties=peers, limit=3, slices=slices, **PLACES)
    plain = w.place_rows(data, by, order, ties=peers, limit=None, **PLACES)
    assert hot.columns == plain.columns and hot.dtypes == plain.dtypes
    assert rows(hot) == rows(plain)
    tied = Window.partitionBy(*by).orderBy(*w._order_columns(peers))
    checked = plain.withColumns({"r2": F.rank().over(tied), "d2": F.dense_rank().over(tied), "n2": F.percent_rank().over(tied)})
    assert checked.filter("r <> r2 or d <> d2").isEmpty()
    assert checked.filter(w.percent_rank_of(F.col("r"), F.col("s")) != F.col("n2")).isEmpty()
    above = Window.partitionBy(*by).orderBy("v") if peers == ["v desc"] else None
    if above is not None:  # the rank from the other end
        assert plain.withColumn("up", F.rank().over(above)).filter("up <> s - t + 1").isEmpty()


def test_a_group_of_one_value_over_all_slices(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(500)] + [("b", i // 100, i) for i in range(300)], "g string, v int, id int")
    hot = w.place_rows(df, "g", ["v", "id"], ties="v", limit=10, slices=13, **PLACES)
    assert rows(hot) == rows(w.place_rows(df, "g", ["v", "id"], ties="v", limit=None, **PLACES))
    with pytest.raises(ValueError):
        w.place_rows(df, "g", ["v", "id"], ties="id", rank="r")


def test_places_need_one_count_and_one_range_exchange(data, monkeypatch):
    counted, plans = [], []
    largest, stash = w.largest_group, w.stash
    monkeypatch.setattr(w, "largest_group", lambda df, keys: counted.append(keys) or largest(df, keys))
    monkeypatch.setattr(w, "stash", lambda df, name: plans.append(executed_plan(df)) or stash(df, name))
    w.place_rows(data, "g", ["v", "id"], ties="v", **PLACES, **HOT).count()
    assert len(counted) == 1 and sum(plan.count("rangepartitioning") for plan in plans) == 1
    small = executed_plan(w.place_rows(data, "g", ["v", "id"], ties="v", **PLACES))
    assert small.count("ENSURE_REQUIREMENTS") == 1


def test_one_count_serves_a_stack_of_windows(data, monkeypatch):
    counted, largest = [], w.largest_group
    monkeypatch.setattr(w, "largest_group", lambda df, keys: counted.append(keys) or largest(df, keys))
    for limit in (20, 1000):
        groups = w.groups_of(data, "g", limit)
        stacked = w.rank_rows(data, "g", "v", rank="r", limit=groups, slices=5)
        stacked = w.neighbours(stacked, "g", ["v", "id"], {"p": ("x", -1)}, limit=groups, slices=5)
        stacked = w.rolling_mean(stacked, "g", ["v", "id"], F.col("id"), 3, "m", limit=groups, slices=5)
        stacked = w.running_total(stacked, ["g", "v"], "id", F.col("x"), "t", limit=groups, slices=5)
        plain = w.rank_rows(data, "g", "v", rank="r", limit=None)
        plain = w.neighbours(plain, "g", ["v", "id"], {"p": ("x", -1)}, limit=None)
        plain = w.rolling_mean(plain, "g", ["v", "id"], F.col("id"), 3, "m", limit=None)
        plain = w.running_total(plain, ["g", "v"], "id", F.col("x"), "t", limit=None)
        assert rows(stacked) == rows(plain)
    assert [list(k) if not isinstance(k, str) else [k] for k in counted if k] == [["g"]] * 2
    with pytest.raises(ValueError):
        w.number_rows(data, [], "id", limit=groups)


def test_an_offset_far_beyond_the_limit(spark, monkeypatch):
    """An offset of 5,000 and a frame of 5,000 rows where a task may sort 100."""
    made = [("a" if i % 12 else "b", (i * 7919) % 12007, float(i % 97)) for i in range(12_000)]
    df = spark.createDataFrame(made, "g string, t int, x double").repartition(5)
    sorted_rows, stash = [], w.stash

    def spy(frame, name):
        kept = stash(frame, name)
        if "_slice" in kept.columns:
            sorted_rows.append(kept.groupBy("_slice").count().agg(F.max("count")).first()[0])
        return kept

    monkeypatch.setattr(w, "stash", spy)
    fetch = {"p": ("t", -5000), "n": ("t", 5000)}
    far = w.neighbours(df, "g", "t", fetch, limit=100, slices=300)
    assert "Window" not in executed_plan(far) or max(sorted_rows) <= 100
    assert max(sorted_rows) <= 100
    assert rows(far) == rows(w.neighbours(df, "g", "t", fetch, limit=None))
    mean = w.rolling_mean(df, "g", "t", F.col("x"), 5000, "m", limit=100, slices=300)
    assert rows(mean) == rows(w.rolling_mean(df, "g", "t", F.col("x"), 5000, "m", limit=None))
    assert max(sorted_rows) <= 100


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "int"])
def test_rolling_means_of_every_kind(spark, kind):
    odd = {30: float("inf"), 60: float("nan"), 90: None, 91: -float("inf")} if kind == "double" else {30: None}
    made = [(i, odd.get(i, float(i * i % 37))) for i in range(150)]
    df = spark.createDataFrame(made, "t int, x double").repartition(3)
    value = F.col("x").cast(kind)
    for size in (1, 4, 25):
        hot = w.rolling_mean(df, [], "t", value, size, "m", limit=10, slices=8)
        plain = w.rolling_mean(df, [], "t", value, size, "m", limit=None)
        assert hot.dtypes == plain.dtypes
        assert [str(r) for r in rows(hot)] == [str(r) for r in rows(plain)]


def test_rolling_mean_waits_for_enough_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 5)], "t int, x double")
    rolled = w.rolling_mean(df, [], "t", F.col("x"), 3, "m").orderBy("t")
    assert [r["m"] for r in rolled.collect()] == [None, None, 2.0, 3.0]


def test_a_frame_larger_than_a_block_widens_the_blocks(data):
    for steps in ({"p": ("x", -30)}, {"p": ("x", -45), "n": ("x", 70)}):
        wide = w.neighbours(data, "g", ["v", "id"], steps, **HOT)
        assert rows(wide) == rows(w.neighbours(data, "g", ["v", "id"], steps, limit=None))
    mean = w.rolling_mean(data, "g", ["v", "id"], F.col("x"), 50, "m", **HOT)
    assert rows(mean) == rows(w.rolling_mean(data, "g", ["v", "id"], F.col("x"), 50, "m", limit=None))


@pytest.mark.parametrize("method", ["row_number", "rank", "dense_rank"])
def test_top_n_beyond_the_group_limit_is_sliced(data, method):
    sliced = w.top_n(data, "g", ["v", "id"], 5000, method=method, limit=20)
    plain = w.top_n(data, "g", ["v", "id"], 5000, method=method, limit=None)
    assert rows(sliced, "id", "rank") == rows(plain, "id", "rank")
    # The threshold itself, on small data.
    few = w.top_n(data, "g", ["v", "id"], 25, method=method, limit=20)
    assert rows(few, "id", "rank") == rows(plain.filter("rank <= 25"), "id", "rank")


@pytest.mark.parametrize("method", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("n", [1, 3])
def test_top_n(data, method, by, n):
    order = ["v desc", "id"] if method == "row_number" else ["v desc"]
    window = Window.partitionBy(*by).orderBy(*w._order_columns(order))
    plain = data.withColumn("place", getattr(F, method)().over(window).cast("bigint")).filter(F.col("place") <= n)
    for limit in (3, None):
        top = w.top_n(data, by, order, n, "place", method, limit=limit)
        assert rows(top, *plain.columns) == rows(plain)


def test_top_n_prunes_before_the_shuffle(data):
    plan = executed_plan(w.top_n(data, "g", ["v desc", "id"], 2))
    assert plan.count("WindowGroupLimit") == 2


def test_latest_per_key(data):
    newest = w.latest_per_key(data, "g", "id desc")
    best = data.groupBy("g").agg(F.max("id").alias("id"))
    assert rows(newest, "g", "id") == rows(best, "g", "id") and newest.columns == data.columns


@pytest.mark.parametrize("by", [["g"], []])
def test_group_stats(data, by):
    over = Window.partitionBy(*by)
    plain = data.withColumn("n", F.count("*").over(over)).withColumn("top", F.max("x").over(over))
    assert rows(w.with_group_stats(data, by, {"n": F.count("*"), "top": F.max("x")})) == rows(plain)


def test_change_from_previous_starts_at_zero(spark):
    df = spark.createDataFrame([(1, 310.5), (2, 125.25), (3, 200.0)], "m int, t double")
    changed = w.change_from_previous(df, [], "m", "t", "c").orderBy("m")
    assert [r["c"] for r in changed.collect()] == [0.0, -185.25, 74.75]


def test_empty_frames(data):
    empty = data.limit(0)
    assert w.number_rows(empty, "g", ["v", "id"], limit=-1, slices=3).count() == 0
    assert w.ntile(empty, "g", ["v", "id"], 4).count() == 0


def test_slices_carry_at_most_one_row_each(data, monkeypatch):
    """The copied table of earlier sums is bounded by the number of slices."""
    copied = []
    original = w.equi_join

    def spy(left, right, *args, **kwargs):
        copied.append(right.count())
        return original(left, right, *args, **kwargs)

    monkeypatch.setattr(w, "equi_join", spy)
    w.number_rows(data, "g", ["v", "id"], **HOT).count()
    assert copied and copied[0] <= 7


def test_each_slice_has_a_task_of_its_own(data, monkeypatch):
    plans = []
    original = w.stash
    monkeypatch.setattr(w, "stash", lambda df, name: plans.append(executed_plan(df)) or original(df, name))
    w.number_rows(data, "g", ["v", "id"], **HOT).count()
    assert plans[-1].count("Exchange") == 2 and "shufflepartitionidpassthrough" in plans[-1]


def test_copies_of_one_row_are_spread(spark, monkeypatch):
    """A third of all rows are the same row; no slice may hold them all."""
    df = spark.createDataFrame([("a", i) for i in range(600)] + [("a", 7)] * 300, "g string, v int").repartition(4)
    stashed = {}
    original = w.stash
    monkeypatch.setattr(w, "stash", lambda df, name: stashed.setdefault(name, original(df, name)))
    numbered = w.number_rows(df, "g", "v", limit=50, slices=9)
    assert sorted(r["row_number"] for r in numbered.collect()) == list(range(1, 901))
    assert rows(numbered, "g", "v") == rows(df)
    slices = [r["count"] for r in stashed["slices"].groupBy("_slice").count().collect()]
    assert len(slices) == 9 and max(slices) < 200
