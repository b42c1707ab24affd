import random

import pytest
from pyspark.sql import functions as F

from larder.operators import joins as j
from larder.operators.tuning import executed_plan

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on key 1, exact copies among them, and some null keys."""
    draw = random.Random(7)
    facts = [(1 if draw.random() < 0.4 else draw.randrange(2, 60), i, draw.randrange(100)) for i in range(3000)]
    facts += [(1, -1, 5)] * 300 + [(None, i, 1) for i in range(5000, 5020)]
    return spark.createDataFrame(facts, "k int, id int, v int").repartition(6, "id").cache()


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in range(0, 50)] + [(None, "nobody")], "k int, label string").cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_the_plain_one(skewed, dims, how, null_safe):
    plain = j.equi_join(skewed, dims, "k", how, null_safe)
    salted = j.salted_join(skewed, dims, "k", how, salts=7, share=0.05, null_safe=null_safe)
    assert rows(salted) == rows(plain.select(*salted.columns))


def test_salted_join_on_other_names_and_several_dimension_rows(skewed, dims):
    twice = dims.unionAll(dims).withColumnRenamed("k", "key")
    plain = skewed.join(twice, skewed["k"] == twice["key"])
    assert rows(j.salted_join(skewed, twice, ("k", "key"), share=0.05)) == rows(plain)


def test_every_key_salted(skewed, dims):
    salted = j.salted_join_all(skewed, dims, "k", salts=4, spread_by=["id", "v"])
    assert rows(salted) == rows(skewed.join(dims, "k"))


def test_copies_of_the_dimension_are_never_broadcast(spark):
    """The estimate of a small side does not count its copies, which the driver would hold."""
    fact = spark.range(4000).selectExpr("id", "id % 50 as k")
    dim = spark.range(50).selectExpr("id as k", "id * 2 as w")
    salted = j.salted_join_all(fact, dim, "k", salts=8)
    plan = executed_plan(salted)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert rows(salted) == rows(fact.join(dim, "k").select(*salted.columns))


def test_salting_spreads_the_hot_key(skewed):
    from larder.functions.columns import stable_salt

    hot = skewed.filter("k = 1 and id >= 0").groupBy(stable_salt(8, "id").alias("s")).count().collect()
    assert len(hot) == 8 and max(r["count"] for r in hot) < 2 * min(r["count"] for r in hot)


def test_hot_keys_are_bounded(skewed):
    assert rows(j.hot_keys(skewed, ["k"], 0.2), "k") == [(1,)]
    assert j.hot_keys(skewed, ["k"], 0.01).count() <= 100


def test_buckets_grow_with_the_weight_of_the_key(spark, skewed, dims, monkeypatch):
    kept = []
    monkeypatch.setattr(j, "stash", lambda df, name: kept.append((name, df)) or df)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert rows(j.salted_join(skewed, dims, "k")) == rows(skewed.join(dims, "k"))
        hot = dict(rows(dict(kept)["hot-keys"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    weight = skewed.filter("k = 1").count() / skewed.count()
    assert hot[1] == -(-weight * 40 * 4 // 1) and all(n < hot[1] / 5 for k, n in hot.items() if k != 1)


def test_join_kinds_that_would_repeat_rows_are_refused(skewed, dims):
    with pytest.raises(ValueError):
        j.salted_join(skewed, dims, "k", "full")


def test_a_measured_small_side_is_broadcast_and_a_large_one_is_not(skewed, dims):
    assert "BroadcastHashJoin" in executed_plan(j.join_dimension(skewed, dims, "k"))
    large = j.join_dimension(skewed, dims, "k", limit=0)
    assert rows(large) == rows(skewed.join(dims, "k"))
    assert "_salt" in executed_plan(large)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_a_join_has_one_result_whatever_the_size(skewed, dims, how, null_safe):
    fact = skewed.select("id", "v", "k")
    small = j.join_dimension(fact, dims, "k", how, null_safe=null_safe)
    large = j.join_dimension(fact, dims, "k", how, limit=0, null_safe=null_safe)
    assert small.columns == large.columns == ["id", "v", "k"] + ([] if "_" in how else ["label"])
    assert small.dtypes == large.dtypes
    assert rows(small) == rows(large)
    if not null_safe:
        assert rows(small) == rows(fact.join(dims, "k", how).select(small.columns))


def test_a_strategy_is_obeyed_or_refused(skewed, dims, monkeypatch):
    monkeypatch.setattr(j, "BROADCAST_BYTES", 10)
    for strategy in ("broadcast", "shuffle_hash"):
        with pytest.raises(ValueError):
            j.hinted_join(skewed, dims, "k", strategy)
    assert rows(j.hinted_join(skewed, dims, "k", "merge")) == rows(j.equi_join(skewed, dims, "k"))


def test_hot_keys_are_found_without_writing_all_keys(skewed):
    hot = j.hot_keys(skewed, ["k"], 0.2)
    assert [r["k"] for r in hot.collect()] == [1]
    with pytest.raises(ValueError):
        j.hot_keys(skewed, ["k"], 0.0)


def test_hot_keys_of_any_kind(spark):
    """Null, text and several columns as keys; the shares are exact."""
    made = [(None, "x")] * 300 + [("é", None)] * 250 + [("b", "x")] * 200 + [(f"k{i}", "y") for i in range(250)]
    df = spark.createDataFrame(made, "a string, b string").repartition(7)
    assert rows(j.hot_keys(df, ["a", "b"], 0.15)) == [("b", "x", 0.2), ("é", None, 0.25), (None, "x", 0.3)]
    assert rows(j.hot_keys(df, ["a"], 0.22)) == [("é", 0.25), (None, 0.3)]
    assert j.hot_keys(df.limit(0), ["a"], 0.1).collect() == []


@pytest.mark.parametrize("share, hot", [(0.8, [(7, 0.8)]), (0.0, [])])
def test_hot_keys_among_very_many_light_ones(spark, share, hot):
    """A key with four fifths of the rows is found, and 100,000 light ones give no candidate that stays."""
    light = round(500_000 * (1 - share))
    heavy = spark.range(500_000 - light).select(F.lit(7).cast("bigint").alias("k"))
    many = spark.range(light).select((F.col("id") % 100_000 + 10).alias("k"))
    df = heavy.unionAll(many).repartition(6)
    assert rows(j.hot_keys(df, ["k"], 1e-3)) == hot
    found = j.salted_join(df.withColumn("v", F.lit(1)), spark.range(200).withColumnRenamed("id", "k"), "k", share=1e-3)
    assert found.count() == df.filter("k < 200").count()


def test_hot_keys_shuffle_only_candidates(spark, skewed):
    """All keys stay in their tasks: what is shuffled has passed the semi-join with the candidates."""
    plan = executed_plan(j.hot_keys(skewed, ["k"], 0.2))
    shuffle = plan.index("Exchange hashpartitioning(k")
    assert "LeftSemi" in plan[shuffle:] and "LeftSemi" not in plan[:shuffle]


def test_a_side_is_read_only_where_its_size_is_in_doubt(spark, skewed, dims, small_dir, monkeypatch):
    files = spark.read.parquet(f"{small_dir}/part.parquet").select("p_partkey", "p_name")
    assert 0 < j.read_bytes(files) < 1 << 20 and j.fits_broadcast(files)

    def unwanted(df):
        raise AssertionError("a job before the join")

    monkeypatch.setattr(j, "measured_bytes", unwanted)
    # Surely small: rows and widths are proven.
    for small in (spark.range(1000), files.select("p_partkey").limit(50), files.agg(F.max("p_partkey"))):
        assert j.fits_broadcast(small) and not j.fits_broadcast(small, 1)
    # Surely large by the size of its files.
    monkeypatch.setattr(j, "read_bytes", lambda df: 1 << 30 if "p_name" in df.columns else 1 << 10)
    assert not j.fits_broadcast(files, (1 << 26) - 1)
    large = j.join_dimension(files.withColumnRenamed("p_partkey", "k"), files, ("k", "p_partkey"), limit=1 << 20)
    assert "_salt" in executed_plan(large)
    # Between the two, it is measured.
    with pytest.raises(AssertionError):
        j.fits_broadcast(files, 1 << 27)


def test_a_forbidden_strategy_gives_a_row(spark, small_dir, monkeypatch):
    from larder.queries import QUERIES

    monkeypatch.setattr(j, "BROADCAST_BYTES", 10)
    found = {r["strategy"]: [] for r in QUERIES["join_hints"](spark, small_dir).select("strategy").collect()}
    assert set(found) == {"broadcast", "merge", "shuffle_hash", "sql_merge", "sql_broadcast"}
    counts = dict(rows(QUERIES["join_hints"](spark, small_dir).groupBy("strategy").agg(F.sum("orders").alias("n"))))
    assert counts["broadcast"] == counts["sql_broadcast"] == counts["shuffle_hash"] == 0 < counts["merge"] == counts["sql_merge"]


def test_measured_bytes(spark):
    df = spark.createDataFrame([("é" * 10, 1, None), (None, 2, [1, 2])], "s string, n bigint, a array<int>")
    empty = df.limit(0)
    assert j.measured_bytes(empty) == 0
    assert 20 + 2 * (16 + 16 + 8 + 16) < j.measured_bytes(df) < 200
    assert j.fits_broadcast(df) and not j.fits_broadcast(df, 10) and not j.fits_broadcast(df, 0)


@pytest.mark.parametrize(
    "strategy,node", [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")]
)
def test_strategies(skewed, dims, strategy, node):
    joined = j.hinted_join(skewed, dims, "k", strategy)
    assert node in executed_plan(joined)
    assert rows(joined) == rows(skewed.join(dims, "k"))


def test_sql_hint_names_the_alias(spark, skewed, dims):
    sql = "SELECT /*+ {hint} */ f.k FROM {{f}} f JOIN {{d}} d ON f.k = d.k"
    by_alias = spark.sql(sql.format(hint="MERGE(d)"), f=skewed, d=dims)
    assert "SortMergeJoin" in executed_plan(by_alias)
    by_alias = spark.sql(sql.format(hint="BROADCAST(d)"), f=skewed, d=dims)
    assert "BroadcastHashJoin" in executed_plan(by_alias)


def test_null_safe_join_keeps_null_groups(skewed, dims):
    joined = j.equi_join(skewed, dims, "k", null_safe=True)
    assert joined.filter("k is null").count() == 20
    assert joined.columns == ["k", "id", "v", "label"]


def test_join_with_own_aggregate(skewed):
    totals = skewed.groupBy("k").agg(F.count("*").alias("n"))
    assert j.join_dimension(skewed, totals, "k", null_safe=True).count() == skewed.count()


def test_aggregate_then_join(skewed, dims):
    reduced = j.aggregate_then_join(skewed, dims, "k", [F.sum("v").alias("total")])
    plain = skewed.join(dims, "k").groupBy("k", "label").agg(F.sum("v").alias("total"))
    assert rows(reduced, "k", "label", "total") == rows(plain, "k", "label", "total")


def test_rows_without_match(skewed, dims):
    orphans = j.rows_without_match(skewed, dims, "k")
    assert rows(orphans) == rows(skewed.filter("k >= 50 or k is null"))


def test_skew_report(skewed):
    report = j.skew_report(skewed, "k", top=3).collect()
    assert report[0]["k"] == 1 and report[0]["share"] > 0.33 and report[0]["times_median"] > 5 and len(report) == 3
    assert j.skew_report(skewed, "k").count() == skewed.select("k").distinct().count()
