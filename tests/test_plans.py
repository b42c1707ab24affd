"""The physical plans the queries are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from larder.operators.tuning import executed_plan, optimized_plan
from larder.queries import QUERIES
from larder.queries.registry import restaurants, tickets


def plan_of(spark, name, sf_dir):
    return executed_plan(QUERIES[name](spark, sf_dir))


def test_flagship_reads_two_columns_and_shuffles_no_fact_rows(spark, middle_dir):
    plan = plan_of(spark, "order_metrics", middle_dir)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan
    # The first shuffle comes after the partial aggregate, the second sorts the result.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange rangepartitioning") == 1
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "partial_sum" in before_shuffle


def test_filters_reach_the_scans(spark, middle_dir):
    plan = plan_of(spark, "filter_before_join", middle_dir)
    assert "GreaterThan(l_extendedprice,20000.0)" in plan and "GreaterThan(p_retailprice,975.0)" in plan


def test_top_k_does_not_sort_everything(spark, middle_dir):
    plan = plan_of(spark, "top_k", middle_dir)
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["top_rows_per_group", "dedup_latest", "top_n_per_group"])
def test_group_top_n_is_cut_before_the_shuffle(spark, middle_dir, name):
    plan = plan_of(spark, name, middle_dir)
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan.split("Exchange")[1]


def test_strategies_of_the_hints(spark, middle_dir):
    plan = plan_of(spark, "join_hints", middle_dir)
    assert all(node in plan for node in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin"))


@pytest.mark.parametrize("name", ["rating_bucket", "scores", "regex_clean", "weekday_names", "udf_sql_inlined"])
def test_no_python_in_builtin_paths(spark, small_dir, name):
    plan = plan_of(spark, name, small_dir)
    assert not re.search("BatchEvalPython|ArrowEvalPython", plan)


def test_python_paths_travel_as_arrow(spark, small_dir):
    assert "ArrowEvalPython" in plan_of(spark, "udf_pandas", small_dir)
    for name in ("udf_scalar", "udf_sql"):
        assert "BatchEvalPython" not in plan_of(spark, name, small_dir)


def test_group_statistics_use_no_window(spark, middle_dir):
    for name in ("group_avg_diff", "correlated_avg"):
        assert "Window" not in plan_of(spark, name, middle_dir)


def test_no_query_has_a_cross_join_or_a_nested_loop(spark, small_dir):
    for name in ("order_metrics", "share_of_total", "group_stats_join", "salted_join", "quality_gate", "sql_label_shares"):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan_of(spark, name, small_dir)), name


def test_gate_scans_each_input_once(spark, small_dir):
    assert plan_of(spark, "quality_gate", small_dir).count("FileScan") == 3


def test_three_ways_of_writing_a_query_give_one_plan(spark, small_dir):
    places = restaurants(spark, small_dir)
    by_frame = places.filter(F.col("average_rating") > 950).groupBy("cuisine_type").agg(F.count("*").alias("total"))
    by_expr = places.filter("average_rating > 950D").groupBy("cuisine_type").agg(F.expr("COUNT(*) AS total"))
    by_sql = spark.sql(
        "SELECT cuisine_type, COUNT(*) AS total FROM {p} WHERE average_rating > 950D GROUP BY cuisine_type", p=places
    )
    assert optimized_plan(by_frame) == optimized_plan(by_expr) == optimized_plan(by_sql)


def test_salting_adds_no_shuffle_over_a_merge_join(spark, middle_dir):
    lines, places = tickets(spark, middle_dir), restaurants(spark, middle_dir)
    plain = executed_plan(lines.join(places.hint("merge"), "restaurant_id"))
    salted = plan_of(spark, "salted_join", middle_dir)
    assert plain.count("Exchange hashpartitioning") == 2
    # Two for the join at most, one for the grouping that follows.
    assert salted.count("Exchange hashpartitioning") <= 3


@pytest.mark.parametrize("name", ["ranks", "ntile_percent_rank"])
def test_all_ranks_of_a_query_come_from_one_exchange(spark, middle_dir, monkeypatch, name):
    from larder.operators import windows

    counted, largest = [], windows.largest_group
    monkeypatch.setattr(windows, "largest_group", lambda df, keys: counted.append(keys) or largest(df, keys))
    assert plan_of(spark, name, middle_dir).count("ENSURE_REQUIREMENTS") == 1
    assert len(counted) == 1
