import math

import pytest
from pyspark.sql import functions as F

from larder import fixed_values as fixed
from larder.functions import columns as c
from larder.functions import udfs
from larder.operators.tuning import executed_plan


def values(spark, kind, items, expression):
    df = spark.createDataFrame(list(enumerate(items)), f"id int, v {kind}")
    return [r[0] for r in df.orderBy("id").select(expression(F.col("v"))).collect()]


SIGNS = "()-+"


def with_signs():
    """Every sign, and white space, at every place of a text; all of them at once; nothing but signs; empty; null."""
    plain = "a1 b"
    one = [plain[:i] + sign + plain[i:] for sign in SIGNS + "\t\n" for i in range(len(plain) + 1)]
    return [*one, SIGNS.join(plain), SIGNS, "", None]


@pytest.mark.parametrize("keep_spaces, gone", [(True, SIGNS), (False, "()- \t\n")])
def test_phone_loses_its_signs_and_nothing_else(spark, keep_spaces, gone):
    expected = [v and "".join(x for x in v if x not in gone) for v in with_signs()]
    assert values(spark, "string", with_signs(), lambda v: c.clean_phone(v, keep_spaces=keep_spaces)) == expected


def test_ladder_takes_the_first_bound_reached(spark):
    """On each bound, just above and just below it."""
    label = lambda v: c.ladder(v, fixed.RATING_STEPS, fixed.RATING_REST)
    names = [name for _, name in fixed.RATING_STEPS] + [fixed.RATING_REST]
    for i, (bound, name) in enumerate(fixed.RATING_STEPS):
        near = [math.nextafter(bound, 9), bound, math.nextafter(bound, 0)]
        assert values(spark, "double", near, label) == [name, name, names[i + 1]]
    assert values(spark, "double", [math.inf, -math.inf, None], label) == [names[0], names[-1], names[-1]]


def test_ladder_null_label_and_open_bounds(spark):
    label = lambda v: c.ladder(v, fixed.AMOUNT_STEPS, fixed.AMOUNT_REST, null_label="none", inclusive=False)
    assert values(spark, "double", [150.01, 150.0, 75.0, None], label) == ["High", "Medium", "Low", "none"]


def test_float_ratings_are_cast_before_the_bounds(spark):
    assert values(spark, "float", [4.3], lambda v: v > 4.3) == [True]
    assert values(spark, "float", [4.3], lambda v: c.money(v) > F.lit(4.3).cast("decimal(12,2)")) == [False]


def test_normalized(spark):
    """Any case and any blanks around a word come to one text; blanks inside stay; null has a default."""
    given = [pad + word + end for word in ("x", "Xy Z", "\u00e9\u00df") for pad in ("", " ", "   ") for end in ("", "  ")]
    expected = [word.strip().upper() for word in given]
    normal = lambda v: c.normalized(v, fixed.CUISINE_DEFAULT)
    assert values(spark, "string", given, normal) == expected
    assert values(spark, "string", ["", "  ", None], normal) == ["", "", fixed.CUISINE_DEFAULT]


def test_sentence_case_leaves_later_words_down(spark):
    assert values(spark, "string", ["nEW york", "", None], c.sentence_case) == ["New york", "", None]


def test_clamp_keeps_null(spark):
    assert values(spark, "double", [7.0, -1.0, 3.0, None], lambda v: c.clamp(v, 0.0, 5.0)) == [5.0, 0.0, 3.0, None]


def test_ratio_by_zero_is_null(spark):
    assert values(spark, "double", [0.0, 4.0], lambda v: c.ratio(F.lit(10.0), v, 2)) == [None, 2.5]


def test_lookup(spark):
    assert values(spark, "int", [1, 7, 9, None], lambda v: c.lookup(v, fixed.WEEKDAYS, "?")) == ["Sun", "Sat", "?", "?"]


def test_scores(spark):
    root = values(spark, "int", [9901], lambda v: F.round(c.root_score(F.lit(5.0), v, 100), 2))
    log = values(spark, "int", [9901], lambda v: F.round(c.log_score(F.lit(5.0), v), 2))
    unit = values(spark, "int", [16], lambda v: c.root_score(F.lit(2.5), v, 1, top=5))
    assert (root, log, unit) == ([49.75], [23.0], [2.0])


def test_dates_from_text(spark):
    df = spark.createDataFrame([("2024-01-15",), ("no date",), (None,)], "d string")
    parts = [tuple(r)[1:] for r in c.date_parts(df, "d").collect()]
    assert parts == [(2024, 1, 2), (None, None, None), (None, None, None)]
    assert values(spark, "string", ["2024-01-01 10:00:00", "bad"], lambda v: c.parse_timestamp(v).isNull()) == [
        False, True,
    ]


def test_salts(spark):
    df = spark.range(4000)
    spread = df.groupBy(c.random_salt(5, seed=1).alias("s")).count().collect()
    assert {r["s"] for r in spread} == set(range(5)) and all(600 < r["count"] < 1000 for r in spread)
    first = df.select(c.stable_salt(5, "id").alias("s"))
    assert first.collect() == df.repartition(3).orderBy("id").select(c.stable_salt(5, "id").alias("s")).collect()
    assert df.limit(1).select(c.every_salt(3).alias("s")).count() == 3


@pytest.mark.parametrize("way", ["row", "registered", "inlined"])
def test_udfs_equal_the_builtin(spark, way):
    df = spark.createDataFrame([(1, 4.5), (2, 4.0), (3, 1.0)], "id int, average_rating double")
    plain = udfs.label_function(fixed.RATING_STEPS, fixed.RATING_REST, "none")
    if way == "row":
        got = df.select(udfs.row_udf(plain, "string")("average_rating"))
    elif way == "registered":
        name = udfs.register_sql_function(spark, "test_label", plain, "string")
        got = df.selectExpr(f"{name}(average_rating)")
    else:
        name = udfs.create_sql_ladder(spark, "test_ladder", fixed.RATING_STEPS, fixed.RATING_REST)
        got = df.selectExpr(f"{name}(average_rating)")
    builtin = df.select(c.ladder(F.col("average_rating"), fixed.RATING_STEPS, fixed.RATING_REST))
    assert [r[0] for r in got.collect()] == [r[0] for r in builtin.collect()]


def test_row_udf_handles_null(spark):
    plain = udfs.label_function(fixed.RATING_STEPS, fixed.RATING_REST, "none")
    assert values(spark, "double", [None, 4.6], udfs.row_udf(plain, "string")) == ["none", "Excellent"]


def test_pandas_udf_equals_builtin(spark):
    df = spark.createDataFrame([(4.5, 120.0), (1.0, 0.0)], "r double, n double")
    both = df.select(udfs.log_score_batches()("r", "n"), c.log_score(F.col("r"), F.col("n"))).collect()
    assert all(abs(a - b) < 1e-9 for a, b in both)


def test_salted_counts_hold_no_copies_in_a_task(spark, folder):
    """Also with a key that has no place, a place without orders and a null key."""
    from larder.queries import QUERIES

    lines = [(i, 1, (i * i) % 40 if i % 9 else None, i % 7) for i in range(2000)]
    made = spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint")
    made.selectExpr("*", "1.0D as l_extendedprice", "date'2020-01-01' as l_shipdate").write.parquet(f"{folder}/lineitem.parquet")
    parts = spark.range(1, 60).selectExpr("id as p_partkey", "'n' as p_name", "'b' as p_brand", "'t' as p_type", "1 as p_size", "2.0D as p_retailprice")
    parts.write.parquet(f"{folder}/part.parquet")
    counted = QUERIES["salted_counts"](spark, folder)
    assert "Broadcast" not in executed_plan(counted)
    want = {}
    for line in lines:
        if line[2]:
            want[line[2]] = want.get(line[2], 0) + 1
    assert {r["restaurant_id"]: r["orders"] for r in counted.collect()} == want
