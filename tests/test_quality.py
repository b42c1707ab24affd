import pytest
from pyspark.sql import types as T

from larder.errors import JobError, QualityError, SchemaError
from larder.operators import quality as q

from .conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, "c", "y")], "id bigint, name string, phone string")


def test_all_rules_in_one_row_of_counts(people):
    found = rows(q.check(people, q.no_nulls("id", "name") + q.min_rows(5) + q.required_columns(people, "email")))
    assert found == [
        ("min_rows", "*", 2, False), ("no_nulls", "id", 0, True), ("no_nulls", "name", 1, False),
        ("required_column", "email", 1, False),
    ]


def test_check_is_one_pass(people):
    plan = q.check(people, q.no_nulls("id", "name", "phone") + q.min_rows(1))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Aggregate") == 1 and "Join" not in plan.toString()


def test_bool_forms(people):
    assert q.has_no_nulls(people, ["id"]) and not q.has_no_nulls(people, ["id", "name"])
    assert q.has_min_rows(people, 3) and not q.has_min_rows(people, 4)
    assert q.has_columns(people, ["id", "name"]) and not q.has_columns(people, ["email"])


def test_enforce_raises_typed_errors(people):
    assert q.enforce(people, q.no_nulls("id") + q.min_rows(1), "people") is people
    with pytest.raises(QualityError, match=r"people: no_nulls name \(1\), min_rows \* \(7\)"):
        q.enforce(people, q.no_nulls("name") + q.min_rows(10), "people")
    with pytest.raises(SchemaError, match="email"):
        q.enforce(people, q.required_columns(people, "id", "email") + q.no_nulls("name"), "people")
    assert issubclass(QualityError, JobError) and issubclass(SchemaError, JobError)


def test_schema_rules_run_no_job(people, spark):
    wrong = T.StructType().add("id", "string").add("name", "string")
    assert [r.failures for r in q.typed_columns(people, wrong)] == [1, 0]


def test_counted_rows(people):
    assert q.counted_rows(people, 3, "people") == 3
    with pytest.raises(QualityError):
        q.counted_rows(people, 4, "people")


def test_profile(people):
    found = {r["column"]: r for r in q.profile(people).collect()}
    assert found["name"]["nulls"] == 1 and found["id"]["max_value"] == "3" and found["phone"]["rows"] == 3


def test_split_null_keys(people):
    whole, rest = q.split_null_keys(people, ["name", "phone"])
    assert rows(whole, "id") == [(3,)] and rows(rest, "id") == [(1,), (2,)]


def test_rules_on_an_empty_frame(people):
    empty = people.limit(0)
    assert rows(q.check(empty, q.no_nulls("id") + q.min_rows(1))) == [
        ("min_rows", "*", 1, False), ("no_nulls", "id", 0, True),
    ]


def test_observed_counts(people):
    frame, seen = q.counting(people.filter("id > 1"), "late")
    frame.collect()
    assert seen.get["rows"] == 2


def test_schema_rules_read_no_rows(spark, small_dir):
    from larder.operators.tuning import executed_plan

    parts = spark.read.parquet(f"{small_dir}/part.parquet")
    plan = executed_plan(q.check(parts, q.required_columns(parts, "p_name", "email")))
    assert "FileScan" not in plan
