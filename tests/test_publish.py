import pytest
from pyspark.sql import functions as F

from larder.errors import QualityError, WriteError
from larder.plans import jobs
from larder.sources import catalog, publish, writers
from larder.operators.tuning import executed_plan, fewer_partitions

from .conftest import rows


def numbers(spark, value, years=(2023, 2024)):
    return spark.createDataFrame([(y, m, value) for y in years for m in (1, 2)], "year int, month int, n int")


def folders(spark, location):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/versions")
    return sorted(s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path))


def test_a_refused_version_leaves_the_old_rows(spark, folder):
    first, location = numbers(spark, 1), f"{folder}/n"
    publish.publish(first, location)

    def refuse(df):
        assert df.count() == 4  # the check sees what was written
        raise QualityError("no")

    with pytest.raises(QualityError):
        publish.publish(numbers(spark, 2), location, check=refuse)
    assert rows(publish.read_published(spark, location)) == rows(first)
    publish.publish(numbers(spark, 3), location)
    assert rows(publish.read_published(spark, location)) == rows(numbers(spark, 3))


def test_a_job_that_dies_while_it_writes_leaves_the_old_rows(spark, folder):
    first, location = numbers(spark, 1), f"{folder}/n"
    publish.publish_frames({"a": first, "b": first}, location)
    broken = first.withColumn("n", F.when(F.col("month") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(5))
    with pytest.raises(Exception, match="lost"):
        publish.publish_frames({"a": numbers(spark, 2), "b": broken}, location)
    # The first frame of the failed job is written but not published either.
    assert len(folders(spark, location)) == 2
    for name in "ab":
        assert rows(publish.read_published(spark, location, name)) == rows(first)


def test_readers_keep_their_version(spark, folder):
    location = f"{folder}/n"
    publish.publish(numbers(spark, 1), location)
    reader = publish.read_published(spark, location)
    publish.publish(numbers(spark, 2), location)
    assert rows(reader) == rows(numbers(spark, 1))
    for value in range(3, 7):
        publish.publish(numbers(spark, value), location)
    assert len(folders(spark, location)) == 2  # the current one and the one before
    assert rows(publish.read_published(spark, location)) == rows(numbers(spark, 6))


def test_partitions_are_replaced_alone(spark, folder):
    location, by = f"{folder}/n", ["year", "month"]
    publish.publish(numbers(spark, 1), location, partition_by=by)
    old = folders(spark, location)
    publish.publish_partitions(numbers(spark, 2, [2024, 2025]).filter("month = 1"), location, by)
    expected = [(2023, 1, 1), (2023, 2, 1), (2024, 1, 2), (2024, 2, 1), (2025, 1, 2)]
    assert rows(publish.read_published(spark, location)) == expected
    publish.publish_partitions(numbers(spark, 3, [2024]), location, by)
    found = publish.read_published(spark, location)
    assert rows(found) == [(2023, 1, 1), (2023, 2, 1), (2024, 1, 3), (2024, 2, 3), (2025, 1, 2)]
    # The rows nobody replaced are where they were written first.
    assert any(old[0] in f for f in found.filter("year = 2023").inputFiles())
    publish.publish_partitions(numbers(spark, 9).limit(0), location, by)
    assert publish.read_published(spark, location).count() == 5
    with pytest.raises(WriteError):
        publish.publish_partitions(numbers(spark, 4), location, ["year"])


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "csv"])
def test_published_formats_and_empty_frames(spark, restaurants, folder, kind):
    publish.publish(restaurants, f"{folder}/{kind}", kind=kind)
    found = publish.read_published(spark, f"{folder}/{kind}")
    assert found.columns == restaurants.columns and rows(found) == rows(restaurants)
    publish.publish(restaurants.limit(0), f"{folder}/{kind}", kind=kind)
    assert publish.read_published(spark, f"{folder}/{kind}").count() == 0


def test_nothing_published(spark, folder):
    with pytest.raises(WriteError):
        publish.read_published(spark, f"{folder}/none")


def test_a_job_that_fails_keeps_the_results_of_the_last_run(spark, restaurants, orders, folder):
    users = spark.createDataFrame([(1, "a@x", "(1) 2")], "user_id bigint, email string, phone_number string")
    jobs.end_to_end_job(users, restaurants, orders, folder)
    before = rows(publish.read_published(spark, folder, "order_metrics"))
    with pytest.raises(Exception, match="lost"):
        broken = orders.withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))
        jobs.end_to_end_job(users.withColumn("email", F.lit("new")), restaurants, broken, folder)
    assert rows(publish.read_published(spark, folder, "order_metrics")) == before
    assert rows(publish.read_published(spark, folder, "users"), "email") == [("a@x",)]


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_files_lie_between_two_sizes(spark, folder, kind):
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(17)
    least, most = 100_000, 900_000
    sizes = writers.write_sized(df, kind, f"{folder}/sized", least=least, most=most, sample_rows=2000)
    assert len(sizes) > 3 and all(least <= size <= most for size in sizes)
    assert spark.read.schema(df.schema).format(kind).load(f"{folder}/sized").count() == 60_000
    # Rows that pack far better in bulk than in the sample: the files are sized by what they came to.
    alike = spark.range(400_000).select((F.col("id") % 7).alias("k"), F.lit("x" * 50).alias("text")).repartition(9)
    sizes = writers.write_sized(alike, kind, f"{folder}/alike", least=20_000, most=2_000_000, sample_rows=50)
    assert all(size <= 2_000_000 for size in sizes) and (len(sizes) == 1 or min(sizes) >= 20_000)
    small = writers.write_sized(df.limit(5), kind, f"{folder}/small", least=least, most=most)
    assert len(small) == 1
    assert sum(writers.write_sized(df.limit(0), kind, f"{folder}/none")) < 1000
    with pytest.raises(WriteError):
        writers.write_sized(df, kind, f"{folder}/none", least=2, most=3)


def scans(spark, plan):
    """The file scans of an executed plan, subqueries aside."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_join_prunes_the_directories_of_the_large_side(spark, small_dir):
    from larder.queries import QUERIES

    df = QUERIES["pruned_join"](spark, small_dir)
    assert "dynamicpruningexpression" in executed_plan(df)
    df.collect()
    read = {s.metadata().get("Location").get(): s for s in scans(spark, df._jdf.queryExecution().executedPlan())}
    files = [s.metrics().get("numPartitions").get().value() for where, s in read.items() if "dated" in where]
    months = spark.read.parquet(f"{small_dir}/lineitem.parquet").select(F.trunc("l_shipdate", "month")).distinct().count()
    assert files and 0 < sum(files) <= months / 4


def test_few_partitions_without_a_shuffle(spark):
    df = spark.range(100, numPartitions=8)
    merged = fewer_partitions(df, 2)
    assert "Exchange" not in executed_plan(merged) and "Coalesce 2" in executed_plan(merged)
    assert merged.select(F.spark_partition_id()).distinct().count() == 2 and merged.count() == 100


def test_queries_leave_no_view(spark, small_dir):
    from larder.queries import QUERIES

    def views():
        return {(v.namespace, v.viewName) for name in ("", " IN global_temp") for v in spark.sql(f"SHOW VIEWS{name}").collect()}

    before = views()
    for name in ("views", "global_view", "cache_sql", "view_report", "permanent_view"):
        QUERIES[name](spark, small_dir).collect()
    assert views() == before
    with pytest.raises(ZeroDivisionError), catalog.views_of(spark, one_view=spark.range(3)):
        1 / spark.table("one_view").filter("id > 5").count()
    assert views() == before
