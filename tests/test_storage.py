from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import session
from larder.errors import WriteError
from larder.operators.tuning import executed_plan, kept
from larder.sources import catalog, jdbc, readers, writers

from .conftest import rows


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "csv"])
def test_formats_keep_every_value(spark, restaurants, folder, kind):
    path = writers.write_sink(restaurants, kind, f"{folder}/{kind}")
    assert rows(readers.read_in_order(spark, path, restaurants.schema, kind)) == rows(restaurants)


def test_unknown_names_are_refused(spark, restaurants, folder):
    with pytest.raises(ValueError):
        readers.read_source(spark, "pigeon", folder)
    with pytest.raises(WriteError):
        writers.write_sink(restaurants, "pigeon", folder)
    with pytest.raises(WriteError):
        writers.write_sink(restaurants, "parquet", folder, mode="replace")


def test_partitioned_scan_prunes(spark, restaurants, folder):
    path = writers.write_sink(restaurants, "parquet", f"{folder}/by_city", partition_by=["city"])
    scan = readers.read_source(spark, "parquet", path).filter("city = 'Turin' AND average_rating > 4.5").select("name")
    plan = executed_plan(scan)
    assert "PartitionFilters: [isnotnull(city" in plan and "PushedFilters: [IsNotNull(average_rating)" in plan
    assert "ReadSchema: struct<name:string,average_rating:double>" in plan
    assert rows(scan) == [("fourteen",)]


def test_partition_values_keep_their_type(spark, folder):
    df = spark.createDataFrame([("01", 1), ("2", 2)], "code string, n int")
    path = writers.write_sink(df, "parquet", f"{folder}/codes", partition_by=["code"])
    assert rows(readers.read_in_order(spark, path, df.schema)) == [("01", 1), ("2", 2)]


def test_export_replaces_only_its_partitions(spark, folder):
    df = spark.createDataFrame([(2023, 1), (2024, 2)], "year int, n int")
    writers.export_partitions(df, f"{folder}/years", ["year"])
    writers.export_partitions(df.filter("year = 2024").withColumn("n", F.lit(9)), f"{folder}/years", ["year"])
    assert rows(readers.read_in_order(spark, f"{folder}/years", df.schema)) == [(2023, 1), (2024, 9)]


def test_a_heavy_partition_value_gets_several_writers(spark, folder):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, 1).otherwise(2).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        path = writers.write_sink(df.repartition(8), "parquet", f"{folder}/heavy", partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).filter("k = 1").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 20000


def test_deliveries(spark, restaurants, folder):
    formats = writers.deliver_formats(restaurants, f"{folder}/formats", ("json", "parquet"))
    frames = writers.deliver_frames({"a": restaurants, "b": restaurants.limit(1)}, f"{folder}/frames")
    assert set(formats) == {"json", "parquet"} and spark.read.parquet(frames["b"]).count() == 1
    assert spark.read.parquet(frames["a"]).count() == 6


def test_compression_is_in_the_file_names(spark, restaurants, folder):
    path = writers.write_sink(restaurants, "parquet", f"{folder}/z", compression="zstd")
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(path).inputFiles())


def test_catalog(spark, restaurants, folder):
    database = catalog.create_database(spark, "larder_unit", folder)
    table = catalog.create_table(restaurants, database, "places", partition_by=["city"])
    assert rows(catalog.list_partitions(spark, table)) == [("city=Oulu",), ("city=Quito",), ("city=Turin",)]
    restaurants.limit(1).createOrReplaceTempView("places")  # must not shadow the table
    assert readers.read_source(spark, "table", table).count() == 6
    view = catalog.create_view(spark, f"{database}.good", f"SELECT * FROM {table} WHERE average_rating >= 4.5", temporary=False)
    assert spark.table(view).count() == 2
    with catalog.cached_table(spark, "places") as cached:
        assert spark.catalog.isCached("places") and cached.count() == 1
    assert not spark.catalog.isCached("places")
    assert spark.newSession().table(catalog.share_view(restaurants, "unit_shared")).count() == 6


def test_bucketed_tables_join_without_a_shuffle(spark, restaurants, orders, folder):
    database = catalog.create_database(spark, "larder_buckets", folder)
    left = catalog.create_bucketed_table(orders, database, "orders", "restaurant_id", 4)
    right = catalog.create_bucketed_table(restaurants, database, "places", "restaurant_id", 4)
    joined = spark.table(left).join(spark.table(right).hint("merge"), "restaurant_id")
    assert "Exchange" not in executed_plan(joined) and joined.count() == 7


def test_kept_releases(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    with kept(df) as held:
        assert held.storageLevel.useMemory and held.count() == 10
    assert not df.storageLevel.useMemory


def test_scratch_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(named.rstrip("/"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(cluster)


def test_shuffle_width_follows_the_input(spark, restaurants, small_dir, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffle(spark, spark.range(3).rdd.toDF("id bigint")) == int(before)
        files = spark.read.parquet(f"{small_dir}/part.parquet")
        assert session.size_shuffle(spark, files) == spark.sparkContext.defaultParallelism
        monkeypatch.setattr(session, "planned_bytes", lambda df: 64 << 30)
        assert session.size_shuffle(spark, restaurants) == 1024
        monkeypatch.setattr(session, "planned_bytes", lambda df: 100 << 40)
        assert session.size_shuffle(spark, restaurants) == session.MOST_SHUFFLE_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_object_store_settings():
    conf = readers.object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true" and len(conf) == 6


def test_literal_rows_with_a_column_of_nulls(spark):
    schema = T.StructType().add("id", "long").add("phone", "string")
    assert rows(readers.read_rows(spark, [(1, None)], schema)) == [(1, None)]


# JDBC: no database is started; the calls that would reach one are recorded.


def test_jdbc_scans():
    spark = MagicMock()
    spark.sparkContext.defaultParallelism = 6
    jdbc.read_table(spark, "jdbc:x", "t", properties={"user": "u"})
    spark.read.jdbc.assert_called_with("jdbc:x", "t", properties={"user": "u"})
    jdbc.read_table(spark, "jdbc:x", "t", predicates=["a = 1", "a <> 1"])
    spark.read.jdbc.assert_called_with("jdbc:x", "t", predicates=["a = 1", "a <> 1"], properties={})
    jdbc.read_table(spark, "jdbc:x", "t", split_on="id", low=0, high=90)
    spark.read.jdbc.assert_called_with(
        "jdbc:x", "t", column="id", lowerBound=0, upperBound=90, numPartitions=6, properties={}
    )
    jdbc.read_query(spark, "jdbc:x", "SELECT 1")
    spark.read.jdbc.assert_called_with("jdbc:x", "(SELECT 1) AS pushed_query", properties={})
    readers.read_source(spark, "jdbc", "t", url="jdbc:x")
    spark.read.jdbc.assert_called_with("jdbc:x", "t", properties={})
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "jdbc:x", "t", predicates=["a = 1"], split_on="id")


def test_jdbc_predicates_cover_every_row_once(spark):
    df = spark.createDataFrame([("Rio",), ("O'Hara",), ("Lima",), (None,)], "city string")
    clauses = jdbc.value_predicates("city", ["Rio", "O'Hara", "Rio"])
    assert [df.filter(c).count() for c in clauses] == [1, 1, 2]


def test_jdbc_writes():
    df = MagicMock()
    jdbc.write_table(df, "jdbc:x", "t", mode="overwrite")
    df.write.jdbc.assert_called_with("jdbc:x", "t", mode="overwrite", properties={})
    jdbc.write_table(df, "jdbc:x", "t", bulk=True, connections=4, properties={"user": "u"})
    df.repartition.assert_called_with(4)
    df.repartition().write.jdbc.assert_called_with(
        "jdbc:x", "t", mode="append",
        properties={"user": "u", "batchsize": "10000", "reWriteBatchedInserts": "true"},
    )
    writers.write_sink(df, "jdbc", "t", url="jdbc:x", mode="append")
    df.write.jdbc.assert_called_with("jdbc:x", "t", mode="append", properties={})


def test_rows_per_file_and_number_of_files(spark, folder):
    df = spark.range(2500).repartition(5)
    capped = writers.write_sink(df, "parquet", f"{folder}/capped", max_records=100)
    sizes = spark.read.parquet(capped).groupBy(F.input_file_name().alias("f")).count()
    assert sizes.agg(F.max("count")).first()[0] == 100 and sizes.count() == 25
    few = writers.write_sink(df, "parquet", f"{folder}/few", files=2)
    assert len(spark.read.parquet(few).inputFiles()) == 2


def test_one_file_for_each_bucket(spark, orders, folder):
    database = catalog.create_database(spark, "larder_bucket_files", f"{folder}/db")
    table = catalog.create_bucketed_table(orders.repartition(6), database, "orders", "restaurant_id", 4)
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert 0 < files <= 4
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_queries_leave_no_database(spark, small_dir):
    from larder.queries import QUERIES

    before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    for name in ("catalog_ctas", "catalog_partition_scan", "permanent_view", "bucketed_join"):
        QUERIES[name](spark, small_dir).collect()
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before


def test_null_values_of_predicates_are_skipped():
    assert jdbc.value_predicates("c", ["a", None]) == ["c = 'a'", "c IS NULL OR c NOT IN ('a')"]
