"""Databases, tables, views and the SQL cache."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .writers import write_sink


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return name


def create_table(df: DataFrame, database: str, name: str, partition_by=()) -> str:
    """CREATE TABLE AS SELECT. The name is always qualified, so no view can shadow it."""
    table = f"{database}.{name}"
    return write_sink(df, "table", table, partition_by=partition_by)


def create_bucketed_table(df: DataFrame, database: str, name: str, key: str, buckets: int) -> str:
    """Rows stored by hash of the key: joins on it need no shuffle afterwards.

    One task later reads a whole bucket, so check the key for skew first.
    """
    table = f"{database}.{name}"
    # One task for each bucket, so there is one file for each.
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return table


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def create_view(spark: SparkSession, name: str, sql: str, *, temporary: bool = True) -> str:
    """A view from a query; a permanent one has to read tables, not temporary views."""
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {name} AS {sql}")
    return name


def share_view(df: DataFrame, name: str) -> str:
    """A view every session of the application sees."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


@contextmanager
def views_of(spark: SparkSession, **frames: DataFrame | str):
    """Temporary views of frames or SQL, each on those before it, for as long as a block lasts.

    Frames made from them stay valid afterwards.
    """
    try:
        for name, given in frames.items():
            if isinstance(given, str):
                create_view(spark, name, given)
            else:
                given.createOrReplaceTempView(name)
        yield
    finally:
        for name in reversed(frames):
            spark.catalog.dropTempView(name)


@contextmanager
def shared_view(df: DataFrame, name: str):
    """A view every session of the application sees while the block lasts."""
    try:
        yield share_view(df, name)
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


@contextmanager
def cached_table(spark: SparkSession, name: str):
    spark.sql(f"CACHE TABLE {name}")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"UNCACHE TABLE IF EXISTS {name}")
