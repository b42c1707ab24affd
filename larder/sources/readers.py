"""Files, tables and object stores as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILE_KINDS = ("parquet", "orc", "json", "csv")


def read_source(spark: SparkSession, kind: str, location: str, *, schema=None, **options) -> DataFrame:
    """One entry for every source: a file format, ``table`` or ``jdbc``.

    JSON and CSV take a schema: inference would read all data twice, sort JSON columns by
    name and leave CSV as unnamed text.
    """
    if kind == "table":
        return spark.table(location)
    if kind == "jdbc":
        from .jdbc import read_table

        return read_table(spark, table=location, **options)
    if kind not in FILE_KINDS:
        raise ValueError(f"unknown source {kind!r}; use one of {', '.join(FILE_KINDS)}, table, jdbc")
    if kind == "csv":
        options.setdefault("header", True)
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(location)


def read_rows(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Literal rows for fixtures; an explicit schema also covers columns that are all null."""
    return spark.createDataFrame(rows, schema)


def read_in_order(spark: SparkSession, location: str, schema: T.StructType, kind: str = "parquet") -> DataFrame:
    """A partitioned data set with its own column order and types.

    Partition columns come back last and re-typed from directory names ("01" as 1);
    the schema fixes the types and the select the order.
    """
    return read_source(spark, kind, location, schema=schema).select(*schema.fieldNames())


def object_store_conf(endpoint: str, access_key: str, secret_key: str, *, path_style: bool = True,
                      tls: bool = False) -> dict[str, str]:
    """Settings with which ``s3a://`` paths work in every reader and writer.

    Pass them to ``build_session``; executors then read the store directly.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
