"""JDBC tables.

Nothing here is registered as a query: it would need a database, and one embedded in
the driver is not visible to executors. The option building is unit-tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def value_predicates(column: str, values, *, rest: bool = True) -> list[str]:
    """One disjoint WHERE clause per value, plus one for all other rows and nulls.

    Null values are skipped, as the last clause has them. Overlapping predicates would read a row twice, missing ones not at all.
    """
    quoted = [f"'{v.replace(chr(39), chr(39) * 2)}'" if isinstance(v, str) else str(v) for v in dict.fromkeys(values) if v is not None]
    clauses = [f"{column} = {q}" for q in quoted]
    if rest:
        clauses.append(f"{column} IS NULL OR {column} NOT IN ({', '.join(quoted)})")
    return clauses


def read_table(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
               predicates: list[str] | None = None, split_on: str | None = None,
               low: int | None = None, high: int | None = None, partitions: int | None = None) -> DataFrame:
    """Scan a table: whole, by a list of predicates, or in ranges of a number.

    Without a split one connection reads everything, so large tables need one. ``low``
    and ``high`` set the stride of the ranges; rows beyond them are read too.
    """
    if predicates and split_on:
        raise ValueError("split by predicates or by ranges, not both")
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
    if split_on:
        return spark.read.jdbc(
            url, table, column=split_on, lowerBound=low, upperBound=high,
            numPartitions=partitions or spark.sparkContext.defaultParallelism, properties=properties or {},
        )
    return spark.read.jdbc(url, table, properties=properties or {})


def read_query(spark: SparkSession, url: str, sql: str, *, properties: dict | None = None) -> DataFrame:
    """Let the database run a query and read only its result."""
    return spark.read.jdbc(url, f"({sql}) AS pushed_query", properties=properties or {})


def bulk_properties(properties: dict | None = None, batch_rows: int = 10_000) -> dict:
    """Properties of a bulk load; the second is PostgreSQL's multi-row insert."""
    return {**(properties or {}), "batchsize": str(batch_rows), "reWriteBatchedInserts": "true"}


def write_table(df: DataFrame, url: str, table: str, *, mode: str = "append", properties: dict | None = None,
                bulk: bool = False, connections: int | None = None) -> None:
    """Insert a frame. ``connections`` bounds how many tasks hold the database at once.

    ``append`` is not repeatable: a job that failed half-way leaves rows behind. Use
    ``overwrite``, or a staging table, where the job may run again.
    """
    if connections:
        df = df.repartition(connections)
    df.write.jdbc(url, table, mode=mode, properties=bulk_properties(properties) if bulk else properties or {})
