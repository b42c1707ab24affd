"""Physical choices left to the user: partitioning, caching, reading plans."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def spread_by(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition by key for later joins and groupings on the same key.

    All rows of a key go to one task: use it where keys are even, as after a grouping,
    and :func:`even_files` where they may not be.
    """
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def even_files(df: DataFrame, *keys: str) -> DataFrame:
    """Let AQE merge small and split large partitions before a write.

    Unlike ``repartition(key)`` it splits a key that holds a third of the rows.
    """
    return df.hint("rebalance", *keys)


def fewer_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Merge partitions without a shuffle: for frames that are already computed and small, as the
    step above runs in as few tasks."""
    return df.coalesce(partitions)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Hold a frame that several actions read, and release it afterwards."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
