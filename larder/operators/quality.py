"""Data-quality gates: all rules on a frame in one pass over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import QualityError, SchemaError

RESULT_SCHEMA = "rule string, column string, failures bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """One check: its name, the column it is about, and how many failures it counts.

    ``failures`` is an aggregate over the rows, or a plain number for a check on the
    schema, which needs no rows at all.
    """

    rule: str
    column: str
    failures: Column | int

    @property
    def about_schema(self) -> bool:
        return isinstance(self.failures, int)


def no_nulls(*columns: str) -> list[Rule]:
    return [Rule("no_nulls", c, F.count(F.when(F.col(c).isNull(), 1))) for c in columns]


def min_rows(least: int) -> list[Rule]:
    """Failures are the rows missing to the minimum."""
    return [Rule("min_rows", "*", F.greatest(F.lit(least) - F.count("*"), F.lit(0)))]


def required_columns(df: DataFrame, *columns: str) -> list[Rule]:
    return [Rule("required_column", c, int(c not in df.columns)) for c in columns]


def typed_columns(df: DataFrame, expected: T.StructType) -> list[Rule]:
    actual = dict(df.dtypes)
    return [Rule("column_type", f.name, int(actual.get(f.name) != f.dataType.simpleString())) for f in expected]


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule, from a single aggregate without shuffling any rows; schema rules read none."""
    counted = {i: r for i, r in enumerate(rules) if not r.about_schema}
    if counted:
        totals = df.agg(*[r.failures.cast("bigint").alias(f"_{i}") for i, r in counted.items()])
    else:  # what the schema decides needs no rows
        totals = df.sparkSession.range(1)
    rows = []
    for i, r in enumerate(rules):
        failures = F.lit(r.failures).cast("bigint") if r.about_schema else F.col(f"_{i}")
        rows.append(
            F.struct(
                F.lit(r.rule).alias("rule"),
                F.lit(r.column).alias("column"),
                failures.alias("failures"),
                (failures == 0).alias("passed"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def enforce(df: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """Fail before any expensive step. Schema rules are decided without a job."""
    missing = [r for r in rules if r.about_schema and r.failures]
    if missing:
        raise SchemaError(f"{name}: " + ", ".join(f"{r.rule} {r.column}" for r in missing))
    counted = [r for r in rules if not r.about_schema]
    broken = [row for row in check(df, counted).collect() if not row["passed"]] if counted else []
    if broken:
        found = ", ".join(f"{row['rule']} {row['column']} ({row['failures']})" for row in broken)
        raise QualityError(f"{name}: {found}")
    return df


def has_no_nulls(df: DataFrame, columns) -> bool:
    return all(row["passed"] for row in check(df, no_nulls(*columns)).collect())


def has_min_rows(df: DataFrame, least: int = 1) -> bool:
    """A plain count: for files it is answered from their footers."""
    return df.count() >= least


def has_columns(df: DataFrame, columns) -> bool:
    return set(columns) <= set(df.columns)


def counted_rows(df: DataFrame, least: int, name: str) -> int:
    """The row count, if it reaches the minimum."""
    rows = df.count()
    if rows < least:
        raise QualityError(f"{name}: {rows} rows, at least {least} expected")
    return rows


def profile(df: DataFrame) -> DataFrame:
    """Rows, nulls, approximate distinct values and extremes of every column, in one pass."""
    parts = []
    for i, c in enumerate(df.columns):
        q = F.col(f"`{c}`")
        parts += [
            F.count(F.when(q.isNull(), 1)).alias(f"nulls_{i}"),
            F.approx_count_distinct(q).alias(f"distinct_{i}"),
            F.min(q).cast("string").alias(f"least_{i}"),
            F.max(q).cast("string").alias(f"greatest_{i}"),
        ]
    totals = df.agg(F.count("*").alias("n"), *parts)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("type"),
            F.col("n").alias("rows"),
            F.col(f"nulls_{i}").alias("nulls"),
            F.col(f"distinct_{i}").alias("approx_distinct"),
            F.col(f"least_{i}").alias("min_value"),
            F.col(f"greatest_{i}").alias("max_value"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return totals.select(F.inline(F.array(*rows)))


def split_null_keys(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys present, and the rest for quarantine."""
    keys = list(keys)
    whole = df.dropna(subset=keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return whole, df.filter(missing)


def counting(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count the rows that flow through a step while the job runs, without a job of its own.

    Read ``observation.get["rows"]`` after an action on the returned frame.
    """
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
