"""Python functions on columns.

The built-in forms in ``columns`` are the ones to use on large data; these exist for
rules that only come as Python code, and are checked against the built-ins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def label_function(steps, rest: str, null_label: str):
    """A plain Python threshold ladder with its null branch."""

    def label(value):
        if value is None:
            return null_label
        return next((name for bound, name in steps if value >= bound), rest)

    return label


def row_udf(function, returns: str):
    """A row function whose rows travel as Arrow batches instead of pickles."""
    return F.udf(function, returns, useArrow=True)


def register_sql_function(spark: SparkSession, name: str, function, returns: str) -> str:
    spark.udf.register(name, row_udf(function, returns))
    return name


def create_sql_ladder(spark: SparkSession, name: str, steps, rest: str) -> str:
    """The same rule as a SQL function: callable by name, yet inlined by Catalyst."""
    def quoted(label: str) -> str:
        return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"

    cases = " ".join(f"WHEN value >= {float(bound)!r}D THEN {quoted(label)}" for bound, label in steps)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value DOUBLE) RETURNS STRING "
        f"RETURN CASE {cases} ELSE {quoted(rest)} END"
    )
    return name


def log_score_batches() -> Column:
    """Vectorised popularity score: whole Arrow batches, no Python per row."""

    @F.pandas_udf("double")
    def score(rating: pd.Series, reviews: pd.Series) -> pd.Series:
        return rating**2 * np.log1p(reviews) / 10

    return score
