"""pandas-on-Spark at the edges of a job, native DataFrames inside it."""

from __future__ import annotations

import os

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")

import pandas as pd  # noqa: E402
import pyspark.pandas as ps  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from .operators.joins import join_dimension  # noqa: E402


def set_options() -> None:
    """An index without a global sequence, and no silent joins between frames."""
    ps.set_option("compute.default_index_type", "distributed")
    ps.set_option("compute.ops_on_diff_frames", False)


def to_pandas_api(df: DataFrame) -> ps.DataFrame:
    set_options()
    return df.pandas_api()


def to_native(frame: ps.DataFrame) -> DataFrame:
    """Back to a DataFrame without the index column."""
    return frame.spark.frame() if isinstance(frame, ps.DataFrame) else frame.to_frame().spark.frame()


def from_local(spark: SparkSession, local: pd.DataFrame) -> ps.DataFrame:
    return to_pandas_api(spark.createDataFrame(local))


def to_local(frame: ps.DataFrame, limit: int) -> pd.DataFrame:
    """All rows on the driver, at most ``limit`` of them; a larger frame is refused."""
    rows = to_native(frame).limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"the frame has over {limit} rows")
    return rows


def read_json_lines(spark: SparkSession, location: str, schema) -> ps.DataFrame:
    return to_pandas_api(spark.read.schema(schema).json(location))


def natively(frame: ps.DataFrame, *steps) -> ps.DataFrame:
    """Run DataFrame functions in the middle of a pandas-style chain."""
    native = to_native(frame)
    for step in steps:
        native = native.transform(step)
    return to_pandas_api(native)


def merge(left: ps.DataFrame, right: ps.DataFrame, on, how: str = "inner") -> ps.DataFrame:
    """Merge through a native join, which can broadcast or salt."""
    return natively(left, lambda df: join_dimension(df, to_native(right), on, how))


def join_local(fact: DataFrame, local: pd.DataFrame, on) -> DataFrame:
    """A small local table beside a large fact."""
    return join_dimension(fact, fact.sparkSession.createDataFrame(local), on)


def cached(frame: ps.DataFrame):
    """``with cached(frame) as held:`` keeps the rows until the block ends."""
    return frame.spark.cache()


def spread(frame: ps.DataFrame, partitions: int) -> ps.DataFrame:
    return frame.spark.repartition(partitions)


def gather(frame: ps.DataFrame, partitions: int) -> ps.DataFrame:
    return natively(frame, lambda df: df.repartition(partitions))


def assemble_features(df: DataFrame, columns, name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)
