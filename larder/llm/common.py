"""What the operators share: tables, batches, scratch frames and counted broadcasts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, scratch_path

# Rows of one Arrow batch. Texts are long, so far fewer than for narrow rows.
ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Settings for rows that hold whole texts."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Written:
    """A frame written once below the shared folder; ``drop`` gives the space back."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{scratch_path(self.spark, name)}/rows"
        df.write.parquet(self.path)
        self.frame = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Only once nothing lazy reads the frame any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    return Written(df, name).frame


def text_of(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_results(docs: DataFrame, added: dict[str, Column]) -> DataFrame:
    """Add columns; an input column of the same name (in any case) gives way."""
    names = {name.lower() for name in added}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    return docs.select(*kept, *[column.alias(name) for name, column in added.items()])


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [value or "" for value in batch.column(name).to_pylist()]
