"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs a later operator one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}

# Compressed input bytes one shuffle partition should stand for, and the number
# of partitions beyond which the driver's shuffle bookkeeping costs more than it saves.
BYTES_PER_SHUFFLE_PARTITION = 64 << 20
MOST_SHUFFLE_PARTITIONS = 20_000

# Sources without statistics (rows of this process, JDBC tables) claim about this much.
UNKNOWN_BYTES = 1 << 60


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Start (or join) a session with the settings this package expects.

    ``conf`` keys use ``__`` for dots, e.g. ``spark__driver__memory="20g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; for files it is the bytes on storage."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def read_bytes(df: DataFrame) -> int:
    """What the inputs of a frame hold by Catalyst's statistics: the most that computing it reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(sizes)


def size_shuffle(spark: SparkSession, *frames: DataFrame, most: int | None = None) -> int:
    """Set the shuffle width from the size of the inputs.

    The default of 200 would make partitions of half a terabyte on 100 TB; AQE
    merges small partitions but never splits an aggregation's large ones. Frames of
    unknown size leave the width as it is. ``most`` (default ``MOST_SHUFFLE_PARTITIONS``) bounds it.
    """
    sizes = [planned_bytes(f) for f in frames]
    if max(sizes) >= UNKNOWN_BYTES:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-sum(sizes) // BYTES_PER_SHUFFLE_PARTITION)
    width = min(max(wanted, spark.sparkContext.defaultParallelism), most or MOST_SHUFFLE_PARTITIONS)
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    return width


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local one only for local sessions."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/larder/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path)
    files.deleteOnExit(hadoop_path)
    return path


def stash(df: DataFrame, name: str = "stash") -> DataFrame:
    """Write a frame to shared storage once and go on from there.

    Cuts the lineage so that values fixed by a physical layout (slice numbers)
    stay the same when an executor is lost, and columns stay prunable.
    """
    path = f"{scratch_path(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
