"""Delivery of results. Writes overwrite by default, so a job can simply run again."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..errors import WriteError
from ..operators.tuning import even_files, kept
from ..session import scratch_path
from .readers import FILE_KINDS

SAVE_MODES = ("overwrite", "append", "ignore", "errorifexists")


def write_sink(df: DataFrame, kind: str, location: str, *, mode: str = "overwrite", partition_by=(),
               compression: str | None = None, files: int | None = None,
               max_records: int | None = None, **options) -> str:
    """Write a frame to a file format, a catalog ``table`` or ``jdbc``.

    ``partition_by`` makes one directory per value; rows are first rebalanced by those
    columns, so each value gets few files and a heavy value still several writers.
    ``files`` caps the number of files of a result known to be small; what computes it keeps its own tasks.
    """
    if kind == "jdbc":
        from .jdbc import write_table

        write_table(df, table=location, mode=mode, **options)
        return location
    if kind != "table" and kind not in FILE_KINDS:
        raise WriteError(f"unknown sink {kind!r}; use one of {', '.join(FILE_KINDS)}, table, jdbc")
    if mode not in SAVE_MODES:
        raise WriteError(f"unknown save mode {mode!r}; use one of {', '.join(SAVE_MODES)}")
    if kind == "csv":
        options.setdefault("header", True)
    if compression:
        options["compression"] = compression
    if max_records:
        options["maxRecordsPerFile"] = max_records
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = even_files(df, *partition_by)
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        if kind == "table":
            writer.format("parquet").saveAsTable(location)
        else:
            writer.format(kind).save(location)
    except AnalysisException as problem:
        raise WriteError(f"{location}: {problem}") from problem
    return location


LEAST_FILE, MOST_FILE = 64 << 20, 1 << 30
# Rows that are written once to learn the size of a row in its format.
SAMPLE_ROWS = 100_000
MOST_WRITES = 4


def file_sizes(spark: SparkSession, location: str) -> list[int]:
    """Bytes of every data file directly below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return [s.getLen() for s in listed if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def write_sized(df: DataFrame, kind: str, location: str, *, least: int = LEAST_FILE, most: int = MOST_FILE,
                sample_rows: int = SAMPLE_ROWS, **options) -> list[int]:
    """Write files of ``least`` to ``most`` bytes each; returns their sizes. Less than ``least`` in all is one file.

    A written sample gives the bytes of a row; rows are dealt evenly over so many files that each comes
    to the geometric mean of the bounds. Rows of large files may pack better or worse than the sample's, so
    the files are looked at, and written again by their true size while any lies outside (``MOST_WRITES`` in all). The frame is computed
    for its count, its sample and each write: hand in a stored one where that is dear.
    """
    if not 0 < 2 * least <= most:
        raise WriteError("the largest file must have room for two of the least")
    spark = df.sparkSession
    rows = df.count()
    share = min(1.0, 1.2 * sample_rows / max(rows, 1))
    sample = f"{scratch_path(spark, 'sample')}/rows"
    write_sink(df.sample(share, seed=1) if share < 1 else df, kind, sample, **options)
    expected = sum(file_sizes(spark, sample)) / share
    target = math.sqrt(least * most)
    for _ in range(MOST_WRITES):
        files = max(1, min(round(expected / target), int(expected // least) or 1))
        write_sink(df, kind, location, files=files, **options)
        sizes = file_sizes(spark, location)
        if len(sizes) <= 1 and sum(sizes) <= most or all(least <= size <= most for size in sizes):
            break
        expected = sum(sizes)
    return sizes


def export_partitions(df: DataFrame, location: str, partition_by) -> str:
    """Replace only the partitions the frame holds; the others stay as they are."""
    return write_sink(df, "parquet", location, partition_by=partition_by, partitionOverwriteMode="dynamic")


def deliver_formats(df: DataFrame, base: str, formats) -> dict[str, str]:
    """The same result in several formats, computed once.

    Holds the result while it is written, so it is meant for reports. A large data set is
    better written as Parquet first and converted from there.
    """
    with kept(df) as held:
        return {kind: write_sink(held, kind, f"{base}/{kind}") for kind in formats}


def deliver_frames(frames: dict[str, DataFrame], base: str, kind: str = "parquet") -> dict[str, str]:
    """Several results, each below its own name."""
    return {name: write_sink(df, kind, f"{base}/{name}") for name, df in frames.items()}
