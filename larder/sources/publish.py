"""Results that appear in one step: a reader sees the old rows or the new ones, never part of either.

A publication writes a version beside the ones before it, checks what was written, and only then replaces the
manifest that names the current folders, by one rename. A job that fails anywhere before that leaves
the manifest and every folder it names as they were; what the failed job wrote is swept by a later one.

``<location>/_manifest.json`` holds the folders of each frame; ``<location>/versions/<id>`` the rows.
Earlier versions stay for readers that are still running, ``keep`` of them. One publisher at a time: of two
at once the later rename wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

from ..errors import WriteError
from ..session import union_all
from .writers import write_sink

MANIFEST = "_manifest.json"


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    at, files = _files(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """The file holds the old text or the new one at any moment: written aside, then renamed over it."""
    aside, files = _files(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(path), over)


def manifest(spark: SparkSession, location: str) -> dict:
    text = _read_text(spark, f"{location}/{MANIFEST}")
    return json.loads(text) if text else {"number": 0, "frames": {}, "history": []}


def publish_frames(frames: dict[str, DataFrame], location: str, *, check: Callable[[dict[str, DataFrame]], None] | None = None,
                   kind: str = "parquet", partition_by=(), keep: int = 1, **options) -> dict[str, str]:
    """Publish several frames together; returns the folder of each.

    ``check`` gets the frames as they were written and raises to refuse them.
    """
    return _publish(frames, location, check, kind, list(partition_by), keep, False, options)


def publish(df: DataFrame, location: str, **how) -> str:
    """Publish one frame; takes what ``publish_frames`` takes."""
    check = how.pop("check", None)
    both = None if check is None else lambda frames: check(frames["rows"])
    return publish_frames({"rows": df}, location, check=both, **how)["rows"]


def publish_partitions(df: DataFrame, location: str, partition_by, *, check: Callable[[DataFrame], None] | None = None,
                       kind: str = "parquet", keep: int = 1, **options) -> str:
    """Publish new rows for the partitions the frame holds; the others stay where they lie, unread and unwritten."""
    both = None if check is None else lambda frames: check(frames["rows"])
    return _publish({"rows": df}, location, both, kind, list(partition_by), keep, True, options)["rows"]


def _publish(frames, location, check, kind, partition_by, keep, partly, options) -> dict[str, str]:
    spark = next(iter(frames.values())).sparkSession
    before = manifest(spark, location)
    version = f"{before['number'] + 1:06d}-{uuid.uuid4().hex[:8]}"
    new = {"number": before["number"] + 1, "frames": dict(before["frames"]) if partly else {}, "history": before["history"]}
    for name, df in frames.items():
        folder = f"versions/{version}/{name}"
        write_sink(df, kind, f"{location}/{folder}", mode="errorifexists", partition_by=partition_by, **options)
        entry = {"kind": kind, "schema": df.schema.json(), "partition_by": partition_by, "folders": {folder: None}}
        if partly and name in before["frames"]:
            entry["folders"] = _merged(spark, location, before["frames"][name], folder, partition_by)
        new["frames"][name] = entry
    if check is not None:
        check({name: _frame(spark, location, {**new["frames"][name], "folders": {f"versions/{version}/{name}": None}}) for name in frames})
    used = {folder.split("/")[1] for entry in new["frames"].values() for folder in entry["folders"]}
    new["history"] = ([*before["history"], sorted(_versions(before))] if before["frames"] else [])[-keep:] if keep else []
    _replace_text(spark, f"{location}/{MANIFEST}", json.dumps(new))
    _sweep(spark, location, used | {v for versions in new["history"] for v in versions})
    return {name: f"{location}/versions/{version}/{name}" for name in frames}


def _versions(known: dict) -> set[str]:
    return {folder.split("/")[1] for entry in known["frames"].values() for folder in entry["folders"]}


def _merged(spark, location, entry, folder, partition_by) -> dict[str, list[str] | None]:
    """Folders of a frame once ``folder`` has taken over the partitions it holds."""
    if entry["partition_by"] != partition_by:
        raise WriteError(f"{location} is partitioned by {entry['partition_by']}, not by {partition_by}")
    taken = set(_partitions(spark, f"{location}/{folder}", len(partition_by)))
    folders = {}
    for old, listed in entry["folders"].items():
        listed = _partitions(spark, f"{location}/{old}", len(partition_by)) if listed is None else listed
        if left := [p for p in listed if p not in taken]:
            folders[old] = left
    return folders | ({folder: None} if taken else {})


def _partitions(spark, folder: str, depth: int, prefix: str = "") -> list[str]:
    """The partition directories below a folder, as ``year=2024/month=1``."""
    at, files = _files(spark, f"{folder}/{prefix}" if prefix else folder)
    found = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory() and not s.getPath().getName().startswith("_")]
    paths = [f"{prefix}/{name}" if prefix else name for name in sorted(found)]
    if depth == 1:
        return paths
    return [p for path in paths for p in _partitions(spark, folder, depth - 1, path)]


def _frame(spark, location, entry) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(entry["schema"]))
    reader = spark.read.schema(schema)
    if entry["kind"] == "csv":
        reader = reader.option("header", True)
    parts = []
    for folder, listed in entry["folders"].items():
        base = f"{location}/{folder}"
        paths = [base] if listed is None else [f"{base}/{p}" for p in listed]
        parts.append(reader.option("basePath", base).format(entry["kind"]).load(paths).select(*schema.fieldNames()))
    return union_all(parts) if parts else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, location: str, name: str = "rows") -> DataFrame:
    """The rows that are current when the frame is made, however many jobs publish while it is read."""
    known = manifest(spark, location)["frames"]
    if name not in known:
        raise WriteError(f"nothing is published as {name!r} at {location}")
    return _frame(spark, location, known[name])


def _sweep(spark, location, used: set[str]) -> None:
    """Remove versions that neither the manifest nor its history names and that are older than the newest of them.

    A job that is writing right now has a number beyond the manifest's, so its folder is left alone.
    """
    at, files = _files(spark, f"{location}/versions")
    newest = max(used, default="")[:6]
    for status in files.listStatus(at):
        name = status.getPath().getName()
        if name not in used and name[:6] < newest:
            with suppress(OSError):
                files.delete(status.getPath(), True)
