"""Token counts of documents in flat token files that have no index.

A flat file is a stream of fixed-width ids in which an end id closes each document; blocks of it
are cut anywhere. Each block is searched for the end id with one vectorised comparison. What a
block contributes (its tokens, its ends, its last end) is stitched to the blocks before it by a
prefix scan in two levels: inside groups of ``GROUP`` blocks, then over the groups' totals, so
even a file that holds a third of all blocks never meets in one task as a whole. A document may
span any number of blocks.

Defined cases: documents of no tokens count 0; tokens after the last end are a document with
``terminated`` false; an empty file has no documents. For ``write_flat``: null and empty texts have
no tokens, repeated rows and null ids are written as they are, and the end id never occurs inside
a text, as added tokens in a text are encoded like other text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import strings, text_of, written
from .tokens import byte_level

GROUP = 1024
BLOCK_TOKENS = 1 << 20
FLAT = "file string, block bigint, payload binary, first bigint, ids array<bigint>"


def write_flat(docs: DataFrame, vocabulary: str, end: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Flat token streams, one per task, in blocks ``(file, block, payload)``, and beside them the
    doc_ids in the order of their documents (``first``: number of the first)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = byte_level(vocabulary), f"part-{TaskContext.get().partitionId():06d}"
        kind, close = f"<u{width}", np.array([end], f"<u{width}")
        held, size, block, first = [], 0, 0, 0

        def row(values: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            names = ["file", "block", "payload", "first", "ids"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for text in strings(batch, "text"):
                tokens = encoder.plain(text).astype(kind)
                held += [tokens, close]
                size += len(tokens) + 1
                while size >= block_tokens:
                    stream = np.concatenate(held)
                    yield row([file, block, stream[:block_tokens].tobytes(), None, None])
                    held, size, block = [stream[block_tokens:]], size - block_tokens, block + 1
            if ids:
                yield row([file, None, None, first, ids])
            first += len(ids)
        if size:
            yield row([file, block, np.concatenate(held).tobytes(), None, None])

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return picked.mapInArrow(work, FLAT)


def read_flat(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks ``(file, block, payload)`` of flat binary files; each task reads its byte ranges only."""
    step = width * block_tokens
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select(
        F.col("path").alias("file"), "length",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / step))).alias("block"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for r in batch.to_pylist():
                store, name = fs.FileSystem.from_uri(r["file"])
                with store.open_input_file(name) as source:
                    data = source.read_at(min(step, r["length"] - r["block"] * step), r["block"] * step)
                arrays = [pa.array([r["file"]]), pa.array([r["block"]], pa.int64()), pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "payload"])

    return ranges.repartition("file", "block").mapInArrow(work, "file string, block bigint, payload binary")


def documents_in(blocks: DataFrame, end: int, width: int = 2) -> DataFrame:
    """``file, number, start, n_tokens, terminated`` of every document in ``blocks``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                tokens = np.frombuffer(one.column("payload")[0].as_buffer(), f"<u{width}")
                ends = np.flatnonzero(tokens == end)
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column("file"), one.column("block"), pa.array([len(tokens)], pa.int64()),
                        pa.array([len(ends)], pa.int64()), pa.array([ends[-1] if len(ends) else None], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["file", "block", "tokens", "found", "last", "ends"],
                )

    kinds = "file string, block bigint, tokens bigint, found bigint, last bigint, ends array<bigint>"
    found = written(blocks.select("file", "block", "payload").mapInArrow(search, kinds), "ends")
    group = F.floor(F.col("block") / GROUP).alias("group")
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    local = found.select("file", "block", group, "tokens", "found", "last")
    local = local.withColumns(
        {
            "base": F.coalesce(F.sum("tokens").over(inside), zero),
            "before": F.coalesce(F.sum("found").over(inside), zero),
        }
    )
    local = local.withColumn("last_end", F.col("base") + F.col("last"))
    local = local.withColumn("end_before", F.max("last_end").over(inside))
    totals = local.groupBy("file", "group").agg(
        F.sum("tokens").alias("tokens"), F.sum("found").alias("found"), F.max("last_end").alias("last_end")
    )
    over = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {
            "group_base": F.coalesce(F.sum("tokens").over(over), zero),
            "group_before": F.coalesce(F.sum("found").over(over), zero),
        }
    )
    totals = totals.withColumn("group_end", F.max(F.col("group_base") + F.col("last_end")).over(over))
    stitched = local.join(totals.select("file", "group", "group_base", "group_before", "group_end"), ["file", "group"])
    stitched = stitched.select(
        "file",
        "block",
        (F.col("group_base") + F.col("base")).alias("base"),
        (F.col("group_before") + F.col("before")).alias("before"),
        # Where the document that the block begins with has begun.
        (F.coalesce(F.col("group_base") + F.col("end_before"), F.col("group_end"), F.lit(-1)) + 1).alias("open"),
    )
    both = found.select("file", "block", "tokens", "found", "ends").join(stitched, ["file", "block"])
    ended = both.where("found > 0").select(
        "file", "base", "before", "open", "ends", F.posexplode("ends").alias("i", "end")
    )
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1) + 1)
    closed = ended.select(
        "file", (F.col("before") + F.col("i")).alias("number"), start.alias("start"),
        (F.col("base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"),
    )
    # The last block of a file may leave a document open.
    last = both.groupBy("file").agg(
        F.max(F.col("base") + F.col("tokens")).alias("size"), F.max(F.col("before") + F.col("found")).alias("number"),
        F.max(F.greatest("open", F.coalesce(F.col("base") + F.get("ends", F.col("found").cast("int") - 1) + 1, zero))).alias("start"),
    )
    rest = last.where("start < size").select(
        "file", "number", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated")
    )
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, vocabulary: str, end: int, width: int = 2) -> DataFrame:
    """Write ``docs`` as flat token streams and count each document's tokens from the streams."""
    flat = written(write_flat(docs, vocabulary, end, width), "flat-tokens")
    found = documents_in(flat.where("payload is not null"), end, width)
    order = flat.where("ids is not null").select("file", "first", F.posexplode("ids").alias("i", "doc_id"))
    order = order.select("file", (F.col("first") + F.col("i")).alias("number"), "doc_id")
    return order.join(found, ["file", "number"]).select("doc_id", "n_tokens", "file", "number", "start")
