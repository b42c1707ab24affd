"""Pack documents into sequences of a fixed capacity by cutting-stock column generation.

A document's ids (with a closing id) are cut into full pieces of ``capacity`` and one shorter
piece. The lengths of all pieces, in units of ``unit`` ids, form a histogram of at most
``capacity / unit`` classes, whatever the input's size. A linear program over patterns (how many
pieces of each class share a sequence) finds the fewest sequences: its columns are generated by a
knapsack dynamic program on the dual prices. The solution is rounded down; what is left over, a
few pieces per class, is filled up longest first. Pieces are then ranked within their class by
Spark, ranks are dealt to patterns by arithmetic, and a piece's offset is the sum of the lengths
before it in its sequence.

A sequence is padded to ``capacity`` unless its length is a power of two.

Defined cases: a null or empty text is the closing id alone; repeated rows are packed once each;
rows without a doc_id are packed too; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import strings, text_of, written
from .tokens import byte_level

PIECES = "row bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, vocabulary: str, capacity: int, closing: int) -> DataFrame:
    """Every document cut into pieces, each with a number of its own (``row``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = byte_level(vocabulary), TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch, "text"), strict=True):
                ids = np.append(encoder.encode(text), np.uint32(closing)).astype("<u4")
                data = memoryview(ids.tobytes())
                for start in range(0, len(ids), capacity):
                    length = min(capacity, len(ids) - start)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (row, doc_id, start, length, crc, len(ids)), strict=True):
                        column.append(value)
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=PIECES.replace(" bigint", "").split(", "))

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return picked.mapInArrow(work, PIECES)


def best_pattern(prices: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Knapsack: the most valuable multiset of classes ``1..len(prices)`` of total size ``size``."""
    best, choice = np.zeros(size + 1), np.zeros(size + 1, int)
    for room in range(1, size + 1):
        most = min(room, len(prices))
        values = best[room - most : room][::-1] + prices[:most]
        take = int(values.argmax())
        if values[take] > best[room - 1] + 1e-12:
            best[room], choice[room] = values[take], take + 1
        else:
            best[room] = best[room - 1]
    found, room = np.zeros(len(prices), int), size
    while room > 0:
        if choice[room]:
            found[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[size]), found


def column_generation(
    demand: np.ndarray, size: int, gap: float = 5e-4, most_rounds: int = 5_000
) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each (fractions) so that all pieces fit the fewest sequences.

    Stops when no pattern is worth over ``1 + gap`` sequences at the dual prices, which bounds the
    distance from the optimum by that share. Demands get small random additions so that the
    simplex steps do not cycle among ties.
    """
    classes = np.flatnonzero(demand)
    m = len(classes)
    if not m:
        return []
    patterns = np.zeros((m, m))
    for i, c in enumerate(classes):
        patterns[i, i] = size // (c + 1)
    inverse = np.diag(1 / patterns.diagonal())
    wanted = demand[classes] + np.random.default_rng(11).uniform(0.05, 0.25, m)
    used = inverse @ wanted
    for _ in range(most_rounds):
        duals = inverse.sum(axis=0)
        prices = np.zeros(size)
        prices[classes] = duals
        value, found = best_pattern(prices, size)
        if value <= 1 + gap:
            break
        column = found[classes].astype(float)
        step = inverse @ column
        ratios = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratios.argmin())
        used -= ratios[leave] * step
        used[leave] = ratios[leave]
        inverse[leave] /= step[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(step[others], inverse[leave])
        patterns[leave] = column
    out = []
    for row, times in zip(patterns, used, strict=True):
        whole = np.zeros(len(demand), int)
        whole[classes] = np.rint(row).astype(int)
        out.append((whole, float(max(times, 0))))
    return out


def patterns_for(demand: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole patterns: counts by class, and how many sequences follow each. All demand is used up.

    ``demand[c]`` pieces have class ``c`` (``c + 1`` units). Classes that fill a sequence stand alone.
    """
    left, out = demand.astype(np.int64).copy(), Counter()
    if left[size - 1]:
        alone = np.zeros(size, int)
        alone[size - 1] = 1
        out[tuple(alone)] = int(left[size - 1])
        left[size - 1] = 0
    for pattern, times in column_generation(left, size):
        has = np.flatnonzero(pattern)
        times = int(min([np.floor(times + 1e-6), *(left[has] // pattern[has])]))
        if times > 0:
            out[tuple(pattern)] += times
            left -= times * pattern
    while left.any():  # longest first into one sequence after the other
        pattern, room = np.zeros(size, int), size
        for c in np.flatnonzero(left)[::-1]:
            take = min(int(left[c]), room // (c + 1))
            pattern[c] += take
            room -= take * (c + 1)
        has = np.flatnonzero(pattern)
        times = int((left[has] // pattern[has]).min())
        out[tuple(pattern)] += times
        left -= times * pattern
    return sorted(out.items(), reverse=True)


class Deal:
    """Where the piece of a class and rank goes: arithmetic on tables of bounded size."""

    SHIFT = 44

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        starts, each, firsts, slots = [], [], [], []
        rank: Counter = Counter()
        first = 0
        for pattern, times in patterns:
            slot = 0
            for c in np.flatnonzero(pattern)[::-1]:
                starts.append((int(c) << self.SHIFT) + rank[c])
                each.append(pattern[c])
                firsts.append(first)
                slots.append(slot)
                rank[c] += pattern[c] * times
                slot += pattern[c]
            first += times
        order = np.argsort(starts)
        self.starts, self.each, self.firsts, self.slots = (
            np.array(x, np.int64)[order] for x in (starts, each, firsts, slots)
        )

    def place(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (classes.astype(np.int64) << self.SHIFT) + ranks
        at = np.searchsorted(self.starts, keys, side="right") - 1
        within = keys - self.starts[at]
        return self.firsts[at] + within // self.each[at], self.slots[at] + within % self.each[at]


def packed(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, closing: int = 1, unit: int = 8, per_bucket: int = 200_000
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    size = capacity // unit
    cut = written(pieces(docs, vocabulary, capacity, closing), "pieces")
    cut = cut.withColumn("class", (F.ceil(F.col("length") / unit) - 1).cast("int"))
    histogram = cut.groupBy("class").count().collect()
    demand = np.zeros(size, np.int64)
    for r in histogram:
        demand[r["class"]] = r["count"]
    deal = cut.sparkSession.sparkContext.broadcast(Deal(patterns_for(demand, size)))

    # Ranks within a class without sorting a class in one task: by bucket, then the buckets' totals.
    buckets = max(1, -(-int(demand.sum()) // per_bucket))
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    totals = spread.groupBy("class", "bucket").count()
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("class", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("class", "bucket").orderBy(F.desc("length"), "doc_id", "start", "row")
    ranked = spread.withColumn("inside", F.row_number().over(inside) - 1).join(totals, ["class", "bucket"])

    @F.pandas_udf("sequence_id bigint, slot bigint")
    def place(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, slot = deal.value.place(classes.to_numpy(), ranks.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "slot": slot})

    placed = ranked.withColumn("at", place("class", F.col("inside") + F.col("before")))
    earlier = Window.partitionBy("at.sequence_id").orderBy("at.slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("bigint").alias("offset"),
    )


def padding(packed_pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``sequences, tokens, padding`` of a packing."""
    used = packed_pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    pad = F.when(power, 0).otherwise(capacity - F.col("used"))
    return used.agg(
        F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(pad).alias("padding")
    )
