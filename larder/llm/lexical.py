"""Ranked lexical search with hashed max-sketches.

Terms are the maximal runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. A
document scores, for an item, the sum over the item's terms of the term's weight times the term's
impact in the document (``Totals``).

* **Index.** One pass over the texts gives each its sketch, the document frequency of every term, and the
  totals. A sketch is ``ARRAYS`` arrays of coordinates; each term is hashed to one coordinate of each, and a
  coordinate keeps the greatest impact folded into it. Within one document the impact only rises with
  the term's frequency, so the frequency itself is kept, in one byte (255: that often or more), and is
  turned into the impact once the corpus totals are known. Each array has ``LOAD`` to ``2 * LOAD`` coordinates
  for each distinct term of the text, so sketches grow with the texts and all bounds stay equally tight: an
  absent term meets taken coordinates in all arrays with a probability below 0.7 %.
* **Bounds.** Items go through in blocks of ``ITEMS`` against all sketches: the least of a term's
  coordinates is never below its impact, so the weighted sum is an upper bound of the score.
* **Rescoring.** The best ``FIRST * top`` texts of each item by bound are scored exactly; the score of its
  ``top``-th document is a threshold. Texts are then rescored in the order of their bounds down to the
  threshold: all whose bound reaches it, and so every document that can be among the best.

Equal texts are one entry of the ranking until the end, where each brings its ``top`` smallest doc_ids.

Defined cases: a null or empty text has no terms and is never ranked; an item without terms, or without a
match, has no rows; null doc_ids stand behind all others of their score; repeated rows rank
one after the other; equal rows of items are one item, and rows of one item_id with different texts
are searched apart; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_dimension
from ..operators.windows import top_n
from .common import Written, strings, text_of, written
from .minhash import WordHashes, mixed

TOP = 50
# Items that are searched together; their distinct terms are sent to every task.
ITEMS = 256
# Coordinates of each array for a distinct term, and the least size of an array.
ARRAYS, LOAD, LEAST_SIZE = 4, 3, 64
# First candidates of an item, as a multiple of the documents wanted.
FIRST = 4
MOST = 255
# Terms a task counts before it passes them on.
MOST_TERMS_HELD = 500_000
KEY = ["k1", "k2"]

LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def key_of(text: Column) -> list[Column]:
    """128 bits of a text, as Spark computes them."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def sketch_of(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The greatest count at each coordinate of all arrays."""
    size = LEAST_SIZE
    while size < LOAD * len(hashes):
        size *= 2
    out = np.zeros(ARRAYS * size, np.uint8)
    counts = np.minimum(counts, MOST).astype(np.uint8)
    for array in range(ARRAYS):
        np.maximum.at(out, coordinates(hashes, size, array), counts)
    return out.tobytes()


def coordinates(hashes: np.ndarray, size: int, array: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(array)) & np.uint64(size - 1)).astype(np.int64) + array * size


class Totals(NamedTuple):
    """Documents with a term, and all their terms."""

    documents: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 50 + (50 * n * self.documents) // self.terms
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


ENTRY = "doc_id bigint, k1 bigint, k2 bigint, n bigint, sketch binary, term binary, df bigint"


class Index:
    """Sketches of all documents that have a term, the document frequencies, and the totals."""

    def __init__(self, docs: DataFrame):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, seen = WordHashes(), Counter()
            for batch in batches:
                ids, sketches, lengths, rows = [], [], [], []
                for row, text in enumerate(strings(batch, "text")):
                    terms = terms_of(text)
                    if not terms:
                        continue
                    counts = Counter(terms)
                    seen.update(counts.keys())
                    own = np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts))
                    sketches.append(sketch_of(own, np.fromiter(counts.values(), np.int64, len(counts))))
                    lengths.append(len(terms))
                    rows.append(row)
                taken = batch.select(["doc_id", *KEY]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(lengths, pa.int64()), pa.array(sketches, pa.binary()),
                     pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.int64())],
                    names=["doc_id", *KEY, "n", "sketch", "term", "df"],
                )
                if len(seen) > MOST_TERMS_HELD:
                    yield counted(seen)
                    seen.clear()
            yield counted(seen)

        def counted(seen: Counter) -> pa.RecordBatch:
            none = [pa.nulls(len(seen), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            arrays = [*none, pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *KEY, "n", "sketch", "term", "df"])

        picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
        self.texts = picked.select("*", *key_of(F.col("text")))
        self.stored = Written(self.texts.mapInArrow(work, ENTRY), "lexical-index")
        self.entries = self.stored.frame.where("term is null").drop("term", "df")
        self.terms = written(
            self.stored.frame.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "document-frequencies"
        )
        sums = self.entries.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.totals = Totals(*sums)


class Queries(NamedTuple):
    """One block of items: their terms, with the hash of each, and a weight for each term and item."""

    hashes: np.ndarray
    weights: np.ndarray
    places: dict[bytes, int]


def queries_of(texts: list[str], index: Index) -> Queries:
    """Only terms that some document has and that weigh something are kept."""
    items = [set(terms_of(text)) for text in texts]
    spark = index.entries.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted(set().union(*items))] or [(b"",)], "term binary")
    # The block's terms are the small side; the frequencies are read once and never collected.
    found = index.terms.join(F.broadcast(wanted), "term").collect()
    weights = {bytes(row.term): index.totals.weight(row.df) for row in found}
    places = {term: i for i, term in enumerate(sorted(t for t, w in weights.items() if w > 0))}
    hashes = WordHashes()
    grid = np.zeros((len(places), len(items)))
    for item, terms in enumerate(items):
        for term in terms & places.keys():
            grid[places[term], item] = weights[term]
    return Queries(np.array([hashes[t] for t in places], np.uint64), grid, places)


def bounds(entries: list[bytes], lengths: np.ndarray, queries: Queries, totals: Totals) -> np.ndarray:
    """An upper bound of the score of each entry (rows) for each item (columns); whole numbers."""
    sizes = np.array([len(e) // ARRAYS for e in entries])
    out = np.zeros((len(entries), queries.weights.shape[1]))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        grid = np.frombuffer(b"".join([entries[i] for i in rows]), np.uint8).reshape(len(rows), -1)
        least = grid[:, coordinates(queries.hashes, int(size), 0)]
        for array in range(1, ARRAYS):
            np.minimum(least, grid[:, coordinates(queries.hashes, int(size), array)], out=least)
        doc, term = np.nonzero(least)
        tf = least[doc, term].astype(np.int64)
        impacts = np.zeros(least.shape)
        # A coordinate at its greatest stands for any frequency, whose impact is below 1,000,000.
        impacts[doc, term] = np.where(tf == MOST, 1_000_000, totals.impact(tf, lengths[rows][doc]))
        out[rows] = impacts @ queries.weights
    return out


FOUND = "item int, bound bigint, k1 bigint, k2 bigint"


def found_batch(item: np.ndarray, bound: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(item, pa.int32()), pa.array(bound, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["item", "bound", *KEY])


def judged(batches: Iterator[pa.RecordBatch], queries: Queries, totals: Totals) -> Iterator[tuple]:
    for batch in batches:
        if len(batch):
            n, k1, k2 = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("n", *KEY))
            yield bounds(batch.column("sketch").to_pylist(), n, queries, totals), k1, k2


def best_by_bound(entries: DataFrame, queries: Queries, totals: Totals, top: int) -> DataFrame:
    """The ``top`` greatest bounds of each item in each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for new in judged(batches, queries, totals):
            new = (new[0], *(np.repeat(k[:, None], new[0].shape[1], 1) for k in new[1:]))
            best = new if best is None else tuple(np.concatenate(pair) for pair in zip(best, new, strict=True))
            if len(best[0]) > top:
                order = np.argpartition(-best[0], top - 1, axis=0)[:top]
                best = tuple(np.take_along_axis(part, order, 0) for part in best)
        if best is not None:
            row, item = np.nonzero(best[0])
            yield found_batch(item, *(part[row, item] for part in best))

    return entries.select("n", *KEY, "sketch").mapInArrow(work, FOUND)


def at_least(entries: DataFrame, queries: Queries, totals: Totals, thresholds: np.ndarray) -> DataFrame:
    """All bounds that reach their item's threshold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, k1, k2 in judged(batches, queries, totals):
            row, item = np.nonzero(found >= thresholds)
            yield found_batch(item, found[row, item], k1[row], k2[row])

    return entries.select("n", *KEY, "sketch").mapInArrow(work, FOUND)


def exact(found: DataFrame, texts: DataFrame, queries: Queries, totals: Totals) -> DataFrame:
    """``item, k1, k2, score`` of the pairs of item and text in ``found``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(name).to_pylist() for name in KEY]
            rows = []
            for text, items, k1, k2 in zip(strings(batch, "text"), batch.column("items").to_pylist(), *keys, strict=True):
                terms = terms_of(text)
                counts = {queries.places[t]: c for t, c in Counter(terms).items() if t in queries.places}
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                impacts = totals.impact(tf, np.int64(len(terms)))
                scores = impacts @ queries.weights[np.fromiter(counts, np.int64, len(counts))].astype(np.int64)
                rows += [(item, k1, k2, int(scores[item])) for item in items if scores[item] > 0]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", *KEY, "score"])

    # At most ITEMS numbers for a text.
    wanted = Written(found.groupBy(*KEY).agg(F.collect_set("item").alias("items")), "wanted-texts")
    met = join_dimension(texts.select(*KEY, "text"), wanted.frame, KEY)
    once = met.groupBy(*KEY).agg(F.first("text").alias("text"), F.first("items").alias("items"))
    scored = written(once.mapInArrow(work, "item int, k1 bigint, k2 bigint, score bigint"), "scores")
    wanted.drop()
    return scored


def ranked(scores: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    """``item, doc_id, score, rank`` of the best documents; a text brings its ``top`` smallest doc_ids."""
    keys = written(scores.select(*KEY).distinct(), "scored-texts")
    ids = join_dimension(entries.select(*KEY, "doc_id"), keys, KEY).withColumn("unnamed", F.col("doc_id").isNull())
    ids = top_n(ids, KEY, ["unnamed", "doc_id"], top, "nth").drop("nth")
    return top_n(scores.join(ids, KEY), "item", ["score desc", "unnamed", "doc_id"], top, "rank").drop("unnamed", *KEY)


def search_block(texts: list[str], index: Index, top: int) -> DataFrame:
    """``item`` (place in ``texts``), ``doc_id, score, rank``."""
    queries = queries_of(texts, index)
    firsts = best_by_bound(index.entries, queries, index.totals, FIRST * top)
    firsts = top_n(written(firsts, "first-bounds").distinct(), "item", ["bound desc", *KEY], FIRST * top, "nth")
    first = ranked(exact(firsts, index.texts, queries, index.totals), index.entries, top)
    reached = first.where(F.col("rank") == top).select("item", "score").collect()
    thresholds = np.ones(len(texts))
    for row in reached:
        thresholds[row.item] = row.score
    found = written(at_least(index.entries, queries, index.totals, thresholds), "bounds")
    return ranked(exact(found, index.texts, queries, index.totals), index.entries, top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best of ``docs (doc_id, text)`` for each of ``items (item_id, text)``."""
    spark = docs.sparkSession
    index = Index(docs)
    each = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text")).distinct()
    each = written(each.withColumn("number", F.monotonically_increasing_id()), "items")
    result = None
    for block in item_blocks(each):
        names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(block)], "item int, item_id bigint")
        found = search_block([row.text for row in block], index, top).join(F.broadcast(names), "item")
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return result


def item_blocks(items: DataFrame) -> Iterator[list]:
    """The items, ``ITEMS`` at a time, in the order of their numbers."""
    last = -1
    while block := items.where(F.col("number") > last).orderBy("number").limit(ITEMS).collect():
        yield block
        last = block[-1].number
