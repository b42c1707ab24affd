"""Near-duplicate embeddings by sorted projection passes.

Vectors are compared if their labels (and lengths) are equal; two are linked if their cosine, in
double precision, is at least ``least``. Equal vectors of one label are one class from the start.

1. Every vector gets ``BITS`` signs of random projections for each pass, concatenated to a number.
2. In each pass the vectors of a label are sorted by that number and cut into blocks of ``BLOCK``;
   every vector is compared with its block and with the first ``WINDOW`` of the next one, so with at
   least ``WINDOW`` neighbours on either side.
3. Where more than ``WINDOW`` vectors agree in the leading bits (as many as an even spread would need
   to leave ``WINDOW``), the window alone would cut their neighbourhood short: such a run is compared
   as a whole, in pairs of blocks. So the window bounds a task, never the partners of a vector.
4. Pairs found are united across passes: a pair counts in the first pass in which it meets (what
   met earlier is known from the sorted places alone), so links are counted by vector and block without
   writing pairs, and one edge to a block's least member for each vector is enough for the components.

A linked pair at the very bound shares the leading bits in one pass with probability
``(1 - acos(least) / pi) ** bits``; there are as many passes as leave a chance of ``MISSED`` that it
shares them in none. Both numbers follow from the size of the largest label.

Defined cases: a null label, a null or empty vector, a zero vector, and null or non-finite components are
linked with nothing; a row without vec_id is linked with nothing, too, and kept; rows of equal vec_id, label
and vector are one vector; an id with different vectors is one vector for each, and all of them
share the name; other columns are ignored. The rows of a long run of vectors that are alike but not equal
are compared in bounded blocks, but all of them: time goes with the square of such a run.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import MAX_GROUP_ROWS, number_rows
from ..session import union_all
from .common import Written, written
from .minhash import components

LEAST = 0.98
BITS = 48
WINDOW, BLOCK = 128, 512
MISSED = 1e-9
# Passes whose copies of the vectors are on disk at the same time.
PASSES_AT_ONCE = 4
SEED = 12
RUN = ("pass", "label", "size")


def passes_for(largest: int, least: float, window: int = WINDOW, missed: float = MISSED) -> tuple[int, int]:
    """Leading bits that leave ``window`` of ``largest`` vectors, and the passes that find all links with them."""
    bits = min(BITS, max(0, math.ceil(math.log2(max(largest, 1) / window))))
    if not bits:
        return 0, 1  # one run, compared as a whole
    shared = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log1p(-shared))


def keyed(rows: DataFrame) -> DataFrame:
    """``vec_id, label, size, vector, key``: doubles in bytes; a key that equal vectors of one label share, or
    null if the row can have no link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, sizes, keys = [], [], []
            columns = [batch.column(name).to_pylist() for name in ("vec_id", "label", "embedding")]
            for vec_id, label, values in zip(*columns, strict=True):
                # Zero of either sign is one value.
                vector = np.array([math.nan if v is None else v for v in values or ()], np.float64) + 0.0
                scale = np.abs(vector).max() if len(vector) else 0.0
                able = vec_id is not None and label is not None and np.isfinite(scale) and scale > 0
                data.append(vector.tobytes())
                sizes.append(len(vector))
                keys.append(xxhash.xxh3_128_digest(b"%d:" % label + data[-1]) if able else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()),
                 pa.array(data, pa.binary()), pa.array(keys, pa.binary())],
                names=["vec_id", "label", "size", "vector", "key"],
            )

    picked = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return picked.mapInArrow(work, "vec_id bigint, label bigint, size int, vector binary, key binary")


def unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    grid = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    grid = grid / np.abs(grid).max(axis=1, keepdims=True)
    return grid / np.sqrt((grid * grid).sum(axis=1, keepdims=True))


def hashed(nodes: DataFrame, passes: int) -> DataFrame:
    """``node, label, size, hashes``: one number of ``BITS`` signs for each pass."""

    @F.pandas_udf("array<bigint>")
    def signs(vectors: pd.Series) -> pd.Series:
        lengths, out = vectors.map(len).to_numpy(), [None] * len(vectors)
        for size in np.unique(lengths):
            draw = np.random.default_rng((SEED, int(size)))
            at, found = np.flatnonzero(lengths == size), []
            grid = unit(vectors.iloc[at])
            for _ in range(passes):
                bits = grid @ draw.standard_normal((size // 8, BITS)) > 0
                found.append(bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)))
            for row, numbers in zip(at, np.stack(found, 1), strict=True):
                out[row] = numbers
        return pd.Series(out, dtype=object)

    return nodes.select("node", "label", "size", signs("vector").alias("hashes"))


def compare(
    at_pass: int, group: pd.DataFrame, tiles: bool, leading: int, least: float, window: int, block: int
) -> pd.DataFrame:
    """Links of the rows of one seat: hosts with hosts and guests, or, for tiles, hosts with guests only.

    Returns for each linked row its node, the least node it is joined with here, and the number of rows
    in the classes it is linked with.
    """
    host = group["host"].to_numpy()
    group = pd.concat([group[host], group[~host]])
    count, node = int(host.sum()), group["node"].to_numpy()
    grid = unit(group["vector"])
    hits = grid[:count] @ (grid[count:] if tiles else grid).T >= least
    if not tiles:
        hits[:, :count] &= np.triu(np.ones((count, count), bool), 1)
    i, j = np.nonzero(hits)
    j = j + count if tiles else j
    places, hashes = np.stack(group["places"]), np.stack(group["hashes"]) >> (BITS - leading)
    fresh = np.ones(len(i), bool)
    for earlier in range(at_pass + tiles):
        here, at = places[:, earlier] // block, places[:, earlier] % block
        step = here[j] - here[i]
        met = (step == 0) | (step == 1) & (at[j] < window) | (step == -1) & (at[i] < window)
        if earlier < at_pass:
            met |= hashes[i, earlier] == hashes[j, earlier]
        fresh &= ~met
    i, j = i[fresh], j[fresh]
    copies, root = group["copies"].to_numpy(), np.arange(len(node))
    links = np.zeros(len(node), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    while True:  # the least row joined with each row
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = links > 0
    return pd.DataFrame({"node": node[some], "root": node[root[some]], "links": links[some]})


def meeting(*how) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return compare(int(key[0]), group, *how)

    return meet


def large_runs(places: DataFrame, leading: int, window: int, block: int) -> DataFrame:
    """``pass, label, size, prefix, first, last``: blocks of the runs that are longer than the window."""
    runs = places.withColumn("prefix", F.shiftrightunsigned("hash", BITS - leading)).groupBy(*RUN, "prefix")
    at = F.expr(f"place div {block}")
    sizes = runs.agg(F.count("*").alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"))
    return sizes.where(f"rows > {window} and last > first").drop("rows")


def seat(one: Column, two: Column, host: bool) -> Column:
    return F.struct(one.alias("one"), two.alias("two"), F.lit(host).alias("host"))


def in_windows(rows: DataFrame, window: int, block: int) -> DataFrame:
    """Each row as host of its block, and those at its head as guests of the block before."""
    at = F.expr(f"place div {block}")
    guest = F.when((F.col("place") % block < window) & (at > 0), seat(at - 1, at - 1, False))
    seats = F.explode(F.array_compact(F.array(seat(at, at, True), guest)))
    return rows.withColumn("seat", seats).select(*rows.columns, "seat.*").drop("place")


def in_runs(places: DataFrame, runs: DataFrame, leading: int, block: int) -> DataFrame:
    """Each row of a long run as host towards each later block of the run and as guest of each earlier one."""
    at, none = F.expr(f"place div {block}"), F.array()
    later = F.transform(F.sequence(at + 1, F.col("last")), lambda b: seat(at, b, True))
    earlier = F.transform(F.sequence(F.col("first"), at - 1), lambda b: seat(b, at, False))
    seats = F.concat(
        F.when(at < F.col("last"), later).otherwise(none), F.when(at > F.col("first"), earlier).otherwise(none)
    )
    known = places.withColumn("prefix", F.shiftrightunsigned("hash", BITS - leading)).join(runs, [*RUN, "prefix"])
    return known.withColumn("seat", F.explode(seats)).select("node", "pass", "prefix", "seat.*")


RESULT = "node bigint, root bigint, links bigint"


def found_links(
    nodes: DataFrame, least: float = LEAST, missed: float = MISSED, window: int = WINDOW, block: int = BLOCK,
    limit: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``node, root, links`` of every block in which ``nodes (node, label, size, vector, copies)`` have links."""
    if window > block:
        raise ValueError("a window reaches into the next block only")
    largest = nodes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    leading, passes = passes_for(largest, least, window, missed)
    long = hashed(nodes, passes).select("node", "label", "size", F.posexplode("hashes").alias("pass", "hash"))
    places = number_rows(long, ["pass", "label", "size"], ["hash", "node"], "place", limit=limit)
    places = Written(places.withColumn("place", F.col("place") - 1), "places")
    listed = F.sort_array(F.collect_list(F.struct("pass", "place", "hash")))
    known = places.frame.groupBy("node").agg(listed.alias("seen"))
    known = known.select("node", F.col("seen.place").alias("places"), F.col("seen.hash").alias("hashes"))
    base = Written(nodes.join(known, "node"), "seated")
    runs = Written(large_runs(places.frame, leading, window, block), "runs")
    found = []
    for start in range(0, passes, PASSES_AT_ONCE):
        these = F.sequence(F.lit(start), F.lit(min(start + PASSES_AT_ONCE, passes) - 1))
        here = places.frame.where(F.col("pass").between(start, start + PASSES_AT_ONCE - 1))
        rows = base.frame.withColumn("pass", F.explode(these)).withColumn("place", F.col("places")[F.col("pass")])
        seats = {False: in_windows(rows, window, block), True: in_runs(here, runs.frame, leading, block).join(base.frame, "node")}
        for tiles, frame in seats.items():
            grouped = frame.groupBy("pass", "label", "size", *["prefix"] * tiles, "one", "two")
            meet = meeting(tiles, leading, least, window, block)
            found.append(written(grouped.applyInPandas(meet, RESULT), "found"))
    for frame in (places, base, runs):
        frame.drop()
    return union_all(found)


def near_vectors(
    rows: DataFrame, least: float = LEAST, missed: float = MISSED, window: int = WINDOW, block: int = BLOCK,
    limit: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``rows (vec_id, embedding, label)``."""
    base = Written(keyed(rows).withColumn("row", F.monotonically_increasing_id()), "vectors")
    able = base.frame.where("key is not null")
    # The number of a class is that of its first row as written, so it is the same on every attempt.
    same = able.groupBy("key").agg(
        F.min("row").alias("node"), F.count_distinct("vec_id").alias("copies"), F.min("vec_id").alias("name"),
        F.first("label").alias("label"), F.first("size").alias("size"), F.first("vector").alias("vector"),
    )
    nodes = Written(same, "vector-classes")
    found = written(found_links(nodes.frame.drop("key", "name"), least, missed, window, block, limit), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    named = nodes.frame.select("key", "node", "copies", "name").join(joined, "node", "left").join(links, "node", "left")
    named = written(named.withColumn("component", F.coalesce("component", "node")), "named-vectors")
    names = named.groupBy("component").agg(F.min("name").alias("component_id"))
    facts = named.join(names, "component").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    linked = able.select("vec_id", "key").join(facts, "key").select("vec_id", "n_links", "component_id")
    alone = base.frame.where("key is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return written(linked.unionByName(alone).withColumn("kept", kept), "near-vectors")
