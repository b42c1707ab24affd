"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A document is the set of its distinct shingles of ``words`` words (words are
``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer words the whole sequence is its only
shingle; without words the set is empty and linked with nothing). Documents are linked if
``100 * intersection >= percent * union``; a component is named after its smallest doc_id.

1. Each set is sketched by rounds of hashed bin placement: round ``i < t`` throws every element
   into a random bin, round ``t + j`` throws all of them into bin ``j``, and the smallest value
   stays. The value's round is its leading part, so earlier rounds win, every bin is filled after
   ``2t`` rounds, and two sketches agree in a bin with probability equal to the similarity.
2. Equal sets collapse to one representative before anything is grouped.
3. ``bands`` bands of ``rows`` coordinates make buckets. At similarity 0.8 and 32 bands of 4 a
   pair shares no bucket with probability 5e-8.
4. Buckets are verified on the full sets in rounds that grow (``ROUNDS``). In each, every member of
   a bucket meets one random member of it, unless the rounds before joined the two already; then the
   components found are contracted. Last come the pairs of small buckets that are still apart. So
   edges stay near the number of documents, however large and dense a group of copies is.
5. Members of buckets of over ``small`` members that stay outside the largest component of their
   family are compared with the whole family in blocks of bounded size, so no link is lost and no
   pairs are written out.

Elements are 64-bit hashes of shingles. Rows without a doc_id are linked with nothing and kept.
Repeated rows get the same answer each. Nodes are sets, not ids: rows with equal ids and different
texts are each judged by their own text, and a component has the smallest doc_id of its rows as its name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written, strings, text_of, written

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)
ELEMENT_BYTES = 8
MOST_WORDS_HELD = 500_000
# Ids that may be copied to every executor: 8 MB of numbers.
MOST_COPIED_IDS = 1_000_000


class WordHashes(dict):
    """Word to 64-bit hash; forgets everything when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS_HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    ids = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    if not len(ids):
        return ids
    width = min(words, len(ids))
    count = len(ids) - width + 1
    folded = np.full(count, width, np.uint64)
    for i in range(width):
        folded = mixed(folded * ODD + ids[i : i + count])
    return np.unique(folded >> np.uint64(64 - 8 * ELEMENT_BYTES))


def packed(elements: np.ndarray) -> bytes:
    return elements.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, ELEMENT_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :ELEMENT_BYTES] = raw
    return out.view("<u8").ravel()


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates for each non-empty set."""
    lengths = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    empty = np.uint64(2**64 - 1)
    out = np.full(len(sets) * size, empty, np.uint64)
    for turn in range(2 * size):
        if not len(elements):
            break
        value = mixed(elements * ODD + np.uint64(turn + 1))
        if turn < size:
            # Coordinate from the high bits, value from the low ones.
            bins = ((value >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        else:
            bins = np.full(len(value), turn - size, np.uint64)
        value = (np.uint64(turn) << np.uint64(48)) | (mixed(value) >> np.uint64(16))
        np.minimum.at(out, owner * size + bins.astype(np.int64), value)
        full = (out.reshape(-1, size) != empty).all(axis=1)
        open_ = ~full[owner]
        elements, owner = elements[open_], owner[open_]
    return out.reshape(-1, size)


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    folded = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(coordinates), bands)).copy()
    for r in range(rows):
        folded = mixed(folded * ODD + coordinates[:, r::rows][:, :bands])
    return folded.view(np.int64)


SIGNED = "doc_id bigint, k1 bigint, k2 bigint, n_shingles bigint, set_key binary, elements binary, bands array<bigint>"
# 128 bits of a text, as Spark computes them; with the doc_id they tell rows apart.
TEXT_KEY = ["k1", "k2"]


def with_text_key(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)})


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per document its set, a key that equal sets share, and its bucket keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(text, words, hashes) for text in strings(batch, "text")]
            some = [s for s in sets if len(s)]
            keys = band_keys(sketches(some, bands * rows), bands, rows)
            data = [packed(s) if len(s) else None for s in sets]
            sizes = np.array([bands if len(s) else 0 for s in sets], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("doc_id", *TEXT_KEY)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d and xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                    pa.array(data, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int64())),
                ],
                names=["doc_id", *TEXT_KEY, "n_shingles", "set_key", "elements", "bands"],
            )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return with_text_key(picked).select("doc_id", "text", *TEXT_KEY).mapInArrow(work, SIGNED)


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if percent * max(len(one), len(two)) > 100 * min(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b, ...)`` whose full sets are similar enough; ``sets`` has one row for each node, its doc_id."""

    @F.pandas_udf("boolean")
    def similar(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([linked(unpacked(x), unpacked(y), percent) for x, y in zip(one, two, strict=True)], dtype=bool)

    first = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("elements_a"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("elements_b"))
    return pairs.join(first, "a").join(second, "b").where(similar("elements_a", "elements_b")).select(*pairs.columns)


def is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` only, and no ``v`` is a ``u``: then each ``v`` is the name of its component."""
    rows, ends = edges.agg(F.count("*"), F.count_distinct("u")).first()
    return rows == ends and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


# Edges up to this number, some megabytes whatever the table, are joined by one task instead of in many small steps.
FEW_EDGES = 100_000


def joined(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of a counted, small number of edges ``(u, v)``, by union-find in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(node: int) -> int:
            path = []
            while (up := root.setdefault(node, node)) != node:
                path.append(node)
                node = up
            for below in path:
                root[below] = node
            return node

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                one, two = find(u), find(v)
                root[max(one, two)] = min(one, two)
        nodes = list(root)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], names=["node", "component"]
        )

    return edges.select("u", "v").coalesce(1).mapInArrow(work, "node bigint, component bigint")


def components(edges: DataFrame, name: str, few: int = FEW_EDGES) -> DataFrame:
    """``(node, component)`` of every node on an edge ``(a, b)``; the smallest node names a component.

    Alternates large-star and small-star steps: each is a minimum per node and a join back, so
    no neighbourhood is ever gathered. Up to ``few`` edges, counted before, are joined in one step.
    """
    now = Written(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    if now.frame.count() <= few:
        return written(joined(now.frame), name)
    while not is_star_forest(now.frame):
        both = now.frame.unionByName(now.frame.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = Written(small, name)
        now.drop()
        now = after
    own = now.frame.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.frame.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def with_component(frame: DataFrame, known: DataFrame | None, node: str, name: str) -> DataFrame:
    """Add the component of a node; a node that no round has linked is its own."""
    if known is None:
        return frame.withColumn(name, F.col(node))
    joined = frame.join(known.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left")
    return joined.withColumn(name, F.coalesce(name, node))


def grown(known: DataFrame | None, pairs: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``known (node, component)`` after the links among ``pairs (a, b, component_a, component_b)``."""
    links = verify(pairs).select(F.col("component_a").alias("a"), F.col("component_b").alias("b")).distinct()
    step = components(written(links, f"{name}-links"), name)
    if known is None:
        return written(step, f"{name}-known")
    to = step.select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = known.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = step.join(known, "node", "left_anti").select("node", "component")
    return written(moved.unionByName(new), f"{name}-known")


def between_components(links: DataFrame) -> DataFrame:
    """Links ``(a, b)`` whose ends are components already."""
    return links.select("a", "b", F.col("a").alias("component_a"), F.col("b").alias("component_b"))


# Buckets are dealt to this many parts; each round takes more of them than the one before.
PARTS = 32
ROUNDS = ((0, 1), (1, 6), (6, PARTS))


def stars_grown(
    known: DataFrame | None, stars: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """``known`` after the links among ``stars (node, pivot)`` whose ends it does not join yet."""
    met = stars.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    met = with_component(with_component(met, known, "a", "component_a"), known, "b", "component_b")
    met = met.where("component_a != component_b").distinct()
    return grown(known, written(met, f"{name}-stars"), verify, name)


def families_of(many: DataFrame) -> DataFrame:
    """``(node, component)`` of buckets that share members, unverified: by the pivot of each node's largest bucket
    first, which joins nearly all, then by the others."""
    stars = many.where("node != pivot")
    largest = F.max_by("pivot", F.struct("members", "bucket")).alias("pivot")
    known = None
    for some in (stars.groupBy("node").agg(largest), stars):
        known = stars_grown(known, some, lambda pairs: pairs, "families")
    return known


def bucket_links(
    shared: DataFrame, small: int, alike: str, verify: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """``(node, component)`` by all links of members with pivots, and of members of small buckets with each other.

    ``alike`` is a condition on the columns of ``shared`` of both sides, the second's ending in ``_b``.
    """
    known, part = None, F.pmod(F.xxhash64("bucket"), F.lit(PARTS))
    for first, last in ROUNDS:
        known = stars_grown(known, shared.where((F.col("node") != F.col("pivot")) & part.between(first, last - 1)), verify, name)
    few = with_component(shared.where(f"members between 3 and {small}"), known, "node", "component")
    other = few.toDF(*[f"{c}_b" for c in few.columns])
    met = few.join(other, F.expr(f"bucket = bucket_b and node < node_b and component != component_b and ({alike})"))
    pairs = met.select(
        F.col("node").alias("a"), F.col("node_b").alias("b"),
        F.col("component").alias("component_a"), F.col("component_b"),
    ).distinct()
    return grown(known, written(pairs, f"{name}-pairs"), verify, name)


BLOCK_MEMBERS, BLOCK_RESTS, VOCABULARY_SLICE = 512, 128, 8192


def block_links(rest: list[np.ndarray], members: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``rest`` (rows) are linked with which of ``members`` (columns)."""
    flat = [np.concatenate(rest), np.concatenate(members)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    lengths = [np.array([len(s) for s in group]) for group in (rest, members)]
    owners = [np.repeat(np.arange(len(n)), n) for n in lengths]
    places = []
    for elements, owner in zip(flat, owners, strict=True):
        at = np.searchsorted(shared, elements)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == elements[hit]
        places.append((owner[hit], at[hit]))
    both = np.zeros((len(rest), len(members)), np.float64)
    for start in range(0, len(shared), VOCABULARY_SLICE):
        grids = []
        for (owner, at), n in zip(places, lengths, strict=True):
            inside = (at >= start) & (at < start + VOCABULARY_SLICE)
            grid = np.zeros((len(n), VOCABULARY_SLICE), np.float32)
            grid[owner[inside], at[inside] - start] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    union = lengths[0][:, None] + lengths[1][None, :] - both
    return 100 * both >= percent * union


def family_links(
    many: DataFrame, component: DataFrame, items: DataFrame, compare_blocks: Callable[[list, list], np.ndarray]
) -> DataFrame:
    """Links of members of large buckets that lie outside their family's largest component.

    ``many``: the members of large buckets with their pivots; buckets with a common member are a family. ``items
    (doc_id, elements)`` holds what ``compare_blocks`` judges: all of one list against all of another.
    """
    family = families_of(many).select("node", F.col("component").alias("family"))
    placed = written(
        family.join(component, "node", "left").select(
            "node", "family", F.coalesce("component", "node").alias("component")
        ),
        "placed",
    )
    parts = placed.groupBy("family", "component").count()
    largest = parts.groupBy("family").agg(
        F.sum("count").alias("members"), F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("parts")
    )
    largest = largest.where("parts > 1").select(
        "family",
        F.col("top.component").alias("largest"),
        F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int").alias("blocks"),
        F.ceil((F.col("members") - F.col("top.count")) / BLOCK_RESTS).cast("int").alias("rests"),
    )
    own = items.select(F.col("doc_id").alias("node"), "elements")
    met = placed.join(largest, "family").join(own, "node")
    place = F.abs(F.xxhash64("node"))
    members = met.select(
        "family", "node", "component", "elements", F.pmod(place, "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("rest"),
    )
    rests = met.where("component != largest").select(
        "family", "node", "component", "elements", F.pmod(place, "rests").cast("int").alias("rest"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            hits = compare_blocks(list(left["elements"]), list(right["elements_m"]))
            here, there = left["component"].to_numpy(), right["component_m"].to_numpy()
            for i, row in enumerate(hits):
                # One link into each other component is enough for the components.
                new = np.flatnonzero(row & (there != here[i]))
                _, first = np.unique(there[new], return_index=True)
                found += [(here[i], there[j]) for j in new[first]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    members = members.toDF(*[f"{c}_m" for c in members.columns])
    grouped = rests.groupBy("family", "rest", "block").cogroup(members.groupBy("family_m", "rest_m", "block_m"))
    return grouped.applyInPandas(compare, "a bigint, b bigint")


def only_of(sets: DataFrame, pairs: DataFrame, most: int = MOST_COPIED_IDS) -> DataFrame:
    """The sets that some pair names, picked before any shuffle if the list of ids is short enough to
    copy; beyond that bound all sets go on, and the joins that follow pick the same ones."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    if ids.count() > most:
        return sets
    return sets.join(F.broadcast(ids), "doc_id", "left_semi")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, small: int = 32
) -> DataFrame:
    """``doc_id, k1, k2, n_shingles, component_id, kept`` for each row of ``docs (doc_id, text)``; k1 and k2 are
    a key of the text."""
    base = Written(signed(docs, words, bands, rows).withColumn("row", F.monotonically_increasing_id()), "sets")
    sets = base.frame.where("doc_id is not null and set_key is not null")
    # The node of a set is the number, as written, of one row that holds it.
    first = F.min(F.struct("doc_id", "row"))
    own = written(
        sets.groupBy("set_key").agg(
            first.alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        ).select("set_key", F.col("first.row").alias("node"), F.col("first.doc_id").alias("name"), "n", "bands"),
        "representatives",
    )
    entries = own.select("node", "n", F.explode("bands").alias("bucket")).repartition("bucket")
    # XOR with the bucket's key makes the minimum a random member, another one in each band.
    buckets = entries.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min(F.expr("node ^ bucket")).alias("pivot")
    )
    buckets = buckets.where("members > 1").select("bucket", "members", F.expr("pivot ^ bucket").alias("pivot"))
    shared = Written(entries.join(buckets, "bucket"), "buckets")
    items = sets.select(F.col("row").alias("doc_id"), "elements")

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(pairs, only_of(items, pairs), percent)

    alike = f"{percent} * greatest(n, n_b) <= 100 * least(n, n_b)"
    final = bucket_links(shared.frame, small, alike, verify, "components")
    many = shared.frame.where(F.col("members") > small)
    if not many.isEmpty():

        def compare_sets(left: list, right: list) -> np.ndarray:
            return block_links(list(map(unpacked, left)), list(map(unpacked, right)), percent)

        more = family_links(many, final, items, compare_sets)
        final = grown(final, between_components(more), lambda pairs: pairs, "components")
    named = own.select("set_key", "node", "name").join(final, "node", "left")
    named = written(named.select("set_key", "name", F.coalesce("component", "node").alias("component")), "named-sets")
    names = named.groupBy("component").agg(F.min("name").alias("component_id"))
    named = named.join(names, "component").select("set_key", "component_id")
    own_rows = base.frame.select("doc_id", *TEXT_KEY, "n_shingles", "set_key")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    result = written(
        own_rows.join(named, "set_key", "left").select(
            "doc_id",
            *TEXT_KEY,
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        ),
        "near-duplicates",
    )
    base.drop()
    shared.drop()
    return result


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: of each group the one with the smallest doc_id, repeated rows once.

    Of rows with one id and different texts each stays or goes by its own text.
    """
    gone = near_duplicates(docs, words, percent).where("not kept").select(
        F.col("doc_id").alias("gone_id"), *[F.col(k).alias(f"gone_{k}") for k in TEXT_KEY]
    ).distinct()
    keyed = docs.withColumn("gone_key", F.struct(F.xxhash64(text_of()).alias("k1"), F.xxhash64(F.lit(1), text_of()).alias("k2")))
    same = (F.col("doc_id") == F.col("gone_id")) & (F.col("gone_key.k1") == F.col("gone_k1")) & (F.col("gone_key.k2") == F.col("gone_k2"))
    return keyed.join(gone, same, "left_anti").drop("gone_key").dropDuplicates()
