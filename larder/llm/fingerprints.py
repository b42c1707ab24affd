"""Document fingerprints that change little under small edits.

A text is walked character by character by a shared random walk: at step ``j`` the character under
the pointer is put out, and a random bit of ``(j, character)`` decides whether the pointer moves on.
Two texts that differ by few edits fall into step again soon after each edit, so their outputs have
a small Hamming distance (a randomised embedding of the edit distance). The fingerprint is a sample
of the output: step ``j`` belongs to level ``l`` with probability ``2**-l`` whatever the text, and
a text takes the finest level at which about ``SAMPLES`` steps remain. It is written as the level and
four hashed bits for each sampled step. The likeness of two fingerprints is the share of equal
samples at the coarser of their levels.

Near texts share bands of sampled steps, whatever their levels; each candidate is verified by the
likeness of the whole fingerprints (``near_groups``).

Defined cases: a null or empty text has an empty sample, which is like another empty one (1.0) and
unlike any other (0.0); equal texts have equal fingerprints wherever they are computed; rows are
ordered by doc_id (null first), then by text, so repeated rows follow each other; a table of one
row is its own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Written, strings, text_of, written
from .minhash import ODD, between_components, bucket_links, family_links, grown, mixed

SAMPLES = 128
LETTERS = 1024
TURNS = 4096
# Characters that one task walks at a time.
MOST_CHARACTERS = 12_000_000


@lru_cache(1)
def moves() -> np.ndarray:
    """The walk's random bits by step (modulo ``TURNS``) and letter; letter 0 is the end and stays."""
    bits = np.random.default_rng(20).integers(0, 2, (TURNS, LETTERS), dtype=np.int64)
    bits[:, 0] = 0
    return bits


def levels(first: int, count: int) -> np.ndarray:
    """The coarsest level that each step belongs to."""
    value = mixed(np.arange(first + 1, first + 1 + count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    low = value & (~value + np.uint64(1))
    return np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int64)


def letters_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return (points % (LETTERS - 1) + 1).astype(np.uint16)


def level_of(length: int) -> int:
    """A walk takes about two steps for each character."""
    return max(0, (2 * length // SAMPLES).bit_length() - 1)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text; all are walked side by side."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths[order] + 1, out=starts[1:])
    codes = np.zeros(int(starts[-1]) + 1, np.uint16)
    for k, i in enumerate(order):
        codes[starts[k] : starts[k] + lengths[i]] = letters_of(texts[i])
    level = np.array([level_of(int(n)) for n in lengths[order]], np.int64)
    found = np.zeros((len(texts), 16 * SAMPLES), np.uint8)
    counts = np.zeros(len(texts), np.int64)
    pointer, row = starts[:-1].copy(), np.arange(len(texts))
    bits, step, block = moves(), 0, 256
    while len(row):
        alive = codes[pointer] != 0
        if not alive.all():
            pointer, row = pointer[alive], row[alive]
        here = levels(step, block).tolist()
        own = level[row]
        # Rows go from long to short, so the rows that sample a step are the last ones.
        firsts = {l: int(np.searchsorted(-own, -l)) for l in set(here)}
        for j, l in enumerate(here, step):
            letter = codes.take(pointer)
            if (first := firsts[l]) < len(row):
                seen = letter[first:]
                on = np.flatnonzero(seen)
                rows = row[first:][on]
                at = counts[rows]
                if len(at) and at.max() >= found.shape[1]:
                    found = np.pad(found, ((0, 0), (0, found.shape[1])))
                found[rows, at] = nibbles()[(seen[on].astype(np.int64) + 7 * j) % LETTERS]
                counts[rows] += 1
            pointer += bits[j % TURNS].take(letter)
        step += block
    out = [""] * len(texts)
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    for k, i in enumerate(order):
        out[i] = f"{level[k]}:" + digits[found[k, : counts[k]]].tobytes().decode()
    return out


@lru_cache(1)
def nibbles() -> np.ndarray:
    return np.random.default_rng(21).integers(0, 16, LETTERS, dtype=np.uint8)


@lru_cache(64)
def sampled(level: int, coarser: int, count: int) -> np.ndarray:
    """Which of the first ``count`` samples of a level belong to the coarser level too."""
    found, step, kept = [], 0, 0
    while kept < count:
        part = levels(step, 65536)
        part = part[part >= level]
        found.append(part >= coarser)
        kept += len(part)
        step += 65536
    return np.concatenate(found)[:count] if found else np.zeros(0, bool)


def at_level(fingerprint: str, level: int) -> np.ndarray:
    own, _, samples = fingerprint.partition(":")
    values = np.frombuffer(samples.encode(), np.uint8)
    if int(own) == level:
        return values
    size = 1 << max(0, len(values) - 1).bit_length()  # few sizes, so that the lists are reused
    return values[sampled(int(own), level, size)[: len(values)]]


def likeness(one: str, two: str) -> float:
    """Share of equal samples, from 0 to 1."""
    if one == two:
        return 1.0
    level = max(int(one.partition(":")[0]), int(two.partition(":")[0]))
    a, b = at_level(one, level), at_level(two, level)
    n, most = min(len(a), len(b)), max(len(a), len(b))
    return float((a[:n] == b[:n]).sum() / most) if most else 0.0


def edited(text: str, following: str) -> str:
    """The last half replaced by as much of the beginning of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def rows_for(ids: list, texts: list[str], following: str) -> dict[str, list]:
    """Results of consecutive documents; ``following`` is the text after the last."""
    nexts = [*texts[1:], following]
    changed = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
    prints = fingerprints([*texts, following, *changed])
    own, after = prints[: len(texts)], prints[len(texts) + 1 :]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": own,
        "edited_fingerprint": after,
        "near_edited": [likeness(a, b) for a, b in zip(own, after, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own, prints[1 : len(texts) + 1], strict=True)],
    }


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, figures and fingerprints of each document and of its text edited by the next one.

    Documents are range-partitioned by doc_id and walked in order. What each partition cannot know
    is the next text of its last row; so it passes on its first and last text, one row for each
    partition, and these few are finished afterwards.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), None
        ids, texts, size = [], [], 0

        def closed(count: int) -> pa.RecordBatch:
            values = rows_for(ids[:count], texts[:count], texts[count])
            arrays = [pa.array(values[name], kind) for name, kind in COLUMNS.items()]
            none = [pa.nulls(count, pa.int32()), pa.nulls(count, pa.string()), pa.nulls(count, pa.string())]
            return pa.RecordBatch.from_arrays(arrays + none, names=[*COLUMNS, "part", "head", "tail"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch, "text"), strict=True):
                first = text if first is None else first
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size > MOST_CHARACTERS and len(texts) > 1:
                    yield closed(len(texts) - 1)
                    ids, texts, size = ids[-1:], texts[-1:], len(text)
        if len(texts) > 1:
            yield closed(len(texts) - 1)
        if texts:
            arrays = [pa.array(ids[-1:], pa.int64()), *[pa.nulls(1, kind) for kind in list(COLUMNS.values())[1:]]]
            arrays += [pa.array([part], pa.int32()), pa.array([first]), pa.array(texts[-1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS, "part", "head", "tail"])

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ordered = picked.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    base = written(ordered.mapInArrow(work, f"{RESULT}, part int, head string, tail string"), "fingerprints")
    # Only the numbers of the partitions meet in one task; the texts are joined by number.
    borders, order = base.where("part is not null"), Window.orderBy("part")
    first = F.first("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    chain = borders.select("part", F.coalesce(F.lead("part").over(order), first).alias("next"))
    heads = borders.select(F.col("part").alias("next"), F.col("head").alias("following"))
    edges = borders.select("doc_id", "part", F.col("tail").alias("text")).join(chain, "part").join(heads, "next")
    edges = edges.select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column("doc_id").to_pylist(), strings(batch, "text"), strings(batch, "following"), strict=True)
            for doc_id, text, following in found:
                values = rows_for([doc_id], [text], following)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[name], kind) for name, kind in COLUMNS.items()], names=list(COLUMNS)
                )

    return base.where("part is null").select(*COLUMNS).unionByName(edges.mapInArrow(finish, RESULT))


@lru_cache(1024)
def places(count: int, least: float, bands: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The bands of ``count`` samples: a number of each band that tells it from all others, and its places.

    Each head of the samples has a few bands of its own, dealt out of all its places, and a print takes
    ``bands`` or more in all from its heads down to a little under ``least`` of it. So two prints
    that are alike share the bands of every head that both fill, however much longer one of them is.
    Bands of short heads are narrower, as many of their samples may differ. Empty places are ``count``.
    """
    lowest = 0.875 * least
    salts, rows = [], []
    for head in range(int(lowest * count) + 1, count + 1):
        wide = min(width, max(1, head - int(head * (1 - least) / least)))
        each, wanted = head // wide, math.ceil(bands / max(1.0, (1 - lowest) * head))
        draw = np.random.default_rng((22, head))
        dealt = [draw.permutation(head)[: each * wide].reshape(each, wide) for _ in range(-(-wanted // each))]
        # Bands of the same places are the same band.
        spots = np.unique(np.sort(np.concatenate(dealt)[:wanted], axis=1), axis=0)
        rows.append(np.pad(spots, ((0, 0), (0, width - wide)), constant_values=count))
        salts.append((head << 16) + np.arange(len(spots)))
    return np.concatenate(salts).astype(np.uint64), np.concatenate(rows)


# Samples that a short signature holds, and how many of its bits may differ: a pair at the bound of 0.8 differs in a tenth
# of them, and passes with a probability above 0.9999; unrelated texts differ in over two fifths.
SHORT = 128
MOST_DIFFERING, SLACK = 0.22, 2


def banded(fingerprint: str, least: float) -> list[tuple[int, np.ndarray]]:
    """The levels, with their samples, at which bands of a fingerprint are drawn.

    The coarsest level at which ``SAMPLES // 2`` samples are left, whatever the fingerprint's own level; and the
    next coarser one too, if a text that is ``least`` alike could have as many samples there.
    """
    level = int(fingerprint.partition(":")[0])
    values = at_level(fingerprint, level)
    while len(coarser := at_level(fingerprint, level + 1)) >= SAMPLES // 2:
        level, values = level + 1, coarser
    found = [(level, values)] if len(values) else []
    return found + ([(level + 1, coarser)] if len(coarser) and len(coarser) >= 0.9 * least * (SAMPLES // 2) else [])


# The last bits of a key tell the level that it was drawn at.
LEVEL_BITS = 5


def bucket_keys(fingerprint: str, least: float, bands: int, width: int) -> np.ndarray:
    """The keys of a fingerprint's bands."""
    found = []
    for at, seen in banded(fingerprint, least):
        salts, spots = places(len(seen), least, bands, width)
        letters = np.append(seen, 0).astype(np.uint64)
        keys = mixed(salts * ODD + np.uint64(at))
        for column in letters[spots].T:
            keys = mixed(keys * ODD + column)
        found.append((keys >> np.uint64(LEVEL_BITS) << np.uint64(LEVEL_BITS)) | np.uint64(at % (1 << LEVEL_BITS)))
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def signatures(fingerprint: str, least: float) -> list[tuple[int, int, int, int]]:
    """For each level of the bands: its number, and the bits of its first ``SHORT`` samples and how many there are."""
    return [(at % (1 << LEVEL_BITS), *signature(seen)) for at, seen in banded(fingerprint, least)]


def signature(samples: np.ndarray) -> tuple[int, int, int]:
    """One hashed bit of each sample, so that unlike letters agree in half of the cases."""
    samples = samples[:SHORT]
    bits = np.zeros(SHORT, np.uint8)
    bits[: len(samples)] = sample_bits()[samples]
    low, high = np.packbits(bits, bitorder="little").view("<i8").tolist()
    return low, high, len(samples)


@lru_cache(1)
def sample_bits() -> np.ndarray:
    """A bit for each of the sixteen digits, as many of either kind."""
    bits = np.zeros(256, np.uint8)
    bits[np.frombuffer(b"0123456789abcdef", np.uint8)] = np.random.default_rng(23).permutation(np.arange(16) % 2)
    return bits


def signatures_alike(one: str, two: str) -> str:
    """The condition, in Spark's terms, that two short signatures differ in few of the bits that both have."""
    shared = f"least(count{one}, count{two})"
    mask = "CASE WHEN {n} >= 64 THEN -1L WHEN {n} <= 0 THEN 0L ELSE shiftrightunsigned(-1L, cast(64 - {n} AS int)) END"
    low = f"bit_count((low{one} ^ low{two}) & ({mask.format(n=shared)}))"
    high = f"bit_count((high{one} ^ high{two}) & ({mask.format(n=f'({shared} - 64)')}))"
    return f"{low} + {high} <= {MOST_DIFFERING} * {shared} + {SLACK}"


# Prints up to which the narrowest bands are wide enough; a further sample in a band parts chance pairs about this many times.
FEW_PRINTS, PARTED = 250_000, 7
BAND_MISSED = 5e-4


def banding(prints: int, least: float) -> tuple[int, int]:
    """Bands and their width: wide enough that chance pairs of a print stay few however many prints there are, and so many
    that a pair at the bound shares none with probability ``BAND_MISSED``."""
    width = 7 + max(0, math.ceil(math.log(max(prints, 1) / FEW_PRINTS, PARTED)))
    return math.ceil(math.log(BAND_MISSED) / math.log1p(-(least**width))), width


def like_blocks(left: list[str], right: list[str], least: float) -> np.ndarray:
    """Which of ``left`` (rows) are like which of ``right`` (columns); a row of pairs at a time."""
    own = [np.array([int(p.partition(":")[0]) for p in group]) for group in (left, right)]
    grids = {}
    for level in np.unique(np.concatenate(own)).tolist():
        for side, group in enumerate((left, right)):
            rows = np.flatnonzero(own[side] <= level)
            samples = [at_level(group[i], level) for i in rows]
            sizes = np.array([len(s) for s in samples], np.int64)
            # Different filling, so that what is missing never agrees.
            grid = np.full((len(rows), max(sizes, default=0)), side, np.uint8)
            for row, values in enumerate(samples):
                grid[row, : len(values)] = values
            grids[level, side] = {int(i): k for k, i in enumerate(rows)}, grid, sizes
    hits = np.zeros((len(left), len(right)), bool)
    for i, fingerprint in enumerate(left):
        for level in np.unique(np.maximum(own[1], own[0][i])).tolist():
            columns = np.flatnonzero(np.maximum(own[1], own[0][i]) == level)
            at, grid, sizes = grids[level, 0]
            place, others, lengths = grids[level, 1]
            rows = np.array([place[int(j)] for j in columns])
            wide = min(grid.shape[1], others.shape[1])
            agree = (others[rows, :wide] == grid[at[i], :wide]).sum(axis=1)
            most = np.maximum(lengths[rows], sizes[at[i]])
            hits[i, columns] = agree >= least * np.maximum(most, 1)
        hits[i] |= np.array([fingerprint == other for other in right])
    return hits


def near_groups(
    prints: DataFrame, least: float = 0.8, bands: int | None = None, width: int | None = None, small: int = 32
) -> DataFrame:
    """``prints (doc_id, fingerprint, ...)`` with ``group_id``: the smallest doc_id reached by links.

    Equal fingerprints collapse first. Candidates agree on one of ``bands`` or more bands of ``width``
    samples (``banding``), which are drawn from the whole of a fingerprint and at a level that does not end at a
    length (``banded``), so neither one edit nor a length boundary spoils them all; and their short
    signatures differ little, so that chance pairs end before any print is fetched.
    Candidates are verified by the likeness of the whole fingerprints, in rounds (``bucket_links``); what stays
    outside the largest component of a family of large buckets is compared with the whole family in blocks.
    Rows without a doc_id are in no group.
    """
    own = Written(prints.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("name")).withColumn(
        "node", F.monotonically_increasing_id()
    ), "prints")
    if bands is None or width is None:
        bands, width = banding(own.frame.count(), least)

    @F.pandas_udf("array<bigint>")
    def drawn(values: pd.Series) -> pd.Series:
        return pd.Series([bucket_keys(v, least, bands, width) for v in values], dtype=object)

    @F.pandas_udf("array<struct<at int, low bigint, high bigint, count bigint>>")
    def short(values: pd.Series) -> pd.Series:
        return pd.Series([signatures(v, least) for v in values], dtype=object)

    # Two numbers an entry, in one shuffle; signatures come to the few entries that share a bucket.
    entries = own.frame.select("node", F.explode(drawn("fingerprint")).alias("bucket")).repartition("bucket")
    signed = own.frame.select("node", F.explode(short("fingerprint")).alias("s")).select("node", "s.*")
    buckets = entries.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min(F.expr("node ^ bucket")).alias("pivot")
    )
    buckets = buckets.where("members > 1").select("bucket", "members", F.expr("pivot ^ bucket").alias("pivot"))
    met = entries.join(buckets, "bucket").withColumn("at", F.col("bucket").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int"))
    shared = Written(met.join(signed, ["node", "at"]).drop("at"), "print-buckets")
    items = own.frame.select(F.col("node").alias("doc_id"), F.col("fingerprint").alias("elements"))

    @F.pandas_udf("boolean")
    def like(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([likeness(a, b) >= least for a, b in zip(one, two, strict=True)], dtype=bool)

    def verify(pairs: DataFrame) -> DataFrame:
        one = items.select(F.col("doc_id").alias("a"), F.col("elements").alias("print_a"))
        two = items.select(F.col("doc_id").alias("b"), F.col("elements").alias("print_b"))
        return pairs.join(one, "a").join(two, "b").where(like("print_a", "print_b")).select(*pairs.columns)

    final = bucket_links(shared.frame, small, signatures_alike("", "_b"), verify, "print-groups")
    many = shared.frame.where(F.col("members") > small)
    if not many.isEmpty():

        def compare(left: list, right: list) -> np.ndarray:
            return like_blocks(left, right, least)

        more = family_links(many, final, items, compare)
        final = grown(final, between_components(more), lambda pairs: pairs, "print-groups")
    # A print of its own that is linked with nothing is its own group.
    joined = own.frame.join(final, "node", "left").withColumn("group", F.coalesce("component", "node"))
    joined = written(joined.select("fingerprint", "name", "group"), "print-group-ids")
    names = joined.groupBy("group").agg(F.min("name").alias("group_id"))
    groups = joined.join(names, "group").select("fingerprint", "group_id")
    found = prints.drop("group_id").join(groups, "fingerprint", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.col("group_id")).alias("group_id")
    result = written(found.select(*[c for c in prints.columns if c != "group_id"], group), "near-prints")
    own.drop()
    shared.drop()
    return result
