"""Equi-joins that hold when a side is large or one key carries a third of the rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import every_salt, stable_salt
from ..session import UNKNOWN_BYTES, read_bytes, stash

# A side is copied to every executor only when its payload is proven to be at most this.
BROADCAST_BYTES = 64 << 20
# A side is read to measure it only where its inputs hold at most so many times that limit.
MEASURED_TIMES = 16

_KEEPS_FACT = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti")

# Keys lighter than this are never listed as hot, so the list stays short enough to copy.
LEAST_SHARE = 1e-5
# Joins salt no key lighter than this; a task's summary of heavy keys is then a megabyte at most.
LEAST_SALTED_SHARE = 1e-4
# Keys that a summary tracks, as a multiple of those that can be hot: its error is then under a third of the share.
TRACKED_TIMES = 8

_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def _payload(name: str, kind: str) -> Column:
    if kind in ("string", "binary"):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) + 16
    return F.lit(_FIXED_WIDTH.get(kind, 16 if kind.startswith("decimal") else 8))


def measured_bytes(df: DataFrame) -> int:
    """Exact payload of a frame: one aggregate over it, no shuffle of its rows."""
    width = reduce(lambda a, b: a + b, (_payload(f"`{n}`", k) for n, k in df.dtypes), F.lit(16))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def proven_bytes(df: DataFrame) -> int | None:
    """A bound that needs no job: rows that Catalyst proves (a limit, a grouping without keys, rows of this
    process) times the width of columns of fixed width. None where there is no such proof."""
    rows = df._jdf.queryExecution().optimizedPlan().maxRows()
    if rows.isEmpty() or any(kind.startswith(("string", "binary", "array", "map", "struct", "varchar", "char")) for _, kind in df.dtypes):
        return None
    return int(str(rows.get())) * (16 + sum(_FIXED_WIDTH.get(kind, 16 if kind.startswith("decimal") else 8) for _, kind in df.dtypes))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is proven small enough to copy.

    Surely small (``proven_bytes``): yes, without a job. Surely large, as its inputs hold more than
    ``MEASURED_TIMES`` the limit: no, without a job; if little of them is left after filters, AQE still sees that
    at run time. Only what lies between is measured. ``limit=0`` answers no unread.
    """
    if limit <= 0:
        return False
    proven = proven_bytes(df)
    if proven is not None and proven <= limit:
        return True
    if MEASURED_TIMES * limit < read_bytes(df) < UNKNOWN_BYTES:
        return False
    return measured_bytes(df) <= limit


def _pairs(on) -> list[tuple[str, str]]:
    on = [on] if isinstance(on, (str, tuple)) else list(on)
    return [(k, k) if isinstance(k, str) else k for k in on]


def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on ``"key"``, ``("left_key", "right_key")`` or a list of these.

    Keys of the same name appear once in the result; of different names, both do.
    ``null_safe`` lets two nulls match, as they do in a GROUP BY. The columns are those of
    ``left`` in their order, then those of ``right`` without the shared keys, for every ``how``.
    """
    pairs = _pairs(on)
    shared = [b for a, b in pairs if a == b]
    if len(shared) == len(pairs) and not null_safe:
        joined = left.join(right, shared, how)
        rest = [c for c in left.columns if c not in shared]
        front = [shared.index(c) if c in shared else len(shared) + rest.index(c) for c in left.columns]
        order = [*front, *range(len(front), len(joined.columns))]
        names = [f"_{i}" for i in range(len(joined.columns))]
        placed = joined.toDF(*names).select(*[names[i] for i in order])
        return placed.toDF(*[joined.columns[i] for i in order])
    # Fresh names keep the two sides apart when one is derived from the other.
    right = right.withColumnsRenamed({name: f"_right_{name}" for name in shared})
    tests = []
    for a, b in pairs:
        mine, other = F.col(a), F.col(f"_right_{b}" if a == b else b)
        tests.append(mine.eqNullSafe(other) if null_safe else mine == other)
    joined = left.join(right, reduce(lambda x, y: x & y, tests), how)
    if shared and how in ("right", "right_outer", "full", "outer", "full_outer", "fullouter", "rightouter"):
        # A row of the right side alone still has its keys.
        joined = joined.withColumns({n: F.coalesce(F.col(n), F.col(f"_right_{n}")) for n in shared})
    return joined.drop(*[f"_right_{n}" for n in shared])


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   limit: int = BROADCAST_BYTES, null_safe: bool = False) -> DataFrame:
    """Join a large frame with one that is usually small.

    Copies ``dim`` to the executors when its proven size allows (``fits_broadcast``), so the fact is not
    shuffled at all; otherwise shuffles both with the hot keys of the fact salted. Right and
    full joins keep rows of ``dim`` that no row of the fact has, which copies would repeat: they
    are shuffled and left to AQE's skew split. Columns and rows are the same on every path.
    """
    if how not in _KEEPS_FACT:
        return equi_join(fact, dim, on, how, null_safe)
    if fits_broadcast(dim, limit):
        return equi_join(fact, F.broadcast(dim), on, how, null_safe)
    return salted_join(fact, dim, on, how, null_safe=null_safe)


def strategy_fits(dim: DataFrame, strategy: str) -> bool:
    """``broadcast`` holds a whole side in memory and ``shuffle_hash`` a partition of it; ``merge`` spills."""
    parts = {"broadcast": 1, "shuffle_hash": int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions"))}
    return strategy not in parts or fits_broadcast(dim, BROADCAST_BYTES * parts[strategy])


def hinted_join(fact: DataFrame, dim: DataFrame, on, strategy: str, how: str = "inner", *, checked: bool = False) -> DataFrame:
    """Force ``broadcast``, ``merge`` or ``shuffle_hash``.

    A side that is too large for the strategy (``strategy_fits``, unless ``checked`` before) is refused,
    not joined in another way.
    """
    if not checked and not strategy_fits(dim, strategy):
        raise ValueError(f"the side is too large for {strategy}; use merge")
    return equi_join(fact, dim.hint(strategy), on, how)


def key_counts(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def skew_report(df: DataFrame, keys, top: int | None = None) -> DataFrame:
    """All keys (or the ``top`` heaviest) with their share of all rows and their weight against the
    median key, heaviest first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = stash(key_counts(df, keys), "key-counts")
    totals = counts.agg(F.sum("rows").alias("total"), F.percentile_approx("rows", 0.5).alias("median")).first()
    report = (
        counts.withColumn("share", F.round(F.col("rows") / F.lit(totals["total"] or 1), 6))
        .withColumn("times_median", F.round(F.col("rows") / F.lit(totals["median"] or 1), 6))
        .orderBy(F.col("rows").desc(), *keys)
    )
    return report if top is None else report.limit(top)


def heavy_hashes(df: DataFrame, keys, share: float) -> tuple[list[int], int]:
    """Hashes of all keys that may hold more than ``share`` of the rows, and the number of rows, in one pass.

    Every task summarises its rows in a frequent-items sketch of bounded size. Sketches are merged in lanes
    first, then all together, so no key is ever shuffled and no task merges all sketches of a large job.
    """
    tracked = math.ceil(TRACKED_TIMES / share)
    # About as many tasks as a scan of the inputs takes.
    lanes = max(1, math.isqrt(min(read_bytes(df), UNKNOWN_BYTES >> 20) >> 27))
    hashed = df.select(F.xxhash64(*keys).alias("_hash"), F.pmod(F.spark_partition_id(), F.lit(lanes)).alias("_lane"))
    lane = hashed.groupBy("_lane").agg(
        F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_sketch"), F.count("*").alias("_rows")
    )
    # Grouped by nothing much, as the sketch of no rows at all cannot be merged.
    merged = lane.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_sketch, {tracked})").alias("_sketch"), F.sum("_rows").alias("_rows"))
    wanted = min(math.ceil(3 / share), tracked)
    found = merged.select(F.expr(f"approx_top_k_estimate(_sketch, {wanted})").alias("top"), "_rows").first()
    return ([item["item"] for item in found["top"]], found["_rows"]) if found else ([], 0)


def hot_keys(df: DataFrame, keys, share: float) -> DataFrame:
    """Keys holding more than ``share`` of all rows, at most ``1 / share`` of them, and
    the share of each: found by a sketch, then counted exactly, without a shuffle of all keys."""
    if not share >= LEAST_SHARE:
        raise ValueError(f"a share below {LEAST_SHARE} would make the list of hot keys too long to copy")
    keys = list(keys)
    hashes, total = heavy_hashes(df, keys, share)
    # At most 3/share numbers.
    listed = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hashes], "_hash bigint"))
    rows = df.select(*keys).withColumn("_hash", F.xxhash64(*keys)).join(listed, "_hash", "left_semi")
    counts = key_counts(rows, keys).filter(F.col("rows") > share * max(total, 1))
    return counts.select(*keys, (F.col("rows") / F.lit(max(total, 1))).alias("share"))


def _mark_hot(side: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    marks = hot.toDF(*[f"_hot_{i}" for i in range(len(keys))], "_buckets")
    match = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)))
    # At most 1/share rows, so this copy is bounded whatever the size of the fact.
    return side.join(F.broadcast(marks), match, "left").drop(*[f"_hot_{i}" for i in range(len(keys))])


def salted_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner", *, salts: int | None = None,
                share: float | None = None, spread_by=None, null_safe: bool = False) -> DataFrame:
    """Shuffle join that spreads the hot keys of ``fact`` over buckets.

    A key gets four buckets for every even partition its rows would fill (or ``salts``),
    and the rows of ``dim`` under that key, of which there should be few, are copied once
    per bucket; all other rows stay single. The bucket comes from the row's content
    (``spread_by``, default all columns), so a task that runs again sends its rows to the
    same place; exact copies of one row stay together and are left to AQE's skew split.
    ``how`` keeps the fact side: inner, left, left_semi or left_anti.
    """
    if how not in _KEEPS_FACT:
        raise ValueError(f"salting copies the right side, which a {how} join would repeat")
    pairs = _pairs(on)
    width = max(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    # By default a key is hot when it outweighs half of an even partition.
    hot = hot_keys(fact, [a for a, _ in pairs], max(0.5 / width, LEAST_SALTED_SHARE) if share is None else share)
    buckets = F.lit(salts) if salts else F.ceil(F.col("share") * width * 4)
    hot = stash(hot.withColumn("share", buckets.cast("int")), "hot-keys")
    spread = F.pmod(F.xxhash64(*(spread_by or fact.columns)), F.col("_buckets")).cast("int")
    left = _mark_hot(fact, [a for a, _ in pairs], hot)
    left = left.withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_buckets")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1))
    right = _mark_hot(dim, [b for _, b in pairs], hot).withColumn("_salt_right", copies).drop("_buckets")
    return equi_join(left, right, [*pairs, ("_salt", "_salt_right")], how, null_safe).drop("_salt", "_salt_right")


def salted_join_all(fact: DataFrame, dim: DataFrame, on, *, salts: int = 8, spread_by=None) -> DataFrame:
    """The textbook salted join: every key is spread, every dimension row copied ``salts`` times.

    Always a shuffle join: Catalyst's estimate of ``dim`` leaves the copies out, so it would collect all of them in the driver.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left = fact.withColumn("_salt", stable_salt(salts, *(spread_by or fact.columns)))
    right = dim.withColumn("_salt", every_salt(salts)).hint("merge")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def aggregate_then_join(fact: DataFrame, dim: DataFrame, on, aggregates, how: str = "inner") -> DataFrame:
    """Reduce the fact to one row per key before the join, so no key is hot any more."""
    pairs = _pairs(on)
    reduced = fact.groupBy(*[a for a, _ in pairs]).agg(*aggregates)
    return join_dimension(reduced, dim, on, how)


def rows_without_match(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Anti-join; the right side is first reduced to its distinct keys."""
    pairs = _pairs(on)
    keys = right.select(*[F.col(b) for _, b in pairs]).distinct()
    return equi_join(left, keys, on, "left_anti")
