"""Ranking, running and neighbour functions over ordered groups.

A plain ``Window.partitionBy(group)`` sorts each group in one task, which ends when one
group holds a third of a large table. Every function here first counts the rows per
group (an aggregate with map-side combine). If the largest group is small, it uses the
plain window. If not, it range-partitions the rows by group *and* order, so a large
group is spread over many slices, computes inside the slices, and adds what the earlier
slices of the same group contribute. That table has at most one row per slice. Running totals whose
first order column has few values are spread by that column instead, in one plain shuffle.

``order_by`` holds column names, each optionally followed by ``desc`` or ``asc``.
``limit`` is the largest group one task may sort; ``None`` means the caller knows the
groups to be small (calendar months, say) and skips the count. Several functions over the same groups
share one count by passing ``groups_of(df, by)`` as the ``limit``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..session import stash
from .joins import equi_join, join_dimension

MAX_GROUP_ROWS = 1_000_000
# Running totals are spread by the first order column where it has at most so many values: their totals are copied.
MOST_LEADS = 100_000

_SLICE = "_slice"
_COPY = "_copy"


def as_names(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _order_names(order_by) -> list[str]:
    return [spec.split()[0] for spec in as_names(order_by)]


def _order_columns(order_by) -> list[Column]:
    columns = []
    for spec in as_names(order_by):
        name, _, direction = spec.partition(" ")
        columns.append(F.col(name).desc() if direction.strip() == "desc" else F.col(name).asc())
    return columns


def _window(partition_by, order_by) -> WindowSpec:
    return Window.partitionBy(*as_names(partition_by)).orderBy(*_order_columns(order_by))


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def largest_group(df: DataFrame, keys) -> int:
    counts = df.groupBy(*as_names(keys)).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]


@dataclass(frozen=True)
class Groups:
    """What is known of the groups of a frame: their keys, the rows of the largest, the most one task may sort."""

    by: tuple[str, ...]
    largest: int
    limit: int

    def holds(self, keys) -> bool:
        """Groups by more keys are parts of these, so no larger."""
        if not set(self.by) <= set(as_names(keys)):
            raise ValueError(f"groups by {', '.join(self.by) or 'nothing'} say nothing of groups by {keys}")
        return self.largest <= self.limit


def groups_of(df: DataFrame, by, limit: int = MAX_GROUP_ROWS) -> Groups:
    """Counted once, for a stack of windows. It stays right while steps add columns or drop rows."""
    return Groups(tuple(as_names(by)), largest_group(df, by), limit)


def is_small(df: DataFrame, keys, limit: int | Groups | None) -> bool:
    if isinstance(limit, Groups):
        return limit.holds(keys)
    return limit is None or largest_group(df, keys) <= limit


# --- running sums: the one primitive that crosses slices -----------------------


def running(df: DataFrame, by, order_by, sums: dict[str, Column], limit, slices=None, *, unique=False) -> DataFrame:
    """Add running sums, row by row in the given order.

    Rows of equal order stand in any order, as in SQL. ``unique`` says there are none.
    """
    by = as_names(by)
    if is_small(df, by, limit):
        window = _so_far(_window(by, order_by))
        return df.withColumns({name: F.sum(value).over(window) for name, value in sums.items()})
    return _running_in_slices(df, by, order_by, sums, slices, unique)


def _sliced(df, by, order, slices, unique) -> tuple[DataFrame, list[str]]:
    """Rows range-partitioned by group and order, with the number of their slice; and the order within it."""
    if not unique:
        # Copies of one row would all fall into one slice. A number of their own, written
        # down so that it is the same on every attempt, lets borders run between them.
        df = stash(df.withColumn(_COPY, F.monotonically_increasing_id()), "numbered")
        order = [*order, _COPY]
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = [F.col(c) for c in by] + _order_columns(order)
    marked = df.repartitionByRange(slices, *borders).withColumn(_SLICE, F.spark_partition_id())
    # One task per slice; hashing the slice numbers would put several into some tasks.
    return marked.repartitionById(slices, F.col(_SLICE)), order


def _running_in_slices(df, by, order_by, sums, slices, unique=False) -> DataFrame:
    columns = df.columns
    inputs = {f"_in_{name}": value for name, value in sums.items()}
    marked, order = _sliced(df.withColumns(inputs), by, as_names(order_by), slices, unique)
    inside = _so_far(_window([_SLICE, *by], order))
    # Written once: a range exchange that runs again may draw other borders.
    rows = stash(marked.withColumns({name: F.sum(f"_in_{name}").over(inside) for name in sums}), "slices")

    steps = rows.groupBy(_SLICE, *by).agg(*[F.sum(f"_in_{name}").alias(f"_step_{name}") for name in sums])
    earlier = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumns(
        {"_earlier": F.count("*").over(earlier)}
        | {f"_carry_{name}": F.sum(f"_step_{name}").over(earlier) for name in sums}
    ).filter(F.col("_earlier") > 0)
    # Slices are ranges, so only the first group of a slice can have begun before it:
    # one row per slice at most is left to copy.
    carried = carried.select(_SLICE, *by, *[f"_carry_{name}" for name in sums])
    joined = equi_join(rows, F.broadcast(carried), [_SLICE, *by], "left", null_safe=True)
    return _with_carry(joined, sums, dict(rows.dtypes)).select(*columns, *sums)


def _with_carry(joined: DataFrame, sums, types: dict[str, str]) -> DataFrame:
    totals = {}
    for name in sums:
        inner, carry = F.col(name), F.col(f"_carry_{name}")
        totals[name] = F.coalesce(inner + carry, inner, carry).cast(types[name])
    return joined.withColumns(totals)


def _lead_totals(df: DataFrame, keys: list[str], sums: dict[str, Column], most: int) -> DataFrame | None:
    """Sums per value of ``keys``; none if these are many, or if one has too many rows for a task."""
    found = df.agg(F.approx_count_distinct(F.xxhash64(*keys)).alias("n")).first()["n"]
    if found > min(MOST_LEADS, most):
        return None
    steps = {f"_step_{name}": F.sum(value) for name, value in sums.items()}
    leads = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *[step.alias(name) for name, step in steps.items()])
    leads = stash(leads, "leads")
    return leads if leads.agg(F.coalesce(F.max("_rows"), F.lit(0)).alias("n")).first()["n"] <= most else None


def _running_by_lead(df: DataFrame, by, order_by, sums: dict[str, Column], most: int) -> DataFrame | None:
    """Running sums in one shuffle: inside the rows of one value of the first order column, plus the
    totals of the values before it, which are few. None where that column does not serve (``_lead_totals``)."""
    lead = next((spec for spec in as_names(order_by) if spec.split()[0] not in by), None)
    if lead is None:
        return None
    keys = [*by, lead.split()[0]]
    leads = _lead_totals(df, keys, sums, most)
    if leads is None:
        return None
    inside = _so_far(_window(keys, order_by))
    rows = df.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})
    earlier = _window(by, lead).rowsBetween(Window.unboundedPreceding, -1)
    carried = leads.select(*keys, *[F.sum(f"_step_{name}").over(earlier).alias(f"_carry_{name}") for name in sums])
    joined = join_dimension(rows, carried, keys, "left", null_safe=True)
    return _with_carry(joined, sums, dict(rows.dtypes)).select(*df.columns, *sums)


def _number_in_slices(df, by, order_by, name, slices) -> DataFrame:
    return _running_in_slices(df, by, order_by, {name: F.lit(1).cast("bigint")}, slices)


# --- ranks ---------------------------------------------------------------------


def number_rows(df: DataFrame, by, order_by, name: str = "row_number", *,
                limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """ROW_NUMBER; rows of equal order are numbered in any order."""
    return running(df, by, order_by, {name: F.lit(1).cast("bigint")}, limit, slices)


def place_rows(df: DataFrame, by, order_by, *, row_number: str | None = None, rank: str | None = None,
               dense_rank: str | None = None, through: str | None = None, size: str | None = None, ties=None,
               limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """Every place of a row in its group, from one count and one exchange.

    ROW_NUMBER by ``order_by``; RANK and DENSE_RANK by ``ties``, the leading part of ``order_by`` whose equal
    rows are peers (default: all of it); ``through``, the rows up to the last peer; ``size``, the rows
    of the group. All other rankings follow from these (``ntile_of``, ``percent_rank_of``).
    """
    by, order = as_names(by), as_names(order_by)
    peers = order if ties is None else as_names(ties)
    if order[: len(peers)] != peers:
        raise ValueError("ties are told by the leading part of the order")
    wanted = {"row_number": row_number, "rank": rank, "dense_rank": dense_rank, "through": through, "size": size}
    wanted = {kind: name for kind, name in wanted.items() if name}
    if is_small(df, by, limit):
        found = _places(by, order, peers)
        return df.withColumns({name: found[kind] for kind, name in wanted.items()})
    columns = df.columns
    marked, order = _sliced(df, by, order, slices, False)
    local = _places([_SLICE, *by], order, peers)
    value = F.struct(*_order_names(peers))
    # Written once: a range exchange that runs again may draw other borders.
    rows = stash(marked.withColumns({f"_own_{kind}": column for kind, column in local.items()}), "slices")
    carried = _carried_places(rows, by, value)
    joined = equi_join(rows, F.broadcast(carried), [_SLICE, *by], "left", null_safe=True)
    before = F.coalesce("_before", F.lit(0))
    opened = F.col("_own_rank") == 1
    closing = F.col("_own_dense_rank") == F.col("_values")
    places = {
        "row_number": F.col("_own_row_number") + before,
        "rank": F.when(opened & F.col("_joined"), F.col("_start")).otherwise(F.col("_own_rank") + before),
        "dense_rank": F.col("_own_dense_rank") + F.coalesce("_values_before", F.lit(0)),
        "through": F.when(closing & F.col("_continued"), F.col("_end")).otherwise(F.col("_own_through") + before),
        "size": F.coalesce("_size", "_own_size"),
    }
    return joined.withColumns({name: places[kind] for kind, name in wanted.items()}).select(*columns, *wanted.values())


def _places(by, order, peers) -> dict[str, Column]:
    window, tied = _window(by, order), _window(by, peers)
    to_last_peer = tied.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        "row_number": F.row_number().over(window).cast("bigint"),
        "rank": F.rank().over(tied).cast("bigint"),
        "dense_rank": F.dense_rank().over(tied).cast("bigint"),
        "through": F.count("*").over(to_last_peer),
        "size": F.count("*").over(Window.partitionBy(*by)),
    }


def _carried_places(rows: DataFrame, by, value: Column) -> DataFrame:
    """What each slice of a group that has several must know of the others, at most two rows for each slice.

    Peers may run on over any number of slices: they begin where the last slice with a beginning of
    peers says, and end where the next slice with an end of peers says.
    """
    parts = rows.groupBy(_SLICE, *by).agg(
        F.count("*").alias("_rows"),
        F.max("_own_dense_rank").alias("_values"),
        F.min_by(value, "_own_row_number").alias("_first"),
        F.max_by(value, "_own_row_number").alias("_last"),
        F.max("_own_rank").alias("_last_start"),
        F.min("_own_through").alias("_first_end"),
    )
    along = Window.partitionBy(*by).orderBy(_SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = along.rowsBetween(1, Window.unboundedFollowing)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.withColumns(
        {
            "_parts": F.count("*").over(whole),
            "_size": F.sum("_rows").over(whole),
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_joined": F.col("_first").eqNullSafe(F.lag("_last").over(along)),
        }
    ).filter("_parts > 1")
    parts = parts.withColumn("_continued", F.coalesce(F.lead("_joined").over(along), F.lit(False)))
    several = F.col("_values") > 1
    starts = F.when(several | ~F.col("_joined"), F.col("_before") + F.col("_last_start"))
    ends = F.when(several | ~F.col("_continued"), F.col("_before") + F.col("_first_end"))
    merged = F.sum(F.col("_joined").cast("bigint")).over(_so_far(along))
    return parts.select(
        _SLICE, *by, "_size", "_before", "_joined", "_continued", "_values",
        (F.coalesce(F.sum("_values").over(earlier), F.lit(0)) - merged).alias("_values_before"),
        F.last(starts, ignorenulls=True).over(earlier).alias("_start"),
        F.first(ends, ignorenulls=True).over(later).alias("_end"),
    )


def ntile_of(row_number: Column, size: Column, tiles: int) -> Column:
    """NTILE: the first ``size mod tiles`` tiles are one row longer."""
    short, long_tiles = F.floor(size / tiles), size % tiles
    in_long = F.floor((row_number - 1) / (short + 1)) + 1
    in_short = long_tiles + F.floor((row_number - 1 - long_tiles * (short + 1)) / F.greatest(short, F.lit(1))) + 1
    return F.when(row_number <= long_tiles * (short + 1), in_long).otherwise(in_short).cast("bigint")


def percent_rank_of(rank: Column, size: Column) -> Column:
    return F.coalesce(F.try_divide(rank - 1, size - 1), F.lit(0.0))


def rank_rows(df: DataFrame, by, order_by, *, rank: str | None = None, dense_rank: str | None = None,
              limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """RANK and DENSE_RANK. A value shared by very many rows is spread like any others."""
    return place_rows(df, by, order_by, rank=rank, dense_rank=dense_rank, limit=limit, slices=slices)


def with_group_stats(df: DataFrame, by, stats: dict[str, Column]) -> DataFrame:
    """Aggregates of its group on every row: ``AGG(x) OVER (PARTITION BY by)``.

    Aggregating first and joining back keeps a large group off a single task.
    """
    by = as_names(by)
    totals = df.groupBy(*by).agg(*[value.alias(name) for name, value in stats.items()])
    if by:
        return join_dimension(df, stash(totals, "group-stats"), by, null_safe=True)
    row, types = totals.first(), dict(totals.dtypes)
    return df.withColumns({name: F.lit(row[name]).cast(types[name]) for name in stats})


def percent_rank(df: DataFrame, by, order_by, name: str = "percent_rank", *,
                 limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    placed = place_rows(df, by, order_by, rank="_rank", size="_size", limit=limit, slices=slices)
    return placed.withColumn(name, percent_rank_of(F.col("_rank"), F.col("_size"))).select(*df.columns, name)


def ntile(df: DataFrame, by, order_by, tiles: int, name: str = "ntile", *,
          limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    placed = place_rows(df, by, order_by, row_number="_rn", size="_size", limit=limit, slices=slices)
    return placed.withColumn(name, ntile_of(F.col("_rn"), F.col("_size"), tiles)).select(*df.columns, name)


# --- the first rows of a group ---------------------------------------------------


# Up to this many rows, Spark itself keeps only the first rows of a group in each map task.
GROUP_LIMIT = 1000


def top_n(df: DataFrame, by, order_by, n: int, name: str = "rank", method: str = "row_number", *,
          limit: int | Groups | None = MAX_GROUP_ROWS) -> DataFrame:
    """Rows whose place in their group is at most ``n``.

    The rank filter sits on the window, so every map task keeps ``n`` rows per group
    before the shuffle. Ties at the edge of RANK and DENSE_RANK can be any number of
    rows; in large groups the winning *values* are found and joined back instead.
    """
    by, function = as_names(by), {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]
    if method == "row_number" and n <= GROUP_LIMIT or is_small(df, by, limit):
        placed = df.withColumn(name, function().over(_window(by, order_by))).filter(F.col(name) <= n)
        return placed.withColumn(name, F.col(name).cast("bigint"))
    if method == "row_number":
        return _number_in_slices(df, by, order_by, name, None).filter(F.col(name) <= n)
    keys = [*by, *[c for c in _order_names(order_by) if c not in by]]
    values = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    if n > GROUP_LIMIT:
        values = stash(values, "values")
        best = _number_in_slices(values, by, order_by, "_place", None).filter(F.col("_place") <= n)
        best = running(best, by, order_by, {"_through": F.col("_rows")}, limit, None, unique=True)
        before = F.col("_through") - F.col("_rows")
    else:
        window = _window(by, order_by)
        best = values.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n)
        before = F.sum("_rows").over(_so_far(window)) - F.col("_rows")
    place = before + 1 if method == "rank" else F.col("_place")
    best = best.withColumn(name, place.cast("bigint")).filter(F.col(name) <= n).select(*keys, name)
    return join_dimension(df, stash(best, "best"), keys, null_safe=True)


def latest_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the first in the given order (newest first for "latest")."""
    return top_n(df, keys, order_by, 1, "_place").drop("_place")


# --- running totals and neighbours -----------------------------------------------


def running_total(df: DataFrame, by, order_by, value: Column, name: str, *, ties: str = "rows",
                  limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """Running sum with an explicit frame.

    ``ties="rows"`` adds row by row; ``ties="range"`` gives rows of equal order the same
    total, which is SQL's default frame.
    """
    by = as_names(by)
    if ties == "rows":
        if is_small(df, by, limit):
            return running(df, by, order_by, {name: value}, None)
        most = limit.limit if isinstance(limit, Groups) else limit
        led = _running_by_lead(df, by, order_by, {name: value}, most)
        return led if led is not None else _running_in_slices(df, by, order_by, {name: value}, slices)
    if is_small(df, by, limit):
        window = _window(by, order_by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(name, F.sum(value).over(window))
    keys = [*by, *[c for c in _order_names(order_by) if c not in by]]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_value"))
    values, parts = stash(totals, "values"), {name: F.col("_value")}
    totals = running(values, by, order_by, parts, limit, slices, unique=True).drop("_value")
    return join_dimension(df, totals, keys, null_safe=True)


def neighbours(df: DataFrame, by, order_by, fetch: dict[str, tuple[str, int]], *,
               limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """LAG and LEAD: ``{"previous": ("amount", -1), "next": ("amount", 1)}``.

    In large groups a row finds its neighbour by row number. A number occurs once in a group, so
    the join is even whatever the groups are, and no offset makes a task larger.
    """
    by = as_names(by)
    if is_small(df, by, limit):
        window = _window(by, order_by)
        return df.withColumns({name: F.lag(c, -step).over(window) for name, (c, step) in fetch.items()})
    rows = _number_in_slices(df, by, order_by, "_rn", slices)
    result = rows
    for step in sorted({step for _, step in fetch.values()}):
        found = [F.col(c).alias(name) for name, (c, s) in fetch.items() if s == step]
        at_step = rows.select(*by, (F.col("_rn") - step).alias("_rn"), *found)
        result = equi_join(result, at_step, [*by, "_rn"], "left", null_safe=True)
    return result.select(*df.columns, *fetch)


def rolling_mean(df: DataFrame, by, order_by, value: Column, rows: int, name: str, *,
                 limit: int | Groups | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """Mean over the last ``rows`` rows; null until that many exist.

    Large groups are cut into blocks of ``rows`` rows. A frame is the end of one block and the beginning of
    the next, so its sum is a running sum from a block's end plus one from a block's start: nothing is
    subtracted, and infinite values or rounding of other frames never enter. Blocks larger
    than a task should sort are themselves summed in slices.
    """
    by = as_names(by)
    if is_small(df, by, limit):
        frame = _window(by, order_by).rowsBetween(1 - rows, Window.currentRow)
        return df.withColumn(name, F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame)))
    most = limit.limit if isinstance(limit, Groups) else limit
    mean = df.select(F.avg(value).alias("m")).schema["m"].dataType
    exact = mean.typeName() == "decimal"
    numbered = _number_in_slices(df.withColumn("_value", value if exact else value.cast("double")), by, order_by, "_rn", slices)
    numbered = numbered.withColumn("_block", F.expr(f"(_rn - 1) div {rows}"))
    blocks, single = [*by, "_block"], None if rows <= most else most
    sums = [F.col("_value"), F.col("_value").isNotNull().cast("bigint")]
    heads = running(numbered, blocks, "_rn", dict(zip(("_head", "_head_n"), sums, strict=True)), single, slices, unique=True)
    slim = numbered.select(*blocks, "_rn", "_value")
    tails = running(slim, blocks, "_rn desc", dict(zip(("_tail", "_tail_n"), sums, strict=True)), single, slices, unique=True)
    # The tail that begins where the frame of row _rn does, unless that frame is just one block.
    tails = tails.filter(f"(_rn - 1) % {rows} > 0").select(*by, (F.col("_rn") + rows - 1).alias("_rn"), "_tail", "_tail_n")
    joined = equi_join(heads, tails, [*by, "_rn"], "left", null_safe=True)
    full = F.coalesce("_head_n", F.lit(0)) + F.coalesce("_tail_n", F.lit(0)) == rows
    total = F.when(F.col("_tail").isNull(), F.col("_head")).otherwise(F.col("_head") + F.col("_tail"))
    count = F.lit(rows).cast("decimal(20,0)") if exact else F.lit(float(rows))
    return joined.withColumn(name, F.when(full, (total / count).cast(mean))).select(*df.columns, name)


def change_from_previous(df: DataFrame, by, order_by, value: str, name: str, *, digits: int = 2,
                         limit: int | Groups | None = MAX_GROUP_ROWS) -> DataFrame:
    """Difference to the row before; 0 for the first row of a group."""
    shifted = neighbours(df, by, order_by, {"_previous": (value, -1)}, limit=limit)
    change = F.col(value) - F.coalesce(F.col("_previous"), F.col(value))
    return shifted.withColumn(name, F.round(change, digits)).drop("_previous")
