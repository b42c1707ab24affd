"""Grouped statistics, subtotals, pivots and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import steady_avg
from ..session import stash
from .windows import MAX_GROUP_ROWS, as_names, is_small, number_rows, running, with_group_stats


def kpi_by(df: DataFrame, key: str, value: Column, *, total="total", mean="avg_rating", best="best_rating") -> DataFrame:
    """Rows, mean and best value per group, best mean first; ties by key.

    """
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(total), steady_avg(value).alias(mean), F.max(value).alias(best))
        .orderBy(F.col(mean).desc(), key)
    )


def summarise(df: DataFrame, by, **named: Column) -> DataFrame:
    """``groupBy().agg()`` with every result named."""
    return df.groupBy(*as_names(by)).agg(*[value.alias(name) for name, value in named.items()])


def subtotals(df: DataFrame, columns, aggregates: dict[str, Column], *, kind="rollup", sets=None,
              labels: dict[str, str] | None = None, flags: dict[str, str] | None = None) -> DataFrame:
    """ROLLUP, CUBE or GROUPING SETS with labelled subtotal rows.

    ``labels`` names the text that stands for "all values" per column, ``flags`` the
    output column that carries GROUPING(column). A subtotal is told by its flag, so a
    real null key keeps its null.
    """
    columns, labels, flags = as_names(columns), labels or {}, flags or {}
    grouped = {
        "rollup": lambda: df.rollup(*columns),
        "cube": lambda: df.cube(*columns),
        "sets": lambda: df.groupingSets([[F.col(c) for c in s] for s in sets], *columns),
    }[kind]()
    marks = {c: f"_is_total_{c}" for c in columns}
    totals = grouped.agg(
        *[value.alias(name) for name, value in aggregates.items()],
        *[F.grouping(c).cast("int").alias(mark) for c, mark in marks.items()],
    )
    shown = []
    for c in columns:
        label = F.lit(labels[c]) if c in labels else F.lit(None)
        shown.append(F.when(F.col(marks[c]) == 1, label).otherwise(F.col(c)).alias(c))
    return totals.select(*shown, *aggregates, *[F.col(marks[c]).alias(flag) for c, flag in flags.items()])


def pivot_mean(df: DataFrame, row_key: str, column_key: str, value: Column, headings: list, digits: int = 2) -> DataFrame:
    """One column per heading. Named headings spare the extra pass that would list them."""
    return df.groupBy(row_key).pivot(column_key, headings).agg(F.round(F.avg(value).cast("double"), digits))


def share_of_total(df: DataFrame, key: str, *, count: str = "total", share: str = "pct", digits: int = 1) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    counts = stash(df.groupBy(key).agg(F.count("*").alias(count)), "counts")
    sized = with_group_stats(counts, [], {"_all": F.sum(count)})
    percent = F.round(F.lit(100.0) * F.col(count) / F.col("_all"), digits)
    return sized.withColumn(share, percent).drop("_all")


def members(df: DataFrame, by, member: str, unique_by: str, *, chunk: int,
            name: str = "members") -> DataFrame:
    """COLLECT_LIST of a group's values in order, ``chunk`` values per row.

    A group of any size gives whole results: it becomes several rows, numbered from 0,
    instead of one array that has to fit in a single task.
    """
    by = as_names(by)
    numbered = number_rows(df.select(*by, member, unique_by), by, [member, unique_by], "_rn")
    cut = numbered.withColumn("chunk", F.expr(f"(_rn - 1) div {chunk}"))
    return cut.groupBy(*by, "chunk").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_rn", F.col(member).alias("value")))), lambda pair: pair["value"]
        ).alias(name)
    )


def exact_percentiles(df: DataFrame, by, value: str, points: dict[str, float], *,
                      limit: int | None = MAX_GROUP_ROWS, slices: int | None = None) -> DataFrame:
    """Interpolated percentiles per group, as ``PERCENTILE`` computes them.

    ``percentile`` keeps a counter per distinct value of a group in one task's memory. Here
    the values are counted first (with map-side combine), the counts run up in value order,
    over slices where a group has many values, and the two order statistics around each
    point are picked out by conditional maxima.
    """
    by = as_names(by)
    present = df.select(*by, value).filter(F.col(value).isNotNull())
    # Written, as three steps read it: the input itself is scanned once.
    counted = stash(present.groupBy(*by, value).agg(F.count("*").alias("_rows")), "values")
    if is_small(counted, by, limit):
        group = Window.partitionBy(*by)
        through = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counted.withColumns({"_through": F.sum("_rows").over(through), "_size": F.sum("_rows").over(group)})
    else:
        placed = running(counted, by, [value], {"_through": F.col("_rows")}, limit, slices, unique=True)
        placed = with_group_stats(placed, by, {"_size": F.max("_through")})

    def at(place: Column) -> Column:
        return F.max(F.when((place < F.col("_through")) & (place >= F.col("_through") - F.col("_rows")), F.col(value)))

    picks = [F.max("_size").alias("_size")]
    for name, p in points.items():
        spot = (F.col("_size") - 1) * F.lit(float(p))
        picks += [at(F.floor(spot)).alias(f"_low_{name}"), at(F.ceil(spot)).alias(f"_high_{name}")]
    picked = placed.groupBy(*by).agg(*picks)
    results = []
    for name, p in points.items():
        spot = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        between = (F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high
        results.append(F.when(F.ceil(spot) == F.floor(spot), low.cast("double")).otherwise(between).alias(name))
    return picked.select(*by, *results)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles as one row per statistic."""
    basics = df.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    )
    quartiles = exact_percentiles(df, [], column, {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    one_row = with_one_row(basics, quartiles)
    order = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    return one_row.unpivot([], [F.col(f"`{c}`") for c in order], "statistic", "value")


def with_one_row(left: DataFrame, single: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame (a total) beside another frame's rows."""
    row, types = single.first(), dict(single.dtypes)
    return left.withColumns({name: F.lit(row[name]).cast(kind) for name, kind in types.items()})


def approximate_beside_exact(df: DataFrame, column: str, deviation: float) -> DataFrame:
    """``column, exact, within``: whether the approximate distinct count is at most three standard
    deviations from the exact one, which is counted from the distinct values."""
    exact = df.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count("*").alias("exact"))
    rough = df.agg(F.approx_count_distinct(column, deviation).alias("rough"))
    return with_one_row(exact, rough).select(
        F.lit(column).alias("column"), "exact", (F.abs(F.col("rough") - F.col("exact")) <= 3 * deviation * F.col("exact")).alias("within")
    )
