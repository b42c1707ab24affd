"""Column expressions, all JVM-side so they stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import PHONE_MARKS, PHONE_MARKS_AND_SPACES

# --- labels -------------------------------------------------------------------


def ladder(value: Column, steps, rest: str, *, null_label: str | None = None, inclusive: bool = True) -> Column:
    """Label a number by the first threshold it reaches.

    ``steps`` lists ``(bound, label)`` from the highest bound down. Without
    ``null_label`` a null falls through to ``rest``, as it does in a SQL CASE.
    """
    branches = [(value >= bound if inclusive else value > bound, label) for bound, label in steps]
    if null_label is not None:
        branches.insert(0, (value.isNull(), null_label))
    first, *others = branches
    chain = reduce(lambda c, b: c.when(b[0], F.lit(b[1])), others, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit(rest))


def lookup(value: Column, names: dict, rest=None) -> Column:
    """Replace a code by its name through a literal map."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(rest))


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit a number to a range; null stays null (``greatest``/``least`` skip nulls)."""
    return F.when(value > high, F.lit(high)).when(value < low, F.lit(low)).otherwise(value)


# --- text ---------------------------------------------------------------------


def clean_phone(value: Column, *, keep_spaces: bool = True) -> Column:
    return F.regexp_replace(value, PHONE_MARKS if keep_spaces else PHONE_MARKS_AND_SPACES, "")


def normalized(value: Column, default: str) -> Column:
    """Trimmed upper case, with a default in place of null."""
    return F.coalesce(F.upper(F.trim(value)), F.lit(default))


def sentence_case(value: Column) -> Column:
    """First letter up, all the rest down (``initcap`` would raise every word)."""
    return F.concat(F.upper(F.left(value, F.lit(1))), F.lower(F.substring(value, 2, 1 << 30)))


# --- numbers ------------------------------------------------------------------


def ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """Quotient that is null, not an error, for a zero divisor."""
    quotient = F.try_divide(top, bottom)
    return quotient if digits is None else F.round(quotient, digits)


def root_score(rating: Column, reviews: Column, scale: float = 1000.0, top: float | None = None) -> Column:
    """Popularity: rating times the square root of the scaled review count.

    With ``top`` the rating is first brought to 0–1.
    """
    weight = F.sqrt(reviews / F.lit(float(scale)))
    return weight * (rating if top is None else unit_scale(rating, top))


def log_score(rating: Column, reviews: Column) -> Column:
    return rating * rating * F.log1p(reviews) / F.lit(10.0)


def unit_scale(value: Column, top: float) -> Column:
    return value / F.lit(float(top))


def money(value: Column) -> Column:
    """Exact cents as a decimal: sums of doubles depend on the order in which tasks finish."""
    return value.cast("decimal(12,2)")


def money_total(value: Column) -> Column:
    """Exact sum of amounts with two decimals.

    Adds whole cents as two long integers, which stay in generated code; summing decimals
    would make an object per row. The high part (multiples of 2**20) and the low part are
    joined once per group, so even a total over all tables has room.
    """
    cents = F.rint(value * 100).cast("bigint")
    high = F.sum(F.shiftright(cents, 20)).cast("decimal(20,0)")
    low = F.sum(cents.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    return (high * F.lit(1 << 20) + low) * F.lit(Decimal("0.01"))


def money_sum(value: Column) -> Column:
    return money_total(value).cast("double")


def money_avg(value: Column, digits: int = 2) -> Column:
    return F.round(money_sum(value) / F.nullif(F.count(value), F.lit(0)), digits)


# The wide decimal of a steady mean holds numbers below this.
STEADY_BOUND = 1e18


def steady_avg(value: Column, digits: int = 2) -> Column:
    """Rounded mean that does not depend on the order of the rows, of values with up to ten decimals.

    Finite values are summed as a wide decimal. Others act as in a plain mean: a NaN, or infinities of both signs,
    make it NaN, and infinities of one sign make it that infinity. If a finite value is too large
    for the decimal (``STEADY_BOUND``), the plain mean is given.
    """
    number = value.cast("double")
    size, nan, endless = F.abs(number), F.lit(float("nan")), F.lit(float("inf"))
    total = F.sum(F.when(size < STEADY_BOUND, number).try_cast("decimal(28,10)")).cast("double")
    mean = F.round(total / F.nullif(F.count(value), F.lit(0)), digits)
    up, down = F.bool_or(number == endless), F.bool_or(number == -endless)
    odd = F.when(F.bool_or(F.isnan(number)) | (up & down), nan).when(up, endless).when(down, -endless)
    plain = F.when(F.bool_or((size >= STEADY_BOUND) & (size < endless)), F.round(F.avg(number), digits))
    return F.coalesce(odd, plain, mean)


# --- dates --------------------------------------------------------------------


def date_parts(df: DataFrame, column: str, parts=("year", "month", "dayofweek")) -> DataFrame:
    """Add calendar parts; text that is not a date gives nulls, not a failed job."""
    as_date = F.try_to_date(F.col(column)) if dict(df.dtypes)[column] == "string" else F.to_date(column)
    return df.withColumns({part: getattr(F, part)(as_date) for part in parts})


def parse_timestamp(value: Column, pattern: str | None = None) -> Column:
    return F.try_to_timestamp(value, F.lit(pattern)) if pattern else F.try_to_timestamp(value)


# --- salts --------------------------------------------------------------------


def random_salt(buckets: int, seed: int | None = None) -> Column:
    """A random bucket. Not stable when a task runs again: keep it out of the keys of
    a shuffle whose rows must survive a lost executor; use :func:`stable_salt` there."""
    return F.floor(F.rand(seed) * buckets).cast("int")


def stable_salt(buckets: int, *columns: str) -> Column:
    """A bucket from the row's own content, the same on every attempt of a task."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def every_salt(buckets: int) -> Column:
    """All buckets as rows, for the copied side of a salted join."""
    return F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
