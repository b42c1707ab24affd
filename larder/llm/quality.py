"""Quality rules, line first, in Spark expressions only.

Base figures of a whole text (words are ``[^\\x20\\x09-\\x0D]+``): ``n_words``, ``word_chars``,
``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier line)
and ``n_repeat_words`` (words inside 8-word windows that occur twice or more in the text).
``base_failed``: under 20 words, or over 30 % repeated words.

The method then judges each line that has a word by itself. A line goes if it

* does not end like prose (an end mark, closing quotes or brackets may follow),
* holds a mark of page furniture (cookie notices, "click here", sign-in links),
* is over a tenth symbols, or
* equals an earlier line.

What is left is the cleaned text. A document is rejected if the base rules fail or if over
``most_lost`` percent of its word characters went.

Defined cases: a null or empty text has no words and fails; repeated rows are judged alike; input
columns named like a result are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Marks of page furniture, and how a line of prose may end.
FURNITURE = [
    "all rights reserved", "click here", "cookie policy", "enable javascript", "privacy policy", "read more",
    "sign in", "skip to content", "subscribe to", "terms of use",
]
MARKS = ".!?:;\u2026\u3002\uff01\uff1f\u061f\u06d4\u0964"
CLOSERS = "]\"')}\u00bb\u201d\u2019"


def without(text: Column, characters: str) -> Column:
    """Plain replacements are several times as fast as ``translate`` or a regular expression."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)


def blank(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES)) == ""


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, b: a + b)


def free_prefix(columns: list[str]) -> str:
    prefix = "_q"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def has_furniture(lowered: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(mark)) for mark in FURNITURE])


def line_stays(line: Column, symbols: Column, furniture: Column) -> Column:
    """The rules that need only the line itself; the last two run where the text has cause for them."""
    end = F.rtrim(line, F.lit(CLOSERS + SPACES))
    prose = reduce(lambda a, b: a | b, [F.endswith(end, F.lit(mark)) for mark in MARKS])
    count = F.length(line) - F.length(without(line, SYMBOLS))
    return prose & (~symbols | (10 * count <= F.length(line))) & (~furniture | ~has_furniture(F.lower(line)))


def pinned(df: DataFrame, prefix: str, columns: dict[str, Column], dropped: tuple[str, ...] = ()) -> DataFrame:
    """Add columns that are computed once for each row.

    A projection may be merged into later ones, and a filter pushed below it, which repeats what it
    computes for each element of a later lambda. Neither crosses the explosion of one element.
    """
    one = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias(f"{prefix}one")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in dropped]
    rows = df.select(*kept, one)
    return rows.select(*kept, *[F.col(f"{prefix}one.`{name}`").alias(name) for name in columns])


def cleaned(docs: DataFrame, most_lost: int = 50) -> DataFrame:
    """``docs`` with the base figures, ``base_failed``, ``kept`` and ``clean_text``."""
    p = free_prefix(docs.columns)
    text, lines, filled, codes, windows, pairs, places, ordered, again = (
        f"{p}{n}" for n in ("text", "lines", "filled", "codes", "windows", "pairs", "places", "ordered", "again")
    )
    step = docs.withColumn(text, text_of())
    words = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")
    step = pinned(
        step, p,
        {
            codes: F.transform(words, lambda w: F.xxhash64(w)),
            lines: F.split(text, "\n"),
            f"{p}symbols": F.length(text) - F.length(without(F.col(text), SYMBOLS)),
            f"{p}chars": F.length(without(F.col(text), SPACES)),
            f"{p}lower": F.lower(text),
        },
    )
    step = pinned(step, p, {f"{p}furniture": has_furniture(F.col(f"{p}lower"))}, (f"{p}lower", text))
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(1), F.size(codes) - (WINDOW - 1))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(codes), i + k - 1) for k in range(WINDOW)]))
    step = pinned(
        step, p,
        {
            windows: F.when(F.size(codes) >= WINDOW, hashed).otherwise(none),
            filled: F.filter(lines, lambda x: ~blank(x)),
            f"{p}n": F.size(codes),
        },
        (codes,),
    )
    # Places in hash order show repeats as equal neighbours; sorted only where there are any.
    no_pairs = F.array().cast("array<struct<h:bigint,i:int>>")
    dups = F.size(filled) - F.size(F.array_distinct(filled))
    step = pinned(step, p, {f"{p}dups": dups}, (filled,))
    step = pinned(
        step, p,
        {
            pairs: F.when(
                F.size(F.array_distinct(windows)) < F.size(windows),
                F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(no_pairs),
            ordered: F.when(
                F.col(f"{p}dups") > 0,
                F.sort_array(F.transform(lines, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i")))),
            ).otherwise(no_pairs),
        },
        (windows,),
    )

    def near(array: str, at: Column) -> Column:
        return F.get(array, at)["h"]

    twice = F.filter(
        pairs, lambda x, k: x["h"].eqNullSafe(near(pairs, k - 1)) | x["h"].eqNullSafe(near(pairs, k + 1))
    )
    flags = F.transform(
        ordered, lambda x, k: F.struct(x["i"].alias("i"), x["h"].eqNullSafe(near(ordered, k - 1)).alias("d"))
    )
    step = pinned(
        step, p,
        {
            places: F.sort_array(F.transform(twice, lambda x: x["i"])),
            again: F.transform(F.sort_array(flags), lambda x: x["d"]),
        },
        (pairs, ordered),
    )
    covered = F.transform(
        places, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(places), k + 1) - x, F.lit(WINDOW))).cast("bigint")
    )
    staying = F.filter(
        lines,
        lambda x, k: blank(x)
        | (
            line_stays(x, F.col(f"{p}symbols") > 0, F.col(f"{p}furniture"))
            & ~F.coalesce(F.get(F.col(again), k), F.lit(False))
        ),
    )
    step = pinned(
        step, p, {f"{p}repeat": total(covered), f"{p}clean": F.array_join(staying, "\n")}, (places, again, lines)
    )
    n, chars = F.col(f"{p}n"), F.col(f"{p}chars")
    left = F.length(without(F.col(f"{p}clean"), SPACES))
    step = pinned(
        step, p,
        {
            f"{p}failed": (n < 20) | (100 * F.col(f"{p}repeat") > 30 * n),
            f"{p}lost": 100 * (chars - left) > most_lost * chars,
        },
    )
    failed = F.col(f"{p}failed")
    results = {
        "n_words": n.cast("bigint"),
        "word_chars": F.col(f"{p}chars").cast("bigint"),
        "n_symbols": F.col(f"{p}symbols").cast("bigint"),
        "n_dup_lines": F.col(f"{p}dups").cast("bigint"),
        "n_repeat_words": F.col(f"{p}repeat"),
        "base_failed": failed,
        "kept": ~failed & ~F.col(f"{p}lost"),
        "clean_text": F.col(f"{p}clean"),
    }
    taken = {name.lower() for name in results}
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return step.select(*own, *[c.alias(name) for name, c in results.items()])


def clean_documents(docs: DataFrame, most_lost: int = 50) -> DataFrame:
    """The documents that stay, with cleaned texts and their new ``n_chars``; same columns."""
    judged = cleaned(docs.select(F.struct("*").alias("row"), text_of().alias("text")), most_lost).where("kept")
    columns = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name.lower() == "text":
            column = F.col("clean_text")
        elif name.lower() == "n_chars":
            column = F.length("clean_text").cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return judged.select(*columns)
