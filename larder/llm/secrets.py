"""Secrets in texts: key patterns, and guess costs of values in the context of credentials.

Base kinds, each leftmost and without overlaps, offsets in code points, ends exclusive:

* ``assign``: a key word, ``:`` or ``=``, and a value of 6 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 20 or more in all;
* ``hex``: 24 or more of ``0-9a-f``.

The method adds spans of kind ``guess``: a value after a credential word (a wider list than the
base kind's, with ``:``, ``=`` or "is") for which the cheapest way to guess it costs at least
``10**least`` attempts. The cost is a minimum over all segmentations of the value into dictionary
words (rank times case and letter-for-digit variants), dates, repeats, keyboard walks and brute
force, found by dynamic programming: ``best[j] = min over i of best[i] + cost(i, j)`` in logarithms,
plus ``log10(k!)`` for the order of the ``k`` segments, as an attacker does not know it. The
dictionary is the word list of a public vocabulary file, in the order of its ids.

Defined cases: a null or empty text has no spans; values of any length are segmented, but not
beyond the bound that decides; repeated rows are scanned alike; input columns named like a result
are replaced.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Fixed values of the base kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|login|api[ _-]?key|private[ _-]?key|"
    r"access[ _-]?key|auth(?:orization)?|bearer)[\"']?\x20*(?:[:=]|\x20is\x20)\x20*[\"']?([^\s\"'<>,;]{6,})",
    re.IGNORECASE | re.ASCII,
)
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
SWAPS = str.maketrans("4@8310$57!", "aabeiosstl")
# Attempts to guess one character by brute force, as a power of ten.
BRUTE = 1.0
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)"
    r"(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d"
)


@lru_cache(2)
def dictionary(path: str) -> dict[str, int]:
    """Words of three letters or more of a vocabulary file, to their rank from 1 on."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = (token.removesuffix("</w>") for token, _ in sorted(vocabulary.items(), key=lambda x: x[1]))
    ranks: dict[str, int] = {}
    for word in words:
        if len(word) >= 3 and word.isascii() and word.isalpha() and word not in ranks:
            ranks[word] = len(ranks) + 1
    return ranks


def variants(piece: str) -> float:
    """Log10 of the spellings that differ in case."""
    upper = sum(c.isupper() for c in piece)
    if upper == 0:
        return 0.0
    if upper == len(piece) or piece[0].isupper() and upper == 1:
        return math.log10(2)
    return math.log10(max(2, sum(math.comb(len(piece), k) for k in range(1, min(upper, len(piece) - upper) + 1))))


@lru_cache(1)
def neighbours() -> set[tuple[str, str]]:
    pairs = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}
    return pairs | {(b, a) for a, b in pairs}


def segments(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """``(start, end, log10 of the attempts)`` of everything that is cheaper than brute force."""
    low, n = value.lower(), len(value)
    plain = low.translate(SWAPS)
    for i in range(n):
        for j in range(i + 3, min(n, i + 24) + 1):
            if (rank := ranks.get(low[i:j])) is not None:
                yield i, j, math.log10(rank) + variants(value[i:j])
            elif (rank := ranks.get(plain[i:j])) is not None:
                yield i, j, math.log10(rank) + variants(value[i:j]) + math.log10(2) * sum(
                    a != b for a, b in zip(low[i:j], plain[i:j], strict=True)
                )
    for i in range(n):
        if found := DATE.match(value, i):
            yield i, found.end(), math.log10(200) if found.end() - i == 4 else math.log10(365 * 200 * 4)
    for unit in range(1, 9):  # repeats of a unit of one to eight characters
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while value[j : j + unit] == value[i : i + unit] and j + unit <= n:
                j += unit
            if j - i >= max(3, 2 * unit):
                yield i, j, min(unit * BRUTE, 2.0 + unit * 0.5) + math.log10((j - i) / unit)
                i = j - unit + 1
            else:
                i += 1
    start = 0
    pairs = neighbours()
    for i in range(1, n + 1):  # walks on the keyboard, turns cost extra
        if i == n or (low[i - 1], low[i]) not in pairs:
            if i - start >= 4:
                steps = [(ord(b) > ord(a)) for a, b in zip(low[start:i], low[start + 1 : i], strict=False)]
                turns = sum(a != b for a, b in zip(steps, steps[1:], strict=False))
                yield start, i, math.log10(47 * 2 * (i - start)) + 0.6 * turns
            start = i


def guess_cost(value: str, ranks: dict[str, int], most: float = math.inf) -> float:
    """Log10 of the attempts that the cheapest segmentation of a value takes, or ``most`` if that is less.

    What costs ``most`` on the way is not followed further, so a low bound keeps the work near linear.
    """
    n = len(value)
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in segments(value, ranks):
        if cost < most:
            ending[j].append((i, cost))
    orders = [0.0]  # log10(k!)
    # best[j][k]: cheapest product for the first j characters in k segments.
    best: list[dict[int, float]] = [{0: 0.0}] + [{} for _ in range(n)]
    brute: dict[int, float] = {}  # the last segment is brute force
    for j in range(1, n + 1):
        if len(orders) <= j:
            orders.append(orders[-1] + math.log10(j))
        options = [(k + 1, c + BRUTE) for k, c in best[j - 1].items()]
        options += [(k, c + BRUTE) for k, c in brute.items()]
        brute = {}
        for k, cost in options:
            if cost + orders[k] < min(most, brute.get(k, math.inf) + orders[k]):
                brute[k] = cost
        merged = dict(brute)
        for i, cost in ending[j]:
            for k, before in best[i].items():
                if before + cost < merged.get(k + 1, math.inf) and before + cost + orders[k + 1] < most:
                    merged[k + 1] = before + cost
        # More segments than another way and no cheaper: never better later on.
        kept, low = {}, math.inf
        for k in sorted(merged):
            if merged[k] < low:
                kept[k] = low = merged[k]
        best[j] = kept
    return min([cost + orders[k] for k, cost in best[n].items()], default=most)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, ranks: dict[str, int], least: float) -> list[tuple[int, int, int]]:
    found = []
    for m in CONTEXT.finditer(text):
        value = m.group(1).rstrip(".!?)]}")
        if len(value) >= 6 and guess_cost(value, ranks, least) >= least:
            found.append((m.start(1), 3, m.start(1) + len(value)))
    return found


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


RESULT = "n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string, redacted string"


def scan(vocabulary: str, least: float = 8.0, rewrite: bool = False) -> Column:
    """A struct of the findings in each row's whole text; ``rewrite`` fills ``redacted``."""

    @F.pandas_udf(RESULT)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks = dictionary(vocabulary)
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text)
                every = sorted(base + guess_spans(text, ranks, least))
                counts = [sum(kind == k for _, kind, _ in every) for k in range(4)]
                digest = hashlib.sha256(shown(base).encode()).hexdigest()
                new = redacted(text, every) if rewrite else None
                rows.append((*counts, digest, shown(every), new))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return found(text_of())


def secrets(docs: DataFrame, vocabulary: str, least: float = 8.0) -> DataFrame:
    """``docs`` with the numbers of spans by kind, the digest of the base spans, and all spans."""
    names = ["n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"]
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    rows = rows.select("row", scan(vocabulary, least).alias("found"))
    own = {name: F.col(f"found.{name}") for name in names}
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in own]
    return rows.select(*kept, *[c.alias(name) for name, c in own.items()])


def redact(docs: DataFrame, vocabulary: str, least: float = 8.0) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; ``n_chars`` follows; same columns."""
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    rows = rows.select("row", scan(vocabulary, least, rewrite=True)["redacted"].alias("new"))
    columns = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name.lower() == "text":
            column = F.col("new")
        elif name.lower() == "n_chars":
            column = F.length("new").cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return rows.select(*columns)
