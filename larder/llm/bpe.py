"""Word-level BPE with word-end marks: encoding by a contiguous rank array, and decoding.

The vocabulary file fixes the format: NFC, white space collapsed, lower case letter by letter,
a split into contractions, runs of letters, single digits and runs of other signs, bytes shown as
letters, and a word-end mark on the last one. A short word is held as its part boundaries, the
parts' ids and the ranks of adjacent parts; the smallest rank (leftmost on ties) is searched, its
boundary deleted and the neighbouring ranks refreshed. Words over ``SHORT`` letters use a heap of
the same ranks, so a text without white space does not cost its length squared. Added tokens in a
text become their ids; decoding joins the parts' names by single spaces, as the file has no decoder.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows are
encoded alike; input columns named like a result are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .tokens import byte_letters

SHORT = 128
NEVER = 1 << 60
ID_BITS = 20
# White space as the format knows it (without the separators U+001C to U+001F).
SPACE = "\t-\r \x85\xa0  -     　"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
MOST_HELD = 300_000


class Held(dict):
    """Results by key, in two generations: what was not used for a while is forgotten."""

    def __init__(self, make: Callable, most: int = MOST_HELD):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def lowered(text: str) -> str:
    """Lower case letter by letter: a final sigma is not special."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class WordEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.names = {i: name for name, i in [*self.ids.items(), *self.added.items()]}
        # Rank and id of what two adjacent parts become, in one integer.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[left], self.ids[right]] = rank << ID_BITS | self.ids[left + right]
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.words = Held(self.word)
        self.chunks = Held(self.chunk)

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one normalized word."""
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.end
        parts = [self.ids[letter] for letter in letters]
        return tuple(self.by_array(parts) if len(parts) <= SHORT else self.by_heap(parts))

    def by_array(self, parts: list[int]) -> list[int]:
        rank = self.merges.get
        bounds = list(range(len(parts) + 1))
        ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            parts[i] = low & ((1 << ID_BITS) - 1)
            del parts[i + 1], bounds[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NEVER)
        return parts

    def by_heap(self, parts: list[int]) -> list[int]:
        rank, n = self.merges.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(low, i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if (low := rank(pair)) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or rank((parts[i], parts[j])) != low:
                continue
            parts[i] = low & ((1 << ID_BITS) - 1)
            gone[j] = True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (new := rank((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0 and (new := rank((parts[before[i]], parts[i]))) is not None:
                heapq.heappush(heap, (new, before[i]))
        return [part for part, dead in zip(parts, gone, strict=True) if not dead]

    def chunk(self, chunk: str) -> tuple[bytes, bytes]:
        """Ids (little-endian, 32 bits) and decoded text of what stands between white space."""
        ids = [i for word in WORD.findall(lowered(unicodedata.normalize("NFC", chunk))) for i in self.words[word]]
        return self.both(ids)

    def both(self, ids: list[int]) -> tuple[bytes, bytes]:
        return np.array(ids, "<u4").tobytes(), " ".join([self.names[i] for i in ids]).encode()

    def pieces(self, text: str) -> list[tuple[bytes, bytes]]:
        if any(token in text for token in self.added):
            out = []
            for i, part in enumerate(self.parts.split(text)):
                out += [self.both([self.added[part]])] if i % 2 else self.pieces(part)
            return out
        if SEPARATORS.search(text):  # they look like white space to split(), but not to the format
            return [self.chunk(text)]
        return list(map(self.chunks.__getitem__, text.split()))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids and decoded text of a whole text."""
        found = self.pieces(text)
        return b"".join([ids for ids, _ in found]), b" ".join([name for _, name in found if name])

    def decode(self, ids: bytes) -> str:
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)


def coded(vocabulary: str) -> Column:
    """``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` text of each row's text."""

    @F.pandas_udf("ids binary, decoded string")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(vocabulary)
        for texts in batches:
            pairs = [encoder.encode(text) for text in texts]
            yield pd.DataFrame({"ids": [p[0] for p in pairs], "decoded": [p[1].decode() for p in pairs]})

    return code(text_of())


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded``."""
    rows = docs.select(F.struct("*").alias("row"), text_of().alias("text"))
    rows = rows.select("row", coded(vocabulary).alias("code"))
    own = {
        "ids": F.col("code.ids"),
        "n_tokens": (F.octet_length("code.ids") / 4).cast("bigint"),
        "decoded": F.col("code.decoded"),
    }
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in own]
    return rows.select(*kept, *[c.alias(name) for name, c in own.items()])
