"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words (runs of letters) and the words' leading 4 to 8
letters, hashed into ``2**bits`` places. The machine gives a place ``i`` a weight ``w_i`` and a
vector ``v_i``; a document's score is the logistic function of
``b + sum w_i + sum over pairs <v_i, v_j>`` over its terms, so two terms that are harmless apart
(an insult, the mention of a group) can count together.

Training: labelled rows are drawn by the smallest hash of the doc_id, at most ``most_labelled`` of
them (documented bound: the sample and what is learnt from it fit in the driver; 20,000 by
default). Which terms can matter is decided by Spark with a G test of term against label over the
sample; the ``most_terms`` strongest terms are fitted by AdaGrad. Scoring covers every whole text.

Defined cases: a null or empty text has no terms and gets the score of the intercept; repeated
rows are scored alike; a document with several labels counts as toxic if one of them says so;
null labels and null ids are ignored; without any label of both kinds every score is the share of
toxic labels (0 without labels). Input columns named like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import strings, text_of, with_results, written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8)
# Tokens that a worker remembers: with all their terms when learning, with few when scoring.
MOST_LEARNT, MOST_SCORED = 30_000, 300_000


def terms_of(token: str, bits: int) -> list[int]:
    """Hashed terms of one lower-cased piece of text without white space."""
    out = []
    for word in WORD.findall(token):
        names = [f"={word}", *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]
        out += [xxhash.xxh32_intdigest(name) & ((1 << bits) - 1) for name in names]
    return out


class Terms(dict):
    """Token to its terms, or to those that ``slots`` knows; forgets all when it grows too large."""

    def __init__(self, bits: int, slots: dict[int, int] | None = None):
        super().__init__()
        self.bits, self.slots = bits, slots
        self.most = MOST_LEARNT if slots is None else MOST_SCORED

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        found = terms_of(token, self.bits)
        if self.slots is not None:
            found = [self.slots[t] for t in found if t in self.slots]
        value = self[token] = tuple(found)
        return value

    def of(self, text: str) -> set[int]:
        out: set[int] = set()
        for token in set(text.lower().split()):
            if found := self[token]:
                out.update(found)
        return out


@dataclass
class Model:
    bits: int
    slots: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, found: list[int]) -> float:
        v = self.factors[found]
        return self.bias + self.weights[found].sum() + 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())

    def score(self, found: list[int]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.raw(found) if found else self.bias))))


def fit(
    rows: list[list[int]], labels: np.ndarray, size: int, factors: int, epochs: int, rate: float, decay: float,
    batch: int = 256, seed: int = 7,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Intercept, weights and vectors that lower the logistic loss (AdaGrad over mini-batches)."""
    random = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return (-30.0 if share == 0 else 30.0), np.zeros(size), np.zeros((size, factors))
    w, v, b = np.zeros(size), random.normal(0, 0.02, (size, factors)), math.log(share / (1 - share))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, factors), 1e-6), 1e-6
    lengths = np.array([len(r) for r in rows])
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for start in range(0, len(order), batch):
            now = order[start : start + batch]
            owner = np.repeat(np.arange(len(now)), lengths[now])
            at = np.concatenate([np.asarray(rows[i], np.int64) for i in now]).astype(np.int64)
            sums = np.zeros((len(now), factors))
            np.add.at(sums, owner, v[at])
            squares = np.bincount(owner, (v[at] ** 2).sum(1), len(now))
            z = b + np.bincount(owner, w[at], len(now)) + 0.5 * ((sums**2).sum(1) - squares)
            gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[now]
            used, where = np.unique(at, return_inverse=True)
            pull_w = np.bincount(where, gap[owner], len(used)) + decay * w[used]
            pull_v = np.zeros((len(used), factors))
            np.add.at(pull_v, where, gap[owner][:, None] * (sums[owner] - v[at]))
            pull_v += decay * v[used]
            seen_w[used] += pull_w**2
            seen_v[used] += pull_v**2
            w[used] -= rate * pull_w / np.sqrt(seen_w[used])
            v[used] -= 0.2 * rate * pull_v / np.sqrt(seen_v[used])
            seen_b += gap.sum() ** 2
            b -= rate * gap.sum() / math.sqrt(seen_b)
    return b, w, v


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, bits: int = 22, factors: int = 4, epochs: int = 12,
    rate: float = 0.1, decay: float = 0.2, least_g: float = 10.0, most_labelled: int = 20_000, most_terms: int = 5_000,
) -> Model:
    """Learn from the rows of ``labels (doc_id, toxic)`` for which ``usable`` (of doc_id) holds."""
    picked = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    picked = picked.groupBy(F.col("doc_id").cast("bigint").alias("labelled_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    picked = picked.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most_labelled)
    # The sample's size is bounded by its limit, so its ids can go to every executor.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("labelled_id"), text_of().alias("text"))
    texts = texts.join(F.broadcast(picked), "labelled_id").select("labelled_id", "toxic", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(bits)
        for batch in batches:
            found = [sorted(terms.of(text)) for text in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("labelled_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
                names=["labelled_id", "toxic", "terms"],
            )

    sample = written(texts.mapInArrow(work, "labelled_id bigint, toxic int, terms array<int>"), "labelled-terms")
    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term")
    counts = counts.agg(F.count("*").cast("double").alias("n"), F.sum("toxic").cast("double").alias("k"))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    share = positive / total if total else 0.0
    n, k = F.col("n"), F.col("k")
    if 0 < share < 1:
        rest, rest_k = total - n, positive - k
        g = (
            part(k, n * share) + part(n - k, n * (1 - share))
            + part(rest_k, rest * share) + part(rest - rest_k, rest * (1 - share))
        )
        strongest = counts.select("term", g.alias("g")).where(F.col("g") >= least_g)
        kept = [r.term for r in strongest.orderBy(F.desc("g"), "term").limit(most_terms).collect()]
    else:
        kept = []
    slots = {term: i for i, term in enumerate(kept)}
    rows = sample.select("labelled_id", "toxic", F.explode_outer("terms").alias("term"))
    strong = sample.sparkSession.createDataFrame([(t, i) for t, i in slots.items()], "term int, slot int")
    rows = rows.join(F.broadcast(strong), "term", "left").groupBy("labelled_id").agg(
        F.max("toxic").alias("toxic"), F.sort_array(F.collect_set("slot")).alias("slots")
    )
    learnt = sorted(((r.labelled_id, r.toxic, list(r.slots)) for r in rows.collect()), key=lambda r: r[0])
    labels_ = np.array([r[1] for r in learnt], float)
    bias, weights, vectors = fit([r[2] for r in learnt], labels_, len(slots), factors, epochs, rate, decay)
    return Model(bits, slots, bias, weights, vectors)


def scores(docs: DataFrame, model: Model) -> Column:
    """The score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        terms = Terms(own.bits, own.slots)
        for texts in batches:
            yield pd.Series([own.score(sorted(terms.of(text))) for text in texts], dtype=float)

    return score(text_of())


def held_out() -> Column:
    """Rows whose label is never learnt from: crc32 of the doc_id as text, remainder 2 of 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    model = train(docs, labels, ~held_out())
    with_score = with_results(docs, {"score": scores(docs, model)})
    return with_results(
        with_score, {"held_out": held_out(), "score": F.col("score"), "predicted": (F.col("score") >= threshold).cast("int")}
    )


def not_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score stays below the threshold, with their columns."""
    return docs.where(scores(docs, train(docs, labels, ~held_out())) < threshold)
