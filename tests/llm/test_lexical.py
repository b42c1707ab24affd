import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from larder.llm import lexical as x
from larder.llm import queries

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top=50):
    """All scores of all pairs; ``{(item_id, rank): (doc_id, score)}``, item texts being distinct by id."""
    counts = [(i, Counter(split(text))) for i, text in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(split(text))
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for rank, (score, unnamed, i) in enumerate(sorted(scores)[:top], 1):
            out[item, rank] = (None if unnamed else i, -score)
    return out


def found(frame):
    rows = frame.collect()
    assert frame.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    out = {(r.item_id, r.rank): (r.doc_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def made(seed, n, words=400):
    """Texts whose words are as unevenly common as in prose, some of them copies."""
    draw = random.Random(seed)
    texts = [" ".join(f"w{int(words * draw.random() ** 3)}" for _ in range(draw.choice([1, 5, 40, 200]))) for _ in range(n)]
    return [(i, draw.choice(texts) if draw.random() < 0.3 else text) for i, text in enumerate(texts)]


@pytest.mark.parametrize("top", [1, 7, 50])
def test_ranking_equals_scores_of_all_pairs(spark, top):
    docs, items = made(1, 300), [(i, t) for i, t in made(2, 12)] + [(99, "w0"), (100, "absent words")]
    result = x.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), top)
    assert found(result) == brute(docs, items, top)


def test_bounds_are_never_below_scores():
    draw, loose = np.random.default_rng(3), 0
    for distinct in (1, 5, 20, 300, 5000):
        hashes = draw.integers(0, 2**63, distinct).astype(np.uint64)
        counts = draw.integers(1, 400 if distinct < 20 else 250, distinct)
        totals = x.Totals(10, 5000)
        weights = draw.integers(0, 9000, (distinct + 20, 4)).astype(float)
        every = np.concatenate([hashes, draw.integers(0, 2**63, 20).astype(np.uint64)])
        n = int(counts.sum())
        bound = x.bounds([x.sketch_of(hashes, counts)], np.array([n]), x.Queries(every, weights, {}), totals)[0]
        score = totals.impact(counts, np.int64(n)) @ weights[:distinct]
        assert (bound >= score).all()
        loose += distinct >= 20 and (bound > score).any()
    # Absent terms seldom meet taken coordinates in all arrays.
    assert loose <= 2


def test_a_frequency_beyond_one_byte_is_still_bounded(spark):
    docs = [(1, "a " * 1000 + "b"), (2, "a " * 300 + "c " * 300), (3, "b c"), (4, "d")]
    items = [(1, "a"), (2, "a b c"), (3, "")]
    assert found(x.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_a_text_held_by_most_documents(spark):
    """Copies fill the ranking by doc_id, and do not hide a better document."""
    docs = [(i, "one two two three") for i in range(500, 0, -1)] + [(900, "two two two"), (901, "one")]
    docs += [(1000 + i, f"other text {i}") for i in range(600)]
    items = [(1, "two"), (2, "one three"), (3, "other 7")]
    frame = spark.createDataFrame(docs, DOCS).repartition(4)
    assert found(x.search(frame, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(x, "ITEMS", 5)
    docs, items = made(5, 60), made(6, 12)
    assert found(x.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 3)) == brute(docs, items, 3)


def test_odd_documents(spark, odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    items = [(1, "Word OTHER"), (2, "é 中文"), (None, "ten nine"), (4, None), (5, " . "), (6, "one")]
    extra = spark.createDataFrame([(i, t, 0, 1) for i, t in items * 2], ITEMS + ", rank int, k1 int")
    found_ = x.search(odd_documents, extra)
    rows = defaultdict(list)
    for r in found_.collect():
        rows[r.item_id].append((r.rank, r.doc_id, r.score))
    expected = defaultdict(list)
    for (item, rank), (doc, score) in brute(docs, items).items():
        expected[item].append((rank, doc, score))
    assert {k: sorted(v, key=lambda p: p[0]) for k, v in rows.items()} == dict(expected)
    assert x.search(no_documents, extra).collect() == [] and x.search(odd_documents, extra.limit(0)).collect() == []


def test_query(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert found(queries.QUERIES["op13_lexical_search"](spark, small_dir)) == brute(docs, items)
