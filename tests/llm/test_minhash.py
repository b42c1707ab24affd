import random
from itertools import combinations

import numpy as np

from larder.llm import minhash as m
from larder.llm import queries


def brute(texts: dict, words: int) -> dict:
    """Component of each id by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        n = min(words, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(seed: int, size: int, edits: int) -> list[str]:
    """Copies of one text with random words changed."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(60)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_equal_brute_force_in_small_and_large_buckets(spark):
    texts = dict(enumerate(family(1, 90, 8) + family(2, 5, 2) + ["a b", "A  B", "a", "", "b a"], start=1))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    expected = brute(texts, 2)
    for small in (2, 32, 1000):  # every bucket crowded, some, none
        found = {r.doc_id: r for r in m.near_duplicates(docs, words=2, small=small).collect()}
        assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected
        assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_picking_sets_changes_nothing(spark):
    texts = dict(enumerate(family(3, 20, 6), start=1))
    sets = m.signed(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), 2, 32, 4)
    pairs = spark.createDataFrame([(a, b) for a in range(1, 11) for b in range(a + 1, 11)], "a bigint, b bigint")
    picked = m.only_of(sets, pairs)
    assert picked.count() == 10 and m.only_of(sets, pairs, most=3).count() == 20
    every = m.verified(pairs, sets, 80)
    assert every.exceptAll(m.verified(pairs, picked, 80)).isEmpty() and not every.isEmpty()


def test_sketches_agree_as_often_as_sets_are_alike():
    random_ = np.random.default_rng(3)
    for n in (1, 3, 40, 1000):
        one = np.unique(random_.integers(0, 2**48, n, dtype=np.uint64))
        same = m.sketches([one, one], 128)
        assert (same[0] == same[1]).all() and (same != np.uint64(2**64 - 1)).all()
    a = random_.integers(0, 2**48, 600, dtype=np.uint64)
    pair = m.sketches([np.unique(a[:500]), np.unique(a[100:])], 512)
    assert abs((pair[0] == pair[1]).mean() - 400 / 600) < 0.1


def test_packed_sets_and_blocks():
    sets = [m.shingle_set(t, 2, m.WordHashes()) for t in ("a b c d e", "A b\tc d  e", "a b c d x", "q")]
    assert (sets[0] == sets[1]).all() and all((m.unpacked(m.packed(s)) == s).all() for s in sets)
    hits = m.block_links(sets[:2], sets, 60)
    assert hits.tolist() == [[True, True, True, False]] * 2


def test_sets_keep_whole_hashes():
    elements = np.array([2**63 + 5, 2**63 + 2**48 + 5, 2**64 - 1], np.uint64)
    assert m.unpacked(m.packed(elements)).tolist() == elements.tolist()
    assert m.shingle_set(" ".join(map(str, range(1000))), 1, m.WordHashes()).max() >= 2**48


def test_odd_documents(odd_documents, no_documents):
    found = m.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == [(6, 1, True)] * 2 and by_id[7] == [(6, 1, False)]
    assert by_id[None] == [(6, None, True)]
    assert by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)] and by_id[4] == [(0, 4, True)]
    assert m.near_duplicates(no_documents).collect() == []
    stay = m.one_of_each(odd_documents)
    assert stay.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in stay.collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_components_of_many_and_few_edges(spark):
    """The steps for many edges and the single task for few give the same components."""
    draw = random.Random(12)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = list(range(1100))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    for few in (0, 10**6):
        found = {(r.node, r.component) for r in m.components(frame, "test", few).collect()}
        assert found == {(n, find(n)) for n in nodes}
        assert m.components(frame.limit(0), "test", few).collect() == []


def test_one_id_with_two_texts(spark):
    """Links follow texts: a row is not dragged along by another row of its id."""
    text = " ".join(f"w{i}" for i in range(40))
    given = [(1, text), (5, text + " more"), (5, "a text of its own entirely"), (7, "a text of its own entirely"), (9, text)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    found = {(r.doc_id, r.n_shingles): r.component_id for r in m.near_duplicates(docs, words=5).collect()}
    assert found == {(1, 36): 1, (5, 37): 1, (5, 2): 5, (7, 2): 5, (9, 36): 1}
    assert sorted(tuple(r) for r in m.one_of_each(docs).collect()) == [(1, text), (5, "a text of its own entirely")]


def test_copies_are_verified_once(spark, monkeypatch):
    """400 rows of each of two linked texts: one pair of sets is compared."""
    text = " ".join(f"w{i}" for i in range(60))
    given = [(i, text) for i in range(400)] + [(400 + i, text + " end") for i in range(400)] + [(7, text)] * 5
    compared, verified = [], m.verified

    def spy(pairs, sets, percent):
        found = verified(pairs, sets, percent)
        compared.append((pairs.count(), found.count()))
        return found

    monkeypatch.setattr(m, "verified", spy)
    rows = m.near_duplicates(spark.createDataFrame(given, "doc_id bigint, text string"), words=2).collect()
    assert len(rows) == 805 and {r.component_id for r in rows} == {0}
    assert sum(p for p, _ in compared) == sum(f for _, f in compared) == 1


def test_edges_stay_near_the_number_of_documents(spark, monkeypatch):
    """A dense group gives one edge a document and round, not one a band or pair."""
    texts = dict(enumerate(family(9, 400, 3), start=1))
    edges, real = [], m.components

    def spy(frame, name):
        edges.append(frame.count())
        return real(frame, name, few=0)

    monkeypatch.setattr(m, "components", spy)
    found = m.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), words=2, small=8)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(texts, 2)
    assert max(edges) <= 2 * len(texts)


def test_family_blocks_meet_in_every_partition(spark, monkeypatch):
    """Both sides of a block are dealt alike, however many partitions there are."""
    monkeypatch.setattr(m, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(m, "BLOCK_RESTS", 16)
    texts = dict(enumerate(family(21, 60, 9), start=1))
    expected = brute(texts, 2)
    assert 1 < len({c for _, c in expected.values()}) < 60
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    many = spark.createDataFrame([(i, 1, 1, 60) for i in texts], "node bigint, bucket bigint, pivot bigint, members bigint")
    alone = spark.createDataFrame([(i, i) for i in texts], "node bigint, component bigint")
    items = m.signed(docs, 2, 32, 4).select("doc_id", "elements")

    def compare(left, right):
        return m.block_links(list(map(m.unpacked, left)), list(map(m.unpacked, right)), 80)

    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        links = m.components(m.family_links(many, alone, items, compare), "test")
        found = {r.node: r.component for r in links.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {i: found.get(i, i) for i in texts} == {i: c for i, (_, c) in expected.items()}


def test_query(spark, small_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op3_near_duplicates"](spark, small_dir).collect()}
    assert found == brute(texts, 2)
