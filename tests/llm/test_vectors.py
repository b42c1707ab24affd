import math

import numpy as np
import pytest

from larder.llm import queries
from larder.llm import vectors as v

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, least=0.98):
    """``{vec_id: (n_links, component_id)}`` by comparing all pairs; ids are unique."""
    able = [
        (i, np.array(e, float), label)
        for i, e, label in rows
        if label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    ]
    root, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, one, label) in enumerate(able):
        for j, two, other in able[k + 1 :]:
            if label == other and len(one) == len(two) and one @ two / math.sqrt(one @ one) / math.sqrt(two @ two) >= least:
                links[i], links[j] = links[i] + 1, links[j] + 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i in root}


def clusters(seed, sizes, size=16, noise=0.05):
    """Groups of vectors about a centre, some links inside and some not, then vectors of their own."""
    draw = np.random.default_rng(seed)
    rows = []
    for n in sizes:
        centre = draw.standard_normal(size)
        rows += [centre + noise * draw.standard_normal(size) * np.linalg.norm(centre) / 4 for _ in range(n)]
    order = draw.permutation(len(rows))
    return [(int(i), [float(x) for x in rows[k]], int(k % 2)) for i, k in enumerate(order)]


def found(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def test_passes_follow_the_largest_label():
    assert v.passes_for(0, 0.98) == v.passes_for(v.WINDOW, 0.98) == (0, 1)
    before = 1
    for n in (10**3, 10**6, 10**9):
        bits, passes = v.passes_for(n, 0.98)
        assert n / 2**bits <= v.WINDOW and passes > before
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** passes <= v.MISSED
        before = passes


@pytest.mark.parametrize("window, block", [(128, 512), (3, 8)])
def test_components_and_links_equal_brute_force(spark, window, block):
    """With the real windows, and with ones so small that runs, tiles and all passes are needed."""
    rows = clusters(3, [60, 30, 9, 2, 2] + [1] * 60)
    expected = brute(rows)
    assert 300 < sum(n for n, _ in expected.values()) and any(i != c for i, (_, c) in expected.items())
    nodes = spark.createDataFrame(rows, SCHEMA)
    assert found(v.near_vectors(nodes, missed=1e-12, window=window, block=block)) == expected


def test_one_dense_group_is_compared_as_a_whole(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.ones(8) + 0.01 * draw.standard_normal(8)], 1) for i in range(50)]
    assert found(v.near_vectors(spark.createDataFrame(rows, SCHEMA), window=2, block=4)) == {i: (49, 0) for i in range(50)}


def test_copies_are_counted_not_compared(spark):
    rows = [(i, [1.0, 2.0], 1) for i in range(2000)] + [(5000, [1.0, 2.001], 1), (5001, [-1.0, 2.0], 1)]
    expected = {i: (2000, 0) for i in [*range(2000), 5000]} | {5001: (0, 5001)}
    assert found(v.near_vectors(spark.createDataFrame(rows, SCHEMA))) == expected


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1e300, 1e300], 3), (13, [1e-300, 1e-300], 3), (14, [-1.0, 0.0], 1), (15, [1.0, -0.0], 2),
    ]
    expected = brute([r for r in rows if r[0] not in (12, 13)]) | {12: (1, 12), 13: (1, 12)}
    extra = [(*r, "k", 1) for r in rows]
    frame = spark.createDataFrame(extra, SCHEMA + ", key string, node int")
    assert found(v.near_vectors(frame)) == expected
    assert v.near_vectors(frame.limit(0)).collect() == []
    # A row without an id is linked with nothing; a repeated row is one vector; an id may have two vectors.
    more = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1)]
    result = v.near_vectors(spark.createDataFrame(more, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in result) == [
        (0, 0, 0, True), (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False),
    ]


def test_query(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(queries.QUERIES["op12_near_vectors"](spark, small_dir)) == brute(rows)
