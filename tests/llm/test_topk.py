import math

import numpy as np
import pytest

from waybill.llm.topk import MTree, top_k

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, is_query, k):
    sound = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in sorted({one for one in sound if is_query(one[0])}):
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i and len(v) == len(q))
        out += [(i, rank, j, -score) for rank, (score, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_against_brute_force(spark):
    random = np.random.default_rng(1)
    centres = random.normal(0, 1, (5, 12))
    rows = [(i, (centres[i % 5] + random.normal(0, 0.3, 12)).tolist()) for i in range(600)]
    rows += [(600 + i, rows[i][1]) for i in range(0, 50, 3)]  # equal vectors
    rows += [(5, rows[7][1]), (20, rows[0][1]), (20, rows[0][1])]  # repeated ids and rows
    rows += [(1000 + i, random.normal(0, 1, 3).tolist()) for i in range(4)]  # another width
    rows += [(700, None), (710, [1.0] * 11 + [None]), (720, [1.0] * 11 + [float("nan")]), (730, [float("inf")] * 12),
             (None, [1.0] * 12), (740, []), (750, [])]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = top_k(docs, "vec_id % 10 = 0", 5, tree_rows=100, block_queries=20)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0, 5)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5])]
    assert [tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), "vec_id % 50 = 0").collect()] == [(0, 1, 1, 384 * 256)]
    assert top_k(spark.createDataFrame(rows[1:], SCHEMA), "vec_id % 50 = 0").count() == 0
    assert top_k(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").count() == 0


@pytest.mark.parametrize("page", [4, 32])
def test_pruning_keeps_results(page):
    """The search passes over entries and still finds all ties."""
    random = np.random.default_rng(2)
    vectors = np.floor(random.normal(0, 3, (20, 4))[random.integers(0, 20, 800)] + random.integers(0, 2, (800, 4)))
    length = float((vectors * vectors).sum(axis=1).max())
    tree = MTree(vectors, length, page)
    ids = random.permutation(800)
    for q in range(0, 800, 37):
        scores = vectors @ vectors[q]
        expected = sorted((-s, i) for s, i in zip(scores, ids) if i != ids[q])[:5]
        assert tree.search(vectors[q], ids, int(ids[q]), 5) == [(int(-s), int(i)) for s, i in expected]


def test_covering_radii():
    random = np.random.default_rng(3)
    vectors = np.floor(random.normal(0, 50, (500, 6)))
    tree = MTree(vectors, float((vectors * vectors).sum(axis=1).max()), 16)

    def rows_below(page):
        return page.rows if page.pages is None else np.concatenate([rows_below(p) for p in page.pages])

    def check(page):
        for i, inner in enumerate(page.pages or []):
            away = tree._distances(page.rows[i], rows_below(inner))
            assert away.max() <= page.radii[i] + 1e-6
            check(inner)

    check(tree.root)
    assert sorted(rows_below(tree.root)) == list(range(500))
