from __future__ import annotations

import random

import numpy as np

from aisleworks.llm import topk

VECTORS = "vec_id long, embedding array<float>"


def plain(rows, k, every=50):
    """All scores of every query, sorted."""
    good = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        good[vec_id] = min(good.get(vec_id, whole), whole)
    found = set()
    for query in (v for v in good if v % every == 0):
        scores = sorted(
            (-sum(a * b for a, b in zip(good[query], vector)), vec_id)
            for vec_id, vector in good.items() if vec_id != query and len(vector) == len(good[query])
        )
        found |= {(query, rank + 1, vec_id, -score) for rank, (score, vec_id) in enumerate(scores[:k])}
    return found


def run(spark, rows, k=5, shard_rows=topk.SHARD_ROWS, schema=VECTORS):
    frame = spark.createDataFrame(rows, schema)
    return {tuple(row) for row in topk.exact_top_k(frame, frame.filter("vec_id % 50 = 0"), k, shard_rows).collect()}


def test_against_all_scores_on_many_shards(spark):
    rand = random.Random(1)
    rows = [(k, [rand.gauss(0, 0.1) for _ in range(8)]) for k in range(1500)]
    assert run(spark, rows, shard_rows=100) == plain(rows, 5)


def test_one_vector_on_a_third_of_the_rows_and_ties(spark):
    rand = random.Random(2)
    rows = [(k, [0.5, 0.25, -0.125] if k % 3 else [rand.choice([-0.5, 0.5]) for _ in range(3)]) for k in range(900)]
    assert run(spark, rows, shard_rows=64) == plain(rows, 5)


def test_given_table(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in tables("embeddings").collect()]
    frame = tables("embeddings")
    found = topk.exact_top_k(frame, frame.filter("vec_id % 50 = 0")).collect()
    assert {tuple(row) for row in found} == plain(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]), (None, [1.0, 1.0]),
            (50, [9.0, 9.0]), (50, [1.0, 1.0]), (1, [3.0, -1.0]), (100, [1.0]), (101, [2.0]), (150, []), (-50, [-3.0, 0.5]), (200, [nan])]
    assert run(spark, rows) == plain(rows, 5)
    assert run(spark, [(k, v, 1, 2) for k, v in rows], schema=VECTORS + ", score int, shard int") == plain(rows, 5)


def test_few_candidates_and_empty_tables(spark):
    assert run(spark, []) == set()
    assert run(spark, [(50, [1.0])]) == set()
    assert run(spark, [(50, [1.0]), (51, [2.0])]) == {(50, 1, 51, 131072)}


def test_large_numbers_stay_exact():
    a, b = np.array([[2**40 + 1, 3]]), np.array([[2**20, 1], [1, 2**40]])
    assert topk._products(a, b).tolist() == [[(2**40 + 1) * 2**20 + 3, 2**40 + 1 + 3 * 2**40]]


def test_bounds_skip_most_leaves():
    """On clustered vectors branch and bound looks at few leaves."""
    rand = np.random.default_rng(0)
    centres = rand.normal(0, 200, (40, 16))
    vectors = np.concatenate([c + rand.normal(0, 3, (200, 16)) for c in centres]).astype(np.int64)
    order, *tree = topk.build_tree(vectors, 100)
    data = [order.astype(np.int64), vectors[order], *tree]
    seen = 0
    original = topk._products

    def counted(q, v):
        nonlocal seen
        seen += len(q) * len(v)
        return original(q, v)

    topk._products = counted
    try:
        topk.search(np.array([-1]), vectors[:1], np.full(1, topk._NO_SCORE), 5, data)
    finally:
        topk._products = original
    assert seen < len(vectors) / 3
