from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, shard int, block int, v string, score int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 0, 0, "v", 1) for i, v in vectors], SCHEMA)


def brute(vectors, k=5):
    """Every row against every other row, repeated ids included."""
    good = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, q) in enumerate(good):
        if i % 50:
            continue
        scores = sorted(
            (-min(sum(a * b for a, b in zip(q, p, strict=False)), 2**63 - 1), j)
            for other, (j, p) in enumerate(good)
            if other != at
        )
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_rows_that_repeat_an_id_all_count(spark):
    vectors = [(1, [2.0, 0.0]), (1, [5.0, 0.0]), (50, [1.0, 0.0]), (50, [3.0, 0.0]), (50, [1.0, 0.0])]
    got = sorted(tuple(r) for r in topk.top_k(table(spark, vectors), F.col("vec_id") % 50 == 0).collect())
    assert got == brute(vectors) and (50, 1, 1, 327_680) in got and len(got) == 12


@pytest.mark.parametrize(("shard_rows", "block_rows"), [(4096, 512), (40, 3)])
def test_matches_brute_force(spark, shard_rows, block_rows):
    rng = np.random.default_rng(0)
    vectors = [(i, (rng.normal(size=6) / 3).tolist()) for i in range(400)]
    vectors += [(i, vectors[7][1]) for i in range(400, 480)]  # many ties
    vectors += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (503, [float("inf")] * 6)]
    vectors += [(None, [1.0] * 6), (504, []), (550, [0.0] * 6), (12, [0.5] * 6), (12, [0.5] * 6)]
    vectors += [(100, [0.25] * 6), (100, [0.5] * 6), (7, [0.75] * 6)]
    df = table(spark, vectors)
    got = topk.top_k(
        df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows
    ).collect()
    assert sorted(tuple(r) for r in got) == brute(vectors)


def test_few_rows_and_large_numbers(spark):
    vectors = [(0, [3e7, -1.0]), (1, [2e7, 5.0]), (2, [2e7, 5.0]), (50, [0.0, 1.0])]
    got = topk.top_k(table(spark, vectors), F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(vectors)
    assert topk.top_k(table(spark, vectors[:1]), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(500, 5)) * 256)
    tree = topk.BallTree.build(np.arange(500), np.arange(500), points, leaf=16)
    queries = np.floor(rng.normal(size=(20, 5)) * 256)
    search = topk.Search(np.arange(20), queries, 5, np.full(20, -np.inf))
    search.tree = tree
    for node in range(len(tree.first)):
        inside = tree.points[tree.first[node] : tree.last[node]]
        bound = search._bound(node, np.arange(20))
        assert (bound >= (queries @ inside.T).max(axis=1)).all()


def test_vectors_move_as_rows_in_bounded_tiles(spark, monkeypatch):
    """No join is left to a size estimate, and several blocks and shards meet in many tiles."""
    monkeypatch.setattr(topk, "TILE_BYTES", 2 << 10, raising=False)
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=4) / 3).tolist()) for i in range(600)] + [(50, [0.5] * 3)] * 2
    found = topk.top_k(table(spark, vectors), F.col("vec_id") % 50 == 0, shard_rows=30, block_rows=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan and "FlatMapCoGroupsInArrow" in plan
    assert sorted(tuple(r) for r in found.collect()) == brute(vectors)


def test_a_leaf_is_visited_once_for_all_queries(monkeypatch):
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(size=(512, 32)) * 256)
    tree = topk.BallTree.build(np.arange(512), np.arange(512), points, leaf=16)
    visits, leaf = [], topk.Search._leaf
    monkeypatch.setattr(topk.Search, "_leaf", lambda s, node, q: visits.append(node) or leaf(s, node, q))
    queries = np.floor(rng.normal(size=(64, 32)) * 256)
    scores, ids = topk.Search(np.arange(1000, 1064), queries, 5, np.full(64, -np.inf)).run(tree)
    assert len(visits) <= 2 * tree.left.count(-1)
    products = queries @ points.T
    assert (scores == -np.sort(-products, axis=1)[:, :5]).all()
    assert (np.take_along_axis(products, ids, 1) == scores).all()
