"""The graph search against brute force, with copies, ties and vectors that take no part; and the pipeline."""

from __future__ import annotations

import math

import numpy as np
import pytest

from variantloom.llm import graph_search


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.asarray(v, np.float32).astype(float))
    ids = np.array([i for i in sorted(good) for _ in good[i]])
    x = np.array([v for i in sorted(good) for v in good[i]])
    out = {}
    for q in sorted(good):
        if q % every == 0:
            far = np.sqrt(((x - good[q][0]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
            out[q] = [(int(ids[j]), far[j]) for j in order]
    return out


@pytest.mark.parametrize("shard_vectors", [10_000, 300])
def test_recall_and_order(spark, shard_vectors):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(1500, 16)).astype(np.float32).tolist())]
    rows += [(2000 + i, rows[200][1]) for i in range(400)]  # a large group of copies, some of them queries
    rows += [(3000, None), (3001, [0.0] * 16), (3100, [float("nan")] * 16), (3200, [float("inf")] + [1.0] * 15), (3300, [None] + [1.0] * 15), (3400, [1.0] * 4), (None, rows[3][1]), rows[7], rows[100]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "'x' as node").repartition(4)
    found = graph_search.nearest(table, shard_vectors=shard_vectors).collect()
    expected = brute([(i, v) for n, (i, v) in enumerate(rows) if n < len(rows) - 2], 100, 10)
    own = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        own.setdefault(r["query_id"], []).append(r)
    assert set(own) == set(expected)
    hits = 0
    for q, rows_of in own.items():
        assert [r["rank"] for r in rows_of] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in rows_of] == sorted((r["score"], r["vec_id"]) for r in rows_of)
        hits += len({r["vec_id"] for r in rows_of} & {i for i, _ in expected[q]})
    assert hits / (10 * len(expected)) >= 0.95
    assert [r["vec_id"] for r in own[200]] == list(range(2000, 2010)) and {r["score"] for r in own[200]} == {0.0}
    assert [r["vec_id"] for r in own[2100]] == [200, *range(2000, 2009)]


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = [tuple(r) for r in graph_search.nearest(table).orderBy("query_id", "rank").collect()]
    assert rows == [(0, 1, 7, 1.0), (0, 2, 100, math.sqrt(2)), (100, 1, 7, 1.0), (100, 2, 0, math.sqrt(2))]
    assert graph_search.nearest(table.limit(0)).count() == 0
    assert graph_search.nearest(table.filter("vec_id = 0")).count() == 0


def test_pruning_keeps_diverse_edges():
    rng = np.random.default_rng(6)
    graph = graph_search.build(rng.normal(size=(400, 8)).astype(np.float32))
    x = graph.vectors.astype(float)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for node in range(0, 400, 37):
        edges = [e for e in graph.edges[node] if e != node]
        assert len(edges) == len(set(edges)) > 2
        for i, a in enumerate(edges):
            assert all(1.2 * far[b, a] > far[node, a] * 0.999 for b in edges[:i])


@pytest.mark.parametrize("kind,spread", [("float", 1e-4), ("double", 1e-9)])
def test_near_copies_are_told_apart(spark, kind, spread):
    """Groups of hundreds of nearly equal vectors, more than a beam holds, against brute force."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    x = np.concatenate([np.repeat(centres, 250, axis=0) + spread * rng.normal(size=(1500, 16)), rng.normal(size=(300, 16))])
    x = rng.permutation(x.astype(np.float32) if kind == "float" else x)
    table = spark.createDataFrame(list(enumerate(x.tolist())), f"vec_id long, embedding array<{kind}>").repartition(3)
    found = {}
    for r in graph_search.nearest(table, every=10).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(found) == set(range(0, len(x), 10)) and {len(v) for v in found.values()} == {10}
    hits = 0
    for q, ids in found.items():
        far = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(ids & set(np.argsort(far)[:10].tolist()))
    assert hits / (10 * len(found)) >= 0.97
