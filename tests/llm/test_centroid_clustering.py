"""Centroid clustering against plain whole-number k-means."""

import hashlib
import random

import numpy as np

from variantloom.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance int"


def plain(rows, clusters=8, rounds=10):
    kept = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    places = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in kept]
    turn = lambda p: (p[0] is None, hashlib.sha256(f"3:{p[0]}".encode()).hexdigest(), p[1])
    centroids = [p for _, p in sorted(places, key=turn)[:clusters]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p: min((apart(p, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        of = [nearest(p)[1] for _, p in places]
        for k in range(len(centroids)):
            mine = [p for (_, p), c in zip(places, of) if c == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    last = [nearest(p) for _, p in places]
    inertia = [sum(d for d, c in last if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia), digest[k]) for (i, _), (d, k) in zip(places, last)), key=str)


def odd_vectors(n):
    rng = random.Random(n)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, [0.5] * 64) for i in range(6)] + rows[:4] + [(None, [0.25] * 64), (None, [-3.0] * 64), (n + 20, [0.0] * 64)]
    rows += [(n + 30, None), (n + 31, []), (n + 32, [1.0] * 63), (n + 33, [1.0] * 63 + [None]), (n + 34, [1.0] * 63 + [float("nan")])]
    rows += [(n + 35, [float("inf")] * 64), (n + 36, [1.0] * 65)]
    return [(*r, None, "x", 1) for r in rows]


def test_equals_plain(spark):
    rows = odd_vectors(120)
    got = cc.digest(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_few_or_no_vectors(spark):
    few = [(3, [0.1] * 64, None, None, None), (3, [0.1] * 64, None, None, None), (9, [-0.1] * 64, 1, None, None)]
    assert sorted(map(tuple, cc.digest(spark.createDataFrame(few, SCHEMA)).collect()), key=str) == plain(few)
    assert cc.digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert cc.digest(spark.createDataFrame([(1, None, 1, "", 2)], SCHEMA)).count() == 0


def test_bounds_leave_the_result_and_spare_distances():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (8, 64))
    vectors = centres[rng.integers(0, 8, 3000)] + rng.integers(-200, 200, (3000, 64))
    pivots = cc.Pivots(cc.far_apart(vectors[:300], 6))
    cluster, distance, measured = cc.nearest(vectors, pivots.distances(vectors), centres, pivots.distances(centres))
    every = np.stack([cc.squared(vectors, c) for c in centres], 1)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert measured < 3000 * 3


def test_equal_centroids_take_the_smaller_number():
    vectors = np.array([[5] * 64, [7] * 64])
    centroids = np.array([[9] * 64, [6] * 64, [6] * 64])
    pivots = cc.Pivots(vectors[:1])
    cluster, distance, _ = cc.nearest(vectors, pivots.distances(vectors), centroids, pivots.distances(centroids))
    assert cluster.tolist() == [1, 1] and distance.tolist() == [64, 64]
