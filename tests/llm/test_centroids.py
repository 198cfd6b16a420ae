from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from matchlytics.llm.centroids import Rotation, cluster, exact, nearest

WIDTH = 4
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("distance", T.StringType()), T.StructField("c0", T.StringType())])


def plain(rows, clusters, rounds, scale=64):
    """Brute force with Python's integers."""
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in rows if v and len(v) == WIDTH and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds if centroids else 0):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted((str(i), k, str(fits(d)), str(fits(inertia[k])), str(fits(sum(inertia))), [str(x) for x in centroids[k]]) for (i, _), (d, k) in zip(kept, found))


def run(spark, rows, clusters, rounds):
    df = spark.createDataFrame([(i, v, "mine", "extra") for i, v in rows], SCHEMA).repartition(3)
    got = cluster(df, clusters, rounds, WIDTH, lead=2)
    assert got.columns == ["vec_id", "embedding", "c0", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert got.where(F.col("c0") != "extra").count() == 0
    return sorted((str(r.vec_id), r.cluster, str(r.distance), str(r.cluster_inertia), str(r.inertia), r.centroid) for r in got.collect())


def test_equals_brute_force_with_ties_repeats_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, WIDTH).astype(float).tolist()) for i in range(300)]  # many ties
    rows += rows[:40] + [(7, [9.0, 9.0, 9.0, 9.0]), (None, [0.5, -0.5, 0.25, 0.0]), (None, None), (900, []), (901, [1.0] * 3), (902, [1.0] * 5)]
    rows += [(903, [1.0, None, 0.0, 0.0]), (904, [float("nan"), 0.0, 0.0, 0.0]), (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [-0.001, 0.0, 1 / 128, 0.0])]
    assert run(spark, rows, 7, 3) == plain(rows, 7, 3)


def test_vectors_beyond_64_bits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=WIDTH).tolist()) for i in range(60)]
    rows += [(100, [1e9, 0.0, 0.0, 0.0]), (101, [-1e15, 1e15, 3.0, 0.0]), (102, [1.7e308, 0.0, -1.7e308, 0.0]), (103, [1e160, 1e160, 0.0, 1.0])]
    for clusters in (3, 64):
        assert run(spark, rows, clusters, 2) == plain(rows, clusters, 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0, 3.0, 4.0])], [(1, [0.0] * WIDTH)] * 5])
def test_fewer_vectors_than_centroids(spark, rows):
    assert run(spark, rows, 3, 2) == plain(rows, 3, 2)


def test_bounds_leave_few_distances_and_miss_none():
    rng = np.random.default_rng(5)
    centers = rng.integers(-500, 500, (16, 64))
    rows = (centers[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 64))).astype(np.int64)
    _, axes = np.linalg.eigh(np.cov(rows.T.astype(float)))
    turned = Rotation(rows.mean(0), axes[:, ::-1], 12)
    centroids = [[int(x) for x in c] for c in centers]
    number, distance, verified = nearest(rows, turned.project(rows), centroids, turned.project(np.array(centroids, object)))
    every = np.stack([exact(rows, c) for c in centroids], 1)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert verified < 2 * len(rows)
