from __future__ import annotations

import hashlib

import numpy as np
import pytest

from pactlake.llm.clustering import centroid_digest, cluster, described, updated
from pactlake.llm.vectors import LARGEST, floor_means, products

WIDTH = 8


def brute_force(rows, clusters, rounds, scale, seed):
    """Lloyd's rounds over plain integers, every distance measured."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == WIDTH and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, tuple(int(np.floor(scale * float(np.float32(x)))) for x in vector)))
    number = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (number(r[0]), r[1]))[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)].append(v)
        centroids = [tuple(sum(x) // len(m) for x in zip(*m, strict=True)) if m else c for m, c in zip(members, centroids, strict=True)]
    return sorted((str(i), nearest(v), far(v, centroids[nearest(v)])) for i, v in kept), centroids


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, dots string")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=WIDTH).round(3).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # one very common vector
    rows += [(300, None), (301, []), (302, [1.0] * 7), (303, [1.0] * 9), (304, [1.0] * 7 + [None]), (305, [float("nan")] * 8), (306, [float("inf")] + [0.0] * 7)]
    rows += [(None, [0.5] * 8), (None, [-0.5] * 8), (7, [0.25] * 8), (400, [-0.0] * 8), (401, [-0.0001] * 8)]
    return rows


@pytest.mark.parametrize("clusters, rounds", [(5, 6), (1, 3), (8, 0), (400, 2)])
def test_equals_brute_force(spark, vectors, clusters, rounds):
    found, centroids = cluster(table(spark, vectors).repartition(5), clusters, rounds, WIDTH, 1024, 3)
    expected, expected_centroids = brute_force(vectors, clusters, rounds, 1024, 3)
    assert found.columns == ["vec_id", "cluster", "distance"]
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == expected
    assert [tuple(c) for c in centroids.tolist()] == expected_centroids


def test_described(spark, vectors):
    found, centroids = cluster(table(spark, vectors), 4, 5, WIDTH)
    rows = described(found, centroids).collect()
    assert len({r.inertia for r in rows}) == 1 and rows[0].inertia == sum(r.distance for r in rows)
    for c in {r.cluster for r in rows}:
        mine = [r for r in rows if r.cluster == c]
        assert {r.cluster_inertia for r in mine} == {sum(r.distance for r in mine)}
        assert {r.centroid_sha256 for r in mine} == {hashlib.sha256(",".join(str(x) for x in centroids[c]).encode()).hexdigest()}


def test_ties_go_to_the_smaller_number_and_unused_centroids_stay(spark):
    rows = [(i, [0.0] * WIDTH) for i in range(6)]
    found, centroids = cluster(table(spark, rows), 3, 4, WIDTH)
    assert {(r.cluster, r.distance) for r in found.collect()} == {(0, 0)} and not centroids.any()


def test_dot_products_are_kept_exactly(spark):
    rng = np.random.default_rng(2)
    x, one, two = (rng.integers(-500, 500, (n, WIDTH)) for n in (30, 3, 3))
    two[1] = one[1]  # a centroid that stays
    two[2, :5] = one[2, :5]  # and one that moves in some components
    state = spark.createDataFrame([(i, v, [0] * 3, -1) for i, v in enumerate(x.tolist())], "vec_id long, x array<int>, dots array<long>, cluster int")
    state = updated(updated(state, one, np.zeros_like(one)), two, one)
    for r in state.collect():
        assert r.dots == (two @ np.array(r.x)).tolist() and r.distance == ((two[r.cluster] - np.array(r.x)) ** 2).sum()


def test_large_components_saturate(spark):
    rows = [(1, [3e38] * WIDTH), (2, [-3e38] * WIDTH)]
    found, centroids = cluster(table(spark, rows), 2, 1, WIDTH)
    assert {abs(x) for x in centroids.reshape(-1).tolist()} == {LARGEST} and {r.distance for r in found.collect()} == {0}


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        found, centroids = cluster(table(spark, rows), width=WIDTH)
        assert len(centroids) == 0 and described(found, centroids).collect() == []


def test_products_and_means():
    rng = np.random.default_rng(0)
    small, large = rng.integers(-9, 9, (5, 3)), rng.integers(-LARGEST, LARGEST, (5, 3))
    for x in (small, large):
        assert (products(x, large[:2]) == np.array([[sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for v in large[:2]] for u in x])).all()
    assert floor_means(np.array([[-7, 7], [1, 1]]), np.array([2, 0]), np.array([[0, 0], [9, 9]])).tolist() == [[-4, 3], [9, 9]]
    assert centroid_digest(np.array([-1, 2])) == hashlib.sha256(b"-1,2").hexdigest()
