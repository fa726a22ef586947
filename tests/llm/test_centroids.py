import hashlib
import math
import random

import numpy as np
import pytest

from tagloom.llm.centroids import Tournament, cluster, clusters

SCHEMA = "vec_id long, embedding array<float>, label int, x long, cluster string, distance double"


def vectors(n=120, size=3, seed=5):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.25, 1.0, 3.0]) for _ in range(size)]) for i in range(n)]
    rows += [(None, [0.5] * size), (3, [0.25] * size), rows[7], rows[7]]
    odd = [(900, None), (901, []), (902, [1.0] * (size + 1)), (903, [1.0, None, 2.0]),
           (904, [math.nan] * size), (905, [math.inf] + [0.0] * (size - 1))]
    return rows, odd


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c", 0.5) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, scale=64):
    points = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    first = sorted(points, key=lambda p: (hashlib.sha256(f"1:{'' if p[0] is None else p[0]}".encode())
                                          .hexdigest(), p[1]))
    centroids = [p[1] for p in first[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[x for _, x in points if nearest(x)[1] == j] for j in range(len(centroids))]
        centroids = [[sum(col) // len(g) for col in zip(*g)] if g else c
                     for g, c in zip(groups, centroids)]
    return sorted(((i, *reversed(nearest(x))) for i, x in points), key=str), centroids


@pytest.mark.parametrize("k, rounds", [(1, 2), (5, 0), (7, 3), (500, 1)])
def test_against_brute_force(spark, k, rounds):
    """Values are few, so that there are many ties, equal centroids and empty clusters."""
    rows, odd = vectors()
    expected, centroids = brute(rows, k, rounds)
    found, moved = cluster(frame(spark, rows + odd).repartition(5), k=k, rounds=rounds, size=3)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert moved.tolist() == centroids


def test_sums_and_names(spark):
    rows, odd = vectors()
    expected, centroids = brute(rows, 4, 3)
    for row in clusters(frame(spark, rows + odd), k=4, size=3).collect():
        assert row.inertia == sum(e[2] for e in expected)
        assert row.cluster_inertia == sum(e[2] for e in expected if e[1] == row.cluster)
        text = ",".join(map(str, centroids[row.cluster]))
        assert row.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_large_components_stay_exact():
    """The same winners whether products are taken in doubles or in longs."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-(1 << 27), 1 << 27, (6, 64))
    points = np.concatenate([rng.integers(-(1 << 27), 1 << 27, (50, 64)), centroids,
                             np.repeat(centroids[2:3], 3, 0) + 1])
    rules = Tournament(centroids)
    apart = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in centroids] for p in points]
    winner = rules.nearest(points)
    assert winner.tolist() == [d.index(min(d)) for d in apart]
    assert rules.distances(points, winner).tolist() == [min(d) for d in apart]


def test_components_beyond_the_bound_are_refused(spark):
    with pytest.raises(Exception, match="is beyond"):
        cluster(frame(spark, [(1, [1e9, 0.0, 0.0])]), size=3)


def test_no_vectors(spark):
    rows, odd = vectors()
    for df in (frame(spark, odd), frame(spark, rows).where("false")):
        assert clusters(df, size=3).collect() == []
