import math

import numpy as np
import pytest

from tagloom.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 9) for i, v in rows], SCHEMA).repartition(3)


def matrix(vectors, scale=256):
    size = max(map(len, vectors))
    return np.array([[math.floor(scale * float(np.float32(c))) for c in v] + [0] * (size - len(v)) for v in vectors], float)


def check(spark, rows, odd=(), count=4):
    found = sorted(whiten(frame(spark, [*rows, *odd]), count=count).collect(),
                   key=lambda r: (str(r.vec_id), r.deviation, r.component))
    x = matrix([v for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(count, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == k * len(rows)
    by_component = [[r for r in found if r.component == j + 1] for j in range(k)]
    by_row = np.array([[r.whitened for r in rs] for rs in by_component]).T
    order = sorted(range(len(rows)), key=lambda i: (str(rows[i][0]), sum(
        int(n * c - s) ** 2 for c, s in zip(x[i], sums))))
    z = ((x - sums / n) @ axes[:, :k] / np.sqrt(values[:k]))[order]
    distinct = [i for i in range(k) if np.sum(abs(values - values[i]) < 1e-9 * values[0]) == 1]
    signs = np.sign((z * by_row).sum(axis=0))
    assert np.abs((z * signs - by_row)[:, distinct]).max(initial=0) < 1e-8
    for r, i in zip(by_component[0], order):
        assert (r.n, int(r.deviation)) == (n, sum(int(n * c - s) ** 2 for c, s in zip(x[i], sums)))
    for j, rs in enumerate(by_component):
        assert all(r.explained == pytest.approx(values[j] / values.sum(), rel=1e-9) for r in rs)
    assert max(r.identity_error for r in found) < 1e-9
    return found


def test_against_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(90, 7)) @ rng.normal(size=(7, 7))
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [(None, rows[0][1]), rows[5], rows[5], (200, [0.0] * 7), (201, [-0.0] * 7), (7, [9.0] * 7)]
    odd = [(300, None), (301, [1.0, None]), (302, [math.nan] * 7), (303, [-math.inf])]
    check(spark, rows, odd)


def test_fewer_directions_than_components(spark):
    """Rank two in five dimensions, so that the iteration ends early and starts anew."""
    rng = np.random.default_rng(4)
    plane = rng.normal(size=(60, 2)) @ np.array([[1, 0, 1, 0, 0], [0, 2, 0, 0, 0]])
    assert {r.component for r in check(spark, list(enumerate((np.round(plane * 4) / 4).tolist())))} == {1, 2}


def test_equal_eigenvalues(spark):
    """The corners of a cross: every direction deviates alike, and a start reaches one of them only."""
    cross = [(4 * i + s, [float(v if j == i else 0) for j in range(6)]) for i in range(6)
             for s, v in enumerate((1, -1))]
    found = check(spark, [(i, v) for i, (_, v) in enumerate(cross)])
    assert {r.component for r in found} == {1, 2, 3, 4}
    z = np.array([r.whitened for r in found]).reshape(-1, 4)
    assert np.allclose(z.T @ z / len(cross), np.eye(4), atol=1e-9)


def test_an_axis_that_the_start_does_not_favour_is_found(spark):
    rows = [(i, [float(i % 2) * 8, float(i // 2 % 2) / 4, float(i // 4 % 2) / 4]) for i in range(8)]
    assert check(spark, rows)[0].explained > 0.99


def test_shorter_vectors_count_as_zero_where_they_end(spark):
    check(spark, [(1, [1.0, 2.0, 3.0]), (2, []), (3, [4.0]), (4, [0.5, 0.25]), (5, [1.0, 2.0, 3.5])])


def test_large_components_deviate_exactly(spark):
    check(spark, [(i, [float(i * 1000 + 7) * 2 ** 15, float(i ** 2)]) for i in range(12)], count=1)


def test_nothing_deviates(spark):
    one = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    for df in (one, one.where("false"), frame(spark, [(1, [])]), frame(spark, [(1, None)])):
        assert whiten(df).collect() == []
