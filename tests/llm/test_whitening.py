"""Whitening against an eigendecomposition of the covariance in one place."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from admosaic.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id string, vector string, n long, component string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "i", "v", 5, "c") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    variances, axes = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, variances[::-1], axes[:, ::-1].T


def held_against_brute(found, vectors, ids, width, used):
    deviation, centred, variances, axes = brute(vectors)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(rows) == sorted(ids)
    for place, i in enumerate(ids):
        assert sorted(rows[i]) == list(range(1, width + 1))
        assert {int(r["deviation"]) for r in rows[i].values()} == {deviation[place]}
        assert {r["n"] for r in rows[i].values()} == {len(vectors)}
    for k in range(width):
        column = [rows[i][k + 1] for i in ids]
        assert np.allclose([r["explained"] for r in column], variances[k] / variances.sum(), rtol=1e-9, atol=1e-13)
        if k >= used:
            assert all(r["whitened"] is None for r in column)
            continue
        assert column[0]["identity_error"] < 1e-9
        values = np.array([r["whitened"] for r in column])
        expected = centred @ axes[k] / np.sqrt(variances[k])
        assert min(np.abs(values - expected).max(), np.abs(values + expected).max()) < 1e-6


@pytest.mark.parametrize(("n", "size"), [(300, 8), (500, 40)])
def test_whitening_equals_eigenvectors(spark, n, size):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(n, size)) * np.linspace(3, 0.2, size) + rng.normal(size=size)).tolist()
    vectors += [vectors[0]] * 100
    odd = [None, [], [None] * size, [math.nan] + [0.0] * (size - 1), [math.inf] * size, [1e30] * size, [1.0] * (size + 1)]
    ids = list(range(len(vectors) + len(odd)))
    found = whitening.whitened(table(spark, odd + vectors, ids).repartition(5))
    held_against_brute(found, vectors, ids[len(odd) :], min(32, size), min(32, size))


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-400, 400, size=(200, 5)) / 64
    vectors = np.column_stack([base, base[:, 0] + base[:, 1], np.ones(200), 2 * base[:, 2]]).tolist()
    held_against_brute(whitening.whitened(table(spark, vectors)), vectors, list(range(200)), 8, 5)


def test_scales_far_apart(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.integers(-500, 500, size=(400, 4)) / 64 * np.array([4096.0, 64.0, 1.0, 1.0])).tolist()
    held_against_brute(whitening.whitened(table(spark, vectors), most=3), vectors, list(range(400)), 3, 3)


def test_one_vector_and_none(spark):
    found = whitening.whitened(table(spark, [[1.5, 2.5]] * 3, [1, 1, None])).collect()
    assert len(found) == 6 and {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in found} == {(None, 0.0, 0.0, 0)}
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [None, [], [math.nan]])).collect() == []


def test_sums_beyond_a_long_are_exact(spark):
    vectors = [[2.0**52, 1.0], [-(2.0**52), 2.0], [2.0**51, 3.0]]
    deviation = brute(vectors)[0]
    found = {r["vec_id"]: int(r["deviation"]) for r in whitening.whitened(table(spark, vectors)).collect()}
    assert found == dict(enumerate(deviation))
