"""Whitening against numpy's own eigenvectors and plain whole-number arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string"


def brute(vectors):
    """Per vector: deviation and whitened components, by plain arithmetic and a library's eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(v[k] for v in x) for k in range(d)]
    deviations = [sum((n * v[k] - sums[k]) ** 2 for k in range(d)) for v in x]
    z = np.array([[(n * v[k] - sums[k]) / n for k in range(d)] for v in x])
    values, axes = np.linalg.eigh(z.T @ z / n)
    return deviations, values[::-1], axes[:, ::-1], z


@pytest.mark.parametrize("d", [12, 3])
def test_whitening(spark, d):
    rng = random.Random(d)
    rows = [(k, [rng.gauss(0, 1 + j) for j in range(d)], "x") for k in range(300)]
    rows += [(400, rows[0][1], None), (None, rows[1][1], "x")]
    broken = [(500, None, "x"), (501, [], "x"), (502, [1.0] * (d - 1) + [None], "x"), (503, [float("nan")] * d, "x"), (504, [float("inf")] * d, "x"), (505, [1.0] * (d + 1), "x")]
    found = whitening.whiten(spark.createDataFrame(rows + broken, SCHEMA).repartition(5), F.col("embedding"), keep=["vec_id", "component"]).collect()
    m = min(8, d)
    assert len(found) == m * len(rows)
    deviations, values, axes, z = brute([r[1] for r in rows])
    want = {k: (dev, zz) for (k, *_), dev, zz in zip(rows, deviations, z)}
    signs = {}
    for r in found:
        assert r.n == len(rows) and r.deviation == want[r.vec_id][0] and r.identity_error < 1e-10
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-10
        w = want[r.vec_id][1] @ axes[:, r.component - 1] / values[r.component - 1] ** 0.5
        sign = signs.setdefault(r.component, 1 if r.whitened * w > 0 else -1)
        assert abs(r.whitened - sign * w) < 1e-9 * max(1, abs(w))


def test_no_spread(spark):
    found = whitening.whiten(spark.createDataFrame([(k, [1.0, 2.0], "x") for k in range(3)], SCHEMA), F.col("embedding")).collect()
    assert len(found) == 6 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(0, None, None, None)}
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0], "x") for k in range(3)], SCHEMA), F.col("embedding")).collect()
    assert {r.whitened for r in flat if r.component == 2} == {None} and all(r.identity_error < 1e-12 for r in flat)
    for none in ([], [(1, None, "x")]):
        out = whitening.whiten(spark.createDataFrame(none, SCHEMA), F.col("embedding"))
        assert out.count() == 0 and out.columns == ["vec_id", "embedding", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries(spark):
    """Exact sums beyond a long; entries far beyond any whole number of a double are held."""
    rows = [(1, [3e9, 0.0], "x"), (2, [-3e9, 1.0], "x"), (3, [1e38, 0.0], "x")]
    found = whitening.whiten(spark.createDataFrame(rows[:2], SCHEMA), F.col("embedding")).collect()
    assert {r.deviation for r in found} == {None}
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA), F.col("embedding")).count() == 6


@pytest.mark.parametrize("values", [[5.0] * 20, [900.0] * 4 + [1.0] * 16, [7, 7, 3, 3 + 1e-9, 0, 0], [0.0, 0.0], [4.0, -2.0, -3.0], list(range(40))])
def test_leading(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = (q * np.array(values, dtype=float)) @ q.T
    a = (a + a.T) / 2
    m = min(8, len(values))
    found, vectors = whitening.leading(a, m)
    assert np.allclose(found, sorted(values)[::-1][:m], atol=1e-11 * max(1, max(values)))
    assert np.allclose(vectors @ vectors.T, np.eye(m), atol=1e-13) and np.allclose(a @ vectors.T, vectors.T * found, atol=1e-10 * max(1, max(values)))
    for shift in (-2.5, -0.5, 0.5, 4.5, 899.0):
        assert whitening.pivots(a, shift) == sum(v > shift for v in values)
