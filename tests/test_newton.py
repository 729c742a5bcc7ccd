"""The shared solver against a plain minimiser of the same objective."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from modspark.operators import newton
from modspark.operators.newton import Column

SCHEMA = T.StructType([T.StructField("v", VectorUDT()), T.StructField("labels", T.ArrayType(T.DoubleType()))])


def made(n=300, size=40, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, size)) * (rng.random((n, size)) < 0.2)
    y = (x @ rng.normal(size=(size, 3)) + rng.normal(size=(n, 3)) > 0.4).astype(float)
    return x, y


def frame(spark, x, y):
    rows = []
    for i, (a, b) in enumerate(zip(x, y, strict=True)):
        sparse = Vectors.sparse(len(a), {int(k): float(a[k]) for k in np.flatnonzero(a)})
        rows.append((Vectors.dense(a) if i % 10 == 0 else sparse, [float(v) for v in b]))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(x, y, c, positive):
    """Newton's method with the whole second derivative."""
    z = np.hstack((x, np.ones((len(x), 1))))
    weight, w = np.where(y > 0, positive, 1.0), np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ w))
        slope = c * z.T @ (weight * (p - y)) + w
        w -= np.linalg.solve(c * z.T @ (z * (weight * p * (1 - p))[:, None]) + np.eye(len(w)), slope)
    return w


@pytest.fixture(scope="module")
def data(spark):
    x, y = made()
    return x, y, newton.Data.of(newton.blocks(frame(spark, x, y), "v", "labels", 3))


def test_weights_are_those_of_a_plain_minimiser(data):
    x, y, blocks = data
    columns = [Column(0, 4.0), Column(1, 0.1), Column(2, 16.0, 3.0), Column(0, 4.0, 0.5)]
    found = newton.minimised(blocks, x.shape[1], columns, tolerance=1e-10)
    for column, w in zip(columns, found, strict=True):
        np.testing.assert_allclose(w, plain(x, y[:, column.label], column.c, column.positive), atol=1e-6)


def test_columns_do_not_depend_on_each_other(data):
    x, _, blocks = data
    columns = [Column(0, 4.0), Column(1, 64.0)]
    together = newton.minimised(blocks, x.shape[1], columns, tolerance=1e-8)
    for column, w in zip(columns, together, strict=True):
        np.testing.assert_allclose(newton.minimised(blocks, x.shape[1], [column], tolerance=1e-8)[0], w, atol=1e-5)


def test_slopes_and_curvatures_are_differences(data):
    x, _, blocks = data
    rng = np.random.default_rng(1)
    columns = [Column(0, 2.0), Column(2, 0.5, 4.0)]
    w, v = rng.normal(size=(2, 2, x.shape[1] + 1))
    step = 1e-5
    up, down = (newton.losses_and_slopes(blocks, columns, w + s * step * v) for s in (1, -1))
    _, slope, own = newton.losses_and_slopes(blocks, columns, w)
    np.testing.assert_allclose((up[0] - down[0]) / (2 * step), (slope * v).sum(axis=1), rtol=1e-5)
    for k in (0, x.shape[1]):
        unit = np.zeros_like(w)
        unit[:, k] = 1.0
        np.testing.assert_allclose(newton.curvatures(blocks, columns, w, unit)[:, k], own[:, k], rtol=1e-9)
    np.testing.assert_allclose((up[1] - down[1]) / (2 * step), newton.curvatures(blocks, columns, w, v), rtol=1e-4, atol=1e-5)


def test_missing_labels_and_no_rows(spark):
    rows = [(Vectors.sparse(3, {0: 1.0}), [1.0, None]), (Vectors.sparse(3, {}), None), (Vectors.dense([0.0, 2.0, 0.0]), [0.0])]
    blocks = newton.blocks(spark.createDataFrame(rows, SCHEMA), "v", "labels", 2)
    seen = newton.probabilities(blocks, np.zeros((4, 4)), 2).collect()
    assert len(seen) == 6 and sorted(r["labels"] for r in seen) == [[0.0, 0.0]] * 4 + [[1.0, 0.0]] * 2
    assert {r["trial"] for r in seen} == {0, 1} and all(r["probs"] == [0.5, 0.5] for r in seen)
    nothing = newton.Data.of(newton.blocks(spark.createDataFrame([], SCHEMA), "v", "labels", 2))
    assert (newton.minimised(nothing, 3, [Column(0)]) == 0).all()


def test_columns_go_at_their_own_pace(data, monkeypatch):
    """All columns together take no more passes than the slowest of them takes alone."""
    x, _, blocks = data
    columns = [Column(0, 0.1), Column(1, 64.0), Column(2, 4.0, 3.0), Column(0, 1000.0)]
    passes, summed = [], newton.Data.summed
    monkeypatch.setattr(newton.Data, "summed", lambda *args: passes.append(1) or summed(*args))

    def needed(some):
        passes.clear()
        newton.minimised(blocks, x.shape[1], some, tolerance=1e-7)
        return len(passes)

    assert needed(columns) <= max(needed([c]) for c in columns)
