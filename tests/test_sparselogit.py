"""Sparse logistic regression against Newton steps in numpy."""
from __future__ import annotations

import numpy as np
import pytest

from lumenframe.operators import sparselogit


def newton(x, y, c):
    """Weights and intercept at the optimum."""
    x, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    ridge = np.r_[np.ones(x.shape[1] - 1), 0.0]
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(c * (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), c * x.T @ (p - y) + ridge * w)
    return w


def tables(spark, x, y):
    entries = [(i, f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)]
    entries = [(int(i), t, v) for i, t, v in entries]
    return (spark.createDataFrame([*entries, (0, None, 1.0), (1, "t0", None), (9999, "lost", 3.0)], "key long, term string, value double").repartition(3),
            spark.createDataFrame([*((i, int(v)) for i, v in enumerate(y)), (7777, None)], "key long, label int"))


@pytest.mark.parametrize("c", [0.5, 10.0])
def test_weights_equal_newton(spark, c):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((90, 12)) * (rng.random((90, 12)) < 0.5)
    x[:4] = 0.0
    y = (rng.random(90) < 1 / (1 + np.exp(-x @ rng.standard_normal(12) - 0.4))).astype(float)
    entries, labels = tables(spark, x, y)
    model, want = sparselogit.sparse_logistic(entries, labels, c, tol=1e-6), newton(x, y, c)
    got = {r.term: r.weight for r in model.weights.collect()}
    assert sorted(got) == sorted(f"t{j}" for j in range(12))
    assert np.allclose([got[f"t{j}"] for j in range(12)], want[:-1], atol=2e-3) and abs(model.intercept - want[-1]) < 2e-3
    assert all(b < a for a, b in zip(model.losses, model.losses[1:], strict=False))
    scored = {r.key: r.probability for r in model.predict(entries, labels).collect()}
    assert len(scored) == 91 and abs(sum(scored[i] for i in range(90)) - y.sum()) < 0.01
    assert np.allclose([scored[i] for i in range(90)], 1 / (1 + np.exp(-np.c_[x, np.ones(90)] @ want)), atol=1e-3)


def test_one_label_is_an_error(spark):
    entries, labels = tables(spark, np.ones((3, 2)), np.ones(3))
    with pytest.raises(ValueError):
        sparselogit.sparse_logistic(entries, labels)


def test_history_gives_the_textbook_direction():
    rng = np.random.default_rng(0)
    s, y, g = rng.standard_normal((3, 6)), rng.standard_normal((3, 6)), rng.standard_normal(6)
    y = np.where((s * y).sum(axis=1, keepdims=True) > 0, y, -y)
    h = (s[-1] @ y[-1]) / (y[-1] @ y[-1]) * np.eye(6)
    for a, b in zip(s, y, strict=True):
        r = 1 / (a @ b)
        h = (np.eye(6) - r * np.outer(a, b)) @ h @ (np.eye(6) - r * np.outer(b, a)) + r * np.outer(a, a)
    whole = np.vstack([s, y, g])
    assert np.allclose(sparselogit._direction(whole @ whole.T, 3) @ whole, -h @ g)
