"""Truncated SVD of sparse and dense rows against numpy."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lumenframe.operators import svd


def matrix(n=150, width=400, rank=60, seed=0):
    """Sparse rows with falling singular values and empty rows."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, rank)) @ (rng.standard_normal((rank, width)) * (0.93 ** np.arange(rank))[:, None])
    x[rng.random((n, width)) < 0.7] = 0.0
    x[::17] = 0.0
    return x


def rows_of(spark, x, parts=5):
    sparse = [(i, f"r{i}", Vectors.sparse(len(r), [(int(j), float(r[j])) for j in np.flatnonzero(r)]) if i % 3 else Vectors.dense(r.tolist())) for i, r in enumerate(x)]
    return spark.createDataFrame(sparse, ["id", "block", "features"]).repartition(parts)


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(svd, "ENTRIES", 700)


def test_values_and_vectors_equal_numpy(spark, small_blocks):
    x = matrix()
    _, values, right = np.linalg.svd(x, full_matrices=False)
    model = svd.svd_model(rows_of(spark, x), "features", 12, tol=1e-6)
    assert np.allclose(model.values, values[:12], rtol=1e-4)
    found = model.components(x.shape[1])
    assert np.allclose(found @ found.T, np.eye(12), atol=1e-3)
    assert np.allclose(np.abs((found * right[:12]).sum(axis=1)), 1.0, atol=1e-2)
    assert (found[np.arange(12), np.abs(found).argmax(axis=1)] > 0).all()


def test_transform_of_new_rows_and_unknown_columns(spark, small_blocks):
    x = matrix()
    x[:100, 390:] = 0.0                                                   # columns that the fit does not know
    table = rows_of(spark, x)
    model = svd.svd_model(table.where("id < 100"), "features", 5)
    right = model.components(x.shape[1])
    got = {r.id: (r.block, r.reduced) for r in model.transform(table.where("id >= 90"), "features", ["id", "block"]).collect()}
    assert sorted(got) == list(range(90, 150)) and all(b == f"r{i}" for i, (b, _) in got.items())
    assert np.allclose([got[i][1] for i in sorted(got)], x[90:] @ right.T, atol=1e-5)


def test_rank_below_k_null_and_zero_rows(spark):
    x = np.outer(np.arange(6.0), np.ones(4)) + np.outer(np.ones(6), [0, 0, 0, 5.0])
    table = rows_of(spark, x)
    table = table.unionByName(table.limit(1).withColumns({"id": F.lit(9).cast("long"), "features": F.when(F.lit(False), F.col("features"))}))
    model = svd.svd_model(table, "features", 5)
    assert np.allclose(model.values, np.linalg.svd(x, compute_uv=False)[:2])
    assert model.transform(table, "features", ["id"]).count() == 6
    with pytest.raises(ValueError):
        svd.svd_model(table.limit(0), "features", 2)
    with pytest.raises(ValueError):
        svd.svd_model(rows_of(spark, np.zeros((3, 4))), "features", 2)


def test_flat_spectrum_is_left_only_when_settled(spark, small_blocks):
    rng = np.random.default_rng(3)
    x = np.linalg.qr(rng.standard_normal((300, 300)))[0] * np.linspace(2.0, 1.0, 300)
    table = rows_of(spark, x, 3)
    model = svd.svd_model(table, "features", 20)
    assert np.allclose(model.values, np.linspace(2.0, 1.0, 300)[:20], rtol=2e-3)
    length = model.transform(table, "features", []).select(F.posexplode("reduced").alias("c", "v")).groupBy("c").agg(F.sum(F.col("v") ** 2).alias("s")).orderBy("c")
    assert np.allclose([r.s ** 0.5 for r in length.collect()], model.values, rtol=1e-3)
