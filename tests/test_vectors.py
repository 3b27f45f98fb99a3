import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lumenframe.operators import aggregate, linear, models, neighbours


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 6)) + np.repeat(rng.normal(size=(6, 6)) * 4, 40, axis=0)
    x[100:140] = x[100]      # many copies of one row
    rows = [(i, [float(v) for v in r], i // 40) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, v array<double>, y int").cache()


def brute(x, k):
    d = np.round(np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, :k]
    return {(i, int(j)): r + 1 for i in range(len(x)) for r, j in enumerate(order[i])}


@pytest.mark.parametrize("pivots,block", [(1, 4096), (8, 30)])
def test_nearest_equals_brute_force(cloud, pivots, block):
    x, df = cloud
    got = neighbours.nearest(df, df, "id", "v", 4, exclude_self=True, pivots=pivots, block=block)
    assert {(r["id"], r["other"]): r["rank"] for r in got.collect()} == brute(x, 4)


def test_similar_pairs_equal_brute_force(cloud):
    x, df = cloud
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if (u @ u.T)[i, j] > 0.8}
    got = neighbours.similar_pairs(df, "id", "v", 0.8, pivots=7, block=50).collect()
    assert len(got) == len(want) and {(r["src"], r["dst"]) for r in got} == want


def test_knn_ties_take_smallest_label(spark):
    train = spark.createDataFrame([(1, [0.0], 5), (2, [2.0], 3)], "id long, v array<double>, y int")
    test = spark.createDataFrame([(9, [1.0])], "id long, v array<double>")
    assert neighbours.knn_classify(train, test, "id", "v", "y", 2).first()["predicted"] == 3


def test_distance_and_angle(spark):
    r = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>").select(
        neighbours.vector_distance(F.col("a"), F.col("b")).alias("d"), neighbours.vector_angle(F.col("a"), F.col("b")).alias("g")).first()
    assert abs(r["d"] - math.sqrt(2)) < 1e-12 and abs(math.degrees(r["g"]) - 90) < 1e-9


def test_lsh_finds_only_close_rows(cloud):
    _, df = cloud
    got = neighbours.nearest_lsh(df, df, "id", "v", 1.0, 4.0)
    assert got.where("distance > 1.0").isEmpty() and got.where("id = other").count() == 240


def test_projections(spark):
    p = linear.projection_matrix([1, 2, 2])
    assert np.allclose(p * 9, [[1, 2, 2], [2, 4, 4], [2, 4, 4]]) and np.allclose(p, p @ p) and np.allclose(p, p.T)
    basis = [[1, 0], [1, 1], [1, 2]]
    assert np.allclose(linear.projection_matrix(basis) * 6, [[5, 2, -1], [2, 2, 2], [-1, 2, 5]])
    df = spark.createDataFrame([([6.0, 0.0, 0.0],)], "v array<double>")
    assert np.allclose(linear.project(df, "v", basis).first()["projected"], [5, 2, -1])
    one = spark.createDataFrame([([1.0, 1.0, 1.0],)], "v array<double>")
    assert np.allclose(np.array(linear.project(one, "v", [1, 2, 2]).first()["projected"]) * 9, [5, 10, 10])


def test_pca_against_numpy(cloud):
    x, df = cloud
    want = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    model = linear.pca(df, "v", 3)
    assert np.allclose(model.variances, want[:3]) and abs(model.total - want.sum()) < 1e-9
    back = model.reconstruct(model.scores(df, "v"), "scores").orderBy("id").collect()
    gap = ((np.array([r["rebuilt"] for r in back]) - x) ** 2).sum(1).mean()
    curve, under = linear.pca_error_curve(df, "v", [1, 2, 3, 6], limit=1.0)
    errors = {r["k"]: r["error"] for r in curve.collect()}
    assert abs(errors[3] - gap) < 1e-8 and errors[1] > errors[2] > errors[3] and abs(errors[6]) < 1e-8
    assert under == min(k for k, e in errors.items() if e < 1.0)


def test_wide_pca_equals_pca(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(8, 30))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    a, b = linear.pca(df, "v", 3), linear.pca_wide(df, "id", "v", 3)
    rows = b.loadings.orderBy("dim").collect()
    loadings = np.array([r["loadings"] for r in rows]).T
    assert np.allclose(a.variances, b.variances) and np.allclose(a.components, loadings) and abs(a.total - b.total) < 1e-9
    scores = {r["id"]: r["scores"] for r in b.scores(df, "id", "v").collect()}
    assert np.allclose([scores[i] for i in range(8)], (x - x.mean(axis=0)) @ a.components.T)


def test_affine_moments_match_moved_rows(spark, cloud):
    _, df = cloud
    a = spark.createDataFrame([(i, j, float(i + 1) if i == j else 0.5 * (j - i)) for i in range(3) for j in range(6)], "i int, j int, a double")
    b = spark.createDataFrame([(0, 1.0), (1, -2.0)], "i int, b double")
    mean, cov = aggregate.affine_moments(aggregate.mean_vector(df, "v").withColumnRenamed("dim", "i"), linear.vector_covariance(df, "v"), a, b)
    moved = aggregate.affine_map(df, "id", "v", a, b).groupBy("id").pivot("i", [0, 1, 2]).agg(F.first("y")).toDF("id", "y0", "y1", "y2")
    want = moved.agg(F.avg("y1").alias("m"), F.covar_pop("y0", "y2").alias("c")).first()
    assert abs(mean.where("i = 1").first()["mean"] - want["m"]) < 1e-9
    assert abs(cov.where("row = 0 and col = 2").first()["covariance"] - want["c"]) < 1e-9


def test_standardize_fits_on_train_and_keeps_constant_columns(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 7.0)], "a double, b double")
    r = linear.standardize(test, ["a", "b"], fit_on=train).first()
    assert (r["a_std"], r["b_std"]) == (3.0, 2.0)


def test_svd_matches_numpy(cloud):
    x, df = cloud
    values, v = linear.truncated_svd(models.point_vectors(df, "v"), "features", 2)
    assert np.allclose(values, np.linalg.svd(x, compute_uv=False)[:2]) and v.shape == (2, 6)


def test_reduced_rows_of_dense_and_sparse_vectors(spark):
    vectors = [Vectors.dense([1.0, 2.0, 3.0]), Vectors.sparse(3, [0, 2], [4.0, 5.0]), Vectors.sparse(3, [], [])]
    df = spark.createDataFrame(list(enumerate(vectors)), ["id", "v"])
    components = np.array([[1.0, 0.0, 2.0], [0.0, 1.0, -1.0]])
    got = [r["reduced"] for r in linear.reduced_rows(df, "v", components).orderBy("id").collect()]
    assert got == [[7.0, -1.0], [14.0, -5.0], [0.0, 0.0]]


def test_soft_kmeans_and_elbow(cloud):
    x, df = cloud
    centres, costs = models.soft_kmeans(df, "v", x[[0, 60, 200]].tolist(), beta=1.0, max_iter=6)
    m = x[[0, 60, 200]].copy()
    for _ in range(len(costs)):
        d = ((x[:, None, :] - m[None]) ** 2).sum(2)
        r = np.exp(-(d - d.min(1, keepdims=True)))
        r /= r.sum(1, keepdims=True)
        m = (r.T @ x) / r.sum(0)[:, None]
        cost = (r * ((x[:, None, :] - m[None]) ** 2).sum(2)).sum()
    assert np.allclose(centres, m) and abs(cost - costs[-1]) < 1e-6
    elbow = {r["k"]: r["inertia"] for r in models.kmeans_elbow(models.point_vectors(df, "v"), [1, 6]).collect()}
    assert abs(elbow[1] - ((x - x.mean(0)) ** 2).sum()) < 1e-6 and elbow[6] < elbow[1]


def test_models_on_easy_data(spark):
    df = spark.range(200).select("id", (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")).withColumn(
        "class", F.when(F.col("a") > 9, "present").otherwise("absent"))
    feats = ["a", "b"]
    for model, rows in (models.decision_tree(df, feats, "class"), models.boosted_trees(df, feats, "class", n=3), models.random_forest(df, feats, "class", trees=5),
                        models.decision_tree(df, feats, "class", depth=2, folds=3, key="id")):
        assert model.transform(rows).where("prediction <> label").count() == 0
    top = models.importance_by_target(df, feats, ["class"], trees=5).where("rank = 1").first()
    assert top["feature"] == "a"
    lin, out = models.linear_regression(df.withColumn("y", 3 * F.col("a") - F.col("b") + 2), feats, "y")
    assert np.allclose(lin.coefficients, [3, -1]) and abs(lin.intercept - 2) < 1e-6
    # normal equations: residuals are orthogonal to every feature
    r = out.agg(F.sum((F.col("y") - F.col("prediction")) * F.col("a")).alias("g")).first()["g"]
    assert abs(r) < 1e-6
    noisy = df.withColumn("q", ((F.col("id") % 3 == 0) | (F.col("a") > 15)).cast("double"))
    ratio = {r["term"]: r["odds_ratio"] for r in models.odds_ratios(noisy, ["a"], "q").collect()}
    assert ratio["a"] > 1


def test_block_search_equals_brute_force_and_measures_few_pairs_twice(monkeypatch):
    rng = np.random.default_rng(3)
    measured = []
    exact = neighbours._exact
    monkeypatch.setattr(neighbours, "_exact", lambda a, b, i, j: measured.append(len(i)) or exact(a, b, i, j))
    for odd in ("plain", "copies", "ties", "not finite", "tiny", "huge", "few"):
        a, b = rng.normal(size=(600, 8)), rng.normal(size=(5_000, 8))
        if odd == "copies":
            b[1_000:] = a[0]
        elif odd == "ties":
            a, b = np.round(a), np.round(b)
        elif odd == "not finite":
            a[::5, 0], b[::7, 1], b[2, 0] = np.nan, np.nan, np.inf
        elif odd in ("tiny", "huge"):
            a, b = (x * (1e-14 if odd == "tiny" else 1e20) for x in (a, b))
        elif odd == "few":
            b = b[:3]
        same = np.arange(600)[:, None] == np.arange(len(b))[None, :]
        measured.clear()
        got = [row for lot in neighbours._best(a, b, 5, lambda own: np.nonzero(same[own])) for row in zip(*lot)]
        gaps = np.round(np.sqrt(((a[:, None] - b[None]) ** 2).sum(2)), 9)
        gaps[same] = np.inf
        order = np.argsort(gaps, axis=1, kind="stable")[:, :5]
        taken = np.take_along_axis(gaps, order, 1)
        i, j = np.nonzero(np.isfinite(taken))
        assert got == list(zip(i, order[i, j], taken[i, j])), odd
        if odd == "plain":
            assert sum(measured) < 0.1 * gaps.size


def test_pairs_of_many_copies_come_in_bounded_lots(spark):
    """A block of copies against itself has a pair for every two rows; they leave the task bit by bit."""
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(1_500)], "id long, v array<double>")
    got = neighbours.similar_pairs(df, "id", "v", 0.9)
    assert got.count() == 1_500 * 1_499 // 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "FlatMapCoGroupsInPandas" not in plan


def test_grid_search_deals_the_folds_once(spark, monkeypatch):
    """Every fold reads rows that were written with their fold, and does not rank them again."""
    from pyspark.ml.tuning import CrossValidator

    from lumenframe.operators import models
    seen = []
    monkeypatch.setattr(CrossValidator, "fit", lambda self, df: seen.append(df))
    models.grid_search(spark.range(40).selectExpr("id", "cast(id % 2 as double) as y"), "id", "y", None, [], folds=4)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert sorted(r["count"] for r in seen[0].groupBy("fold").count().collect()) == [10, 10, 10, 10]
