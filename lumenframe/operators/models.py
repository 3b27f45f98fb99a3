"""Regression, classification, clustering and search on Spark ML, with the scaling and penalty rules made explicit."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import cut
from lumenframe.operators.linear import literal_matrix, standardize, vector_entries
from lumenframe.operators.sparselogit import RowFit, fit_rows, marks_of, scored
from lumenframe.operators.split import assign_folds
from lumenframe.operators.svd import _tree
from lumenframe.operators.termmeans import TermMeans, term_kmeans
from lumenframe.operators.terms import TermRows, fold_scales, term_rows, top_words

def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out).transform(df)


def tfidf_vectors(df: DataFrame, tokens: Column, min_df: int = 1, keep: list[str] | None = None) -> TermRows:
    """Smooth tf-idf as packed unit rows with their vocabulary table: tf * (ln((1 + n) / (1 + df)) + 1).

    Texts are tokenized once, and neither the vocabulary nor anything as wide as it is on the driver (operators.terms).
    """
    return term_rows(df, tokens, keep or df.columns, tfidf=True, min_df=min_df)


def linear_regression(df: DataFrame, features: list[str], target: str):
    """Least squares without penalty. Returns (model, predictions)."""
    rows = assemble(df, features)
    model = LinearRegression(featuresCol="features", labelCol=target, solver="normal").fit(rows)
    return model, model.transform(rows)


def least_squares_origin(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope of the line through the origin."""
    return df.agg((F.sum(F.col(x) * F.col(y)) / F.sum(F.col(x) * F.col(x))).alias("theta"))


def estimate_error_curve(df: DataFrame, order: str, x: str, y: str, truth: float, sizes: list[int]) -> DataFrame:
    """|theta - truth| when only the rows with order <= size are used; one pass for all sizes."""
    part = lambda e, n: F.sum(F.when(F.col(order) <= n, e))
    one = df.agg(*[(part(F.col(x) * F.col(y), n) / part(F.col(x) * F.col(x), n)).alias(f"s{n}") for n in sizes])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("size"), F.abs(F.col(f"s{n}") - truth).alias("error"))
                                         for n in sizes])))


def regression_standardized(train: DataFrame, test: DataFrame, features: list[str], target: str):
    """Least squares on standardised features; the scaling is fitted on the training rows only."""
    names = [f"{c}_std" for c in features]
    model, _ = linear_regression(standardize(train, features), names, target)
    return model, model.transform(assemble(standardize(test, features, fit_on=train), names))


class TextLogit:
    """Logistic regression on packed rows of terms: loss per round, scores of the fitted rows, weights per term."""

    def __init__(self, rows: TermRows, fit: RowFit) -> None:
        self.rows, self.fit, self.losses = rows, fit, [float(x[0]) for x in fit.losses]

    def scores(self) -> DataFrame:
        """The kept columns of all rows, those without a label too, with the probability of label 1."""
        z = F.get("scores", F.lit(0))
        return scored(self.rows, self.fit.margins(), 1).select(*self.rows.keep, (1 / (1 + F.exp(-z))).alias("probability"))

    def weights(self) -> DataFrame:
        """(term, weight)."""
        return self.fit.weights(self.rows).join(self.rows.vocabulary, "id").select(F.col("word").alias("term"), "weight")


def logistic_regression(rows: DataFrame | TermRows, label: str, penalty: str = "l2", c: float = 1.0, max_iter: int = 100, tol: float = 1e-6):
    """Binary classifier; c is the inverse penalty weight over the sum of losses.

    Packed rows of terms have any number of terms and the l2 penalty; a table with a vector column 'features' goes to Spark
    ML, whose weights live on the driver.
    """
    if isinstance(rows, TermRows):
        if penalty != "l2":
            raise ValueError("rows of terms take the l2 penalty")
        marks = marks_of(rows, label, lambda kept, y: np.full((len(y), 1), float(c)))
        return TextLogit(rows, fit_rows(rows.blocks, marks, np.ones(1), tol, max_iter))
    n = rows.count()
    return LogisticRegression(labelCol=label, regParam=1.0 / (c * n), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, maxIter=max_iter, tol=tol).fit(rows)


def odds_ratios(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """exp(coefficient) of a binomial model."""
    model = GeneralizedLinearRegression(family="binomial", labelCol=target).fit(assemble(df, features))
    values = [("(Intercept)", model.intercept), *zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame([(n, float(np.exp(v))) for n, v in values], "term string, odds_ratio double")


def _classifier_rows(df: DataFrame, features: list[str], target: str) -> DataFrame:
    rows = assemble(df, features)
    return StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(rows).transform(rows)


def decision_tree(df: DataFrame, features: list[str], target: str, depth: int = 5, folds: int | None = None,
                  key: str | None = None, seed: int = 1):
    """(model, rows); with folds the depth is chosen among 1..depth by k-fold accuracy."""
    rows = _classifier_rows(df, features, target)
    tree = DecisionTreeClassifier(labelCol="label", maxDepth=depth, seed=seed)
    if folds is None:
        return tree.fit(rows), rows
    grid = ParamGridBuilder().addGrid(tree.maxDepth, sorted({1, max(1, depth // 2), depth})).build()
    return grid_search(rows, key, "label", tree, grid, folds).bestModel, rows


def boosted_trees(df: DataFrame, features: list[str], target: str, n: int = 100, rate: float = 1.0, depth: int = 1, seed: int = 1):
    rows = _classifier_rows(df, features, target)
    return GBTClassifier(labelCol="label", maxIter=n, stepSize=rate, maxDepth=depth, seed=seed).fit(rows), rows


def random_forest(df: DataFrame, features: list[str], target: str, trees: int = 100, depth: int = 5, seed: int = 1):
    rows = _classifier_rows(df, features, target)
    return RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed).fit(rows), rows


def importance_by_target(df: DataFrame, features: list[str], targets: list[str], trees: int = 20) -> DataFrame:
    """One forest per categorical target; features by falling importance."""
    out = []
    for target in targets:
        model, _ = random_forest(df, features, target, trees)
        ranked = sorted(zip(features, model.featureImportances.toArray()), key=lambda p: (-p[1], p[0]))
        out += [(target, i + 1, f, float(v)) for i, (f, v) in enumerate(ranked)]
    return df.sparkSession.createDataFrame(out, "target string, rank int, feature string, importance double")


def grid_search(rows: DataFrame, key: str, label: str, estimator, grid: list, folds: int = 10, parallelism: int = 4) -> CrossValidatorModel:
    """Best parameters by k-fold accuracy over stratified folds; fits run from several driver threads."""
    # read by every fold: written once with the columns that the fits need
    dealt = cut(assign_folds(rows, key, label, folds).withColumn("fold", F.col("fold").cast("int")))
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, foldCol="fold",
                          parallelism=parallelism).fit(dealt)


def text_grid_search(rows: TermRows, key: str, label: str, grid: list[dict], folds: int = 10, max_iter: int = 20, tol: float = 1e-6) -> list[float]:
    """Mean accuracy over stratified folds of a logistic regression per point of the grid; all folds and points are fitted together.

    A point has reg_param (half the squared weights against the mean loss). With use_idf, rows hold plain counts: vocabulary,
    term weights (on or off) and unit length are then learned from the training rows of each fold.
    """
    inside = "use_idf" in grid[0]
    dealt = assign_folds(rows.rows().where(F.col(label).isNotNull()), key, label, folds)
    pairs = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "fold"))).alias("folds"))
    lots = cut(rows.blocks.select("block", "n").join(pairs, "block", "left"))

    def numbered(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                fold, listed = np.full(batch.column("n")[i].as_py(), -1.0), batch.column("folds")[i].values
                if listed is not None:
                    fold[listed.field("place").to_numpy()] = listed.field("fold").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([fold.astype("<f8").tobytes()], pa.binary())], names=["block", "fold"])
    fold = cut(lots.mapInArrow(numbered, "block long, fold binary"))
    sizes = {r["fold"]: r["n"] for r in dealt.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}      # one row per fold
    total, models = sum(sizes.values()), [(f, p) for p in range(len(grid)) for f in range(folds)]
    penalty, out = np.array([float(grid[p]["reg_param"]) for _, p in models]), np.array([f for f, _ in models])
    weight = np.array([1.0 / max(1, total - sizes.get(f, 0)) for f in out])
    blocks, pick = rows.blocks, None
    if inside:
        blocks = fold_scales(rows.blocks, fold, folds, np.array([total - sizes.get(f, 0) for f in range(folds)]))
        pick = np.array([f + folds * (not grid[p]["use_idf"]) for f, p in models])

    def marks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                y = batch.column("kept")[i].values.field(label).cast(pa.float64()).to_numpy(zero_copy_only=False)
                lot = np.frombuffer(batch.column("fold")[i].as_buffer(), "<f8")[:, None]
                share = np.where((lot >= 0) & (lot != out), weight, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("n").slice(i, 1), *(pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in (np.nan_to_num(y), share))],
                                                 names=["block", "n", "label", "share"])
    marked = cut(rows.blocks.select("block", "n", "kept").join(fold, "block").mapInArrow(marks, "block long, n int, label binary, share binary"))
    fit = fit_rows(blocks, marked, penalty, tol, max_iter, pick)

    def hits(batch, i):
        lot, y = (np.frombuffer(batch.column(c)[i].as_buffer(), "<f8")[:, None] for c in ("fold", "label"))
        z = np.frombuffer(batch.column("y")[i].as_buffer(), "<f8").reshape(-1, len(models))
        return np.vstack([((lot == out) & ((z > 0) == (y > 0))).sum(axis=0), (lot == out).sum(axis=0)])
    right, held = _tree(fit.margins().join(fold, "block").join(marked.select("block", "label"), "block"), hits)
    share = (right / np.where(held > 0, held, np.nan)).reshape(len(grid), folds)
    return [float(a) for a in share.mean(axis=1)]


def point_vectors(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(vec, lambda v: v.cast("double"))))


def kmeans(rows: DataFrame | TermRows, k: int, max_iter: int = 100, seed: int = 1):
    if isinstance(rows, TermRows):
        return term_kmeans(rows, k, max_iter, seed)
    return KMeans(k=k, maxIter=max_iter, seed=seed).fit(rows)


def kmeans_elbow(rows: DataFrame, ks: list[int], max_iter: int = 100, seed: int = 1) -> DataFrame:
    """Inertia per number of clusters. One cluster is the sum of squares around the mean."""
    kept = cut(rows.select("features"))
    costs = [(k, float(kmeans(kept, k, max_iter, seed).summary.trainingCost)) for k in ks if k > 1]
    if 1 in ks:
        from pyspark.ml.stat import Summarizer
        s = kept.select(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).select("s.*").first()
        costs.append((1, float(s["variance"].toArray().sum() * (s["count"] - 1))))
    return rows.sparkSession.createDataFrame(sorted(costs), "k int, inertia double")


def cluster_top_terms(model: TermMeans, n: int = 20) -> DataFrame:
    """Heaviest terms of each cluster centre of a fitted model: (cluster, term, weight)."""
    return model.top_terms(n)


def group_top_terms(rows: TermRows, group: str, n: int = 20) -> DataFrame:
    """Heaviest terms of the mean row of each group, groups numbered in order: (cluster, term, weight)."""
    counts = rows.rows().groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(group).collect()         # one row per group
    place = {r[group]: (j, r["n"]) for j, r in enumerate(counts)}

    def shares(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                names = batch.column("kept")[i].values.field(group).to_pylist()
                y = np.zeros((len(names), len(place)))
                for at, name in enumerate(names):
                    y[at, place[name][0]] = 1 / place[name][1]
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([y.tobytes()], pa.binary())], names=["block", "y"])
    return top_words(rows, rows.blocks.mapInArrow(shares, "block long, y binary"), len(place), n)


def _squared_gap(centre: Column, point: Column) -> Column:
    return F.aggregate(F.zip_with(centre, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def assign_nearest(df: DataFrame, key: str, vec: str, centres: list[list[float]]) -> tuple[DataFrame, DataFrame]:
    """Nearest centre of each row (lowest number on ties) and the mean of each cluster."""
    x = F.transform(vec, lambda v: v.cast("double"))
    gaps = df.withColumn("_x", x).withColumn("_g", F.transform(literal_matrix(centres), lambda c: F.round(_squared_gap(c, F.col("_x")), 12)))
    placed = gaps.withColumn("cluster", F.array_position("_g", F.array_min("_g")).cast("int") - 1).drop("_g")
    means = vector_entries(placed, "_x", "cluster").groupBy("cluster", "dim").agg(F.avg("value").alias("mean"))
    return placed.drop("_x"), means


def soft_kmeans_step(df: DataFrame, vec: str, centres: list[list[float]], beta: float = 1.0) -> DataFrame:
    """One update: weight exp(-beta d) shared over the centres, new means (cluster, dim, mean)."""
    return _soft_sums(df, vec, centres, beta).select("cluster", "dim", (F.col("wx") / F.col("w")).alias("mean"))


def _soft_weights(df: DataFrame, vec: str, centres: list[list[float]], beta: float) -> DataFrame:
    # subtracting the smallest distance leaves the shares as they are and keeps exp() away from underflow
    gaps = (df.select(F.transform(vec, lambda v: v.cast("double")).alias("_x"))
            .withColumn("_g", F.transform(literal_matrix(centres), lambda c: _squared_gap(c, F.col("_x"))))
            .withColumn("_e", F.transform("_g", lambda g: F.exp(-beta * (g - F.array_min("_g")))))
            .withColumn("_s", F.aggregate("_e", F.lit(0.0), lambda s, v: s + v)))
    return gaps.select("_x", F.posexplode(F.transform("_e", lambda e: e / F.col("_s"))).alias("cluster", "r"))


def _soft_sums(df: DataFrame, vec: str, centres: list[list[float]], beta: float) -> DataFrame:
    rows = _soft_weights(df, vec, centres, beta).select("cluster", "r", F.posexplode("_x").alias("dim", "x"))
    return rows.groupBy("cluster", "dim").agg(F.sum("r").alias("w"), F.sum(F.col("r") * F.col("x")).alias("wx"),
                                              F.sum(F.col("r") * F.col("x") * F.col("x")).alias("wxx"))


def soft_kmeans(df: DataFrame, vec: str, centres: list[list[float]], beta: float = 1.0, max_iter: int = 20,
                tol: float = 1e-4) -> tuple[np.ndarray, list[float]]:
    """Soft k-means from given centres; stops when the cost changes by less than tol. Returns centres and costs.

    Each round is one aggregate of clusters x width rows; the cost follows from the same sums.
    """
    kept = cut(df.select(vec))
    points, costs = np.asarray(centres, dtype=float), []
    for _ in range(max_iter):
        rows = _soft_sums(kept, vec, points.tolist(), beta).collect()
        cost = 0.0
        new = points.copy()
        for r in rows:
            m = r["wx"] / r["w"]
            new[r["cluster"], r["dim"]] = m
            cost += r["wxx"] - 2 * m * r["wx"] + m * m * r["w"]
        points = new
        costs.append(float(cost))
        if len(costs) > 1 and abs(costs[-1] - costs[-2]) < tol:
            break
    return points, costs

