"""Covariance of vectors, standardising, PCA, SVD, projections and feature selection."""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import cut
from lumenframe.operators.aggregate import vector_entries
from lumenframe.operators.svd import svd_model

MAX_WIDTH = 8_192     # a width x width matrix is the only thing that reaches the driver


def _rows(df: DataFrame, vec: str) -> RowMatrix:
    points = df.select(array_to_vector(F.transform(vec, lambda v: v.cast("double"))).alias("x"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(points, "x"))


def _width(df: DataFrame, vec: str) -> int:
    width = df.agg(F.max(F.size(vec))).first()[0]
    if width is None or width > MAX_WIDTH:
        raise ValueError(f"vectors must have between 1 and {MAX_WIDTH} coordinates, got {width}")
    return width


def vector_covariance(df: DataFrame, vec: str, sample: bool = False) -> DataFrame:
    """Covariance of vector coordinates as (row, col, covariance); summed on executors, width x width on the driver."""
    _width(df, vec)
    matrix = _rows(df, vec)
    n = matrix.numRows()
    cov = np.asarray(matrix.computeCovariance().toArray()) * (1.0 if sample else (n - 1) / n)
    cells = [(i, j, float(cov[i, j])) for i in range(cov.shape[0]) for j in range(cov.shape[1])]
    return df.sparkSession.createDataFrame(cells, "row int, col int, covariance double")


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None, suffix: str = "_std") -> DataFrame:
    """Zero mean and unit population deviation; a deviation of 0 counts as 1. fit_on gives the training rows."""
    stats = (df if fit_on is None else fit_on).agg(F.struct(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
    scale = lambda c: F.when(stats[f"s_{c}"] == 0, 1.0).otherwise(stats[f"s_{c}"])
    return df.withColumns({c + suffix: (F.col(c) - stats[f"m_{c}"]) / scale(c) for c in cols})


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def literal_matrix(rows) -> Column:
    return F.array(*[literal_vector(r) for r in rows])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _matrix_times(matrix: np.ndarray, before: np.ndarray | float = 0.0, after: np.ndarray | float = 0.0):
    """matrix (x - before) + after for a column of arrays, a batch at a time; all null for rows that are null, hold a null or have another width.

    As expressions the columns are put into each other: every entry of a result would compute the whole row before it again.
    """
    height, width = matrix.shape

    @F.arrow_udf("array<double>")
    def times(rows: pa.Array) -> pa.Array:
        length, flat = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False), rows.flatten()
        owner = np.repeat(np.arange(len(rows)), length)
        fit = (length == width) & (np.bincount(owner, weights=flat.is_null().to_numpy(zero_copy_only=False), minlength=len(rows)) == 0)
        found = np.zeros((len(rows), height))
        found[fit] = (pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)[fit[owner]].reshape(-1, width) - before) @ matrix.T + after
        cells = pa.array(found.ravel(), mask=np.repeat(~fit, height))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, height), pa.int32()), cells)
    return times


class PcaModel:
    """Mean, unit components (k x width) and explained variances of a fitted PCA; all are small driver arrays."""

    def __init__(self, mean: np.ndarray, components: np.ndarray, variances: np.ndarray, total: float) -> None:
        self.mean, self.components, self.variances, self.total = mean, components, variances, total

    def scores(self, df: DataFrame, vec: str, out: str = "scores") -> DataFrame:
        return df.withColumn(out, _matrix_times(self.components, before=self.mean)(F.transform(vec, lambda v: v.cast("double"))))

    def reconstruct(self, df: DataFrame, scores: str, out: str = "rebuilt") -> DataFrame:
        return df.withColumn(out, _matrix_times(self.components.T, after=self.mean)(F.col(scores)))

    def table(self, spark) -> DataFrame:
        share = self.variances / self.total
        return spark.createDataFrame([(i, float(v), float(s)) for i, (v, s) in enumerate(zip(self.variances, share))],
                                     "component int, variance double, share double")


def fixed_sign(components: np.ndarray) -> np.ndarray:
    """Each component turned so that its entry of largest size is positive."""
    at = np.abs(components).argmax(axis=1)
    sign = np.sign(components[np.arange(len(components)), at])
    return components * np.where(sign == 0, 1.0, sign)[:, None]


def pca(df: DataFrame, vec: str, k: int) -> PcaModel:
    """Principal components of the rows (population variances). Width, mean and variances come from one pass."""
    points = df.where(F.col(vec).isNotNull()).select(array_to_vector(F.transform(vec, lambda v: v.cast("double"))).alias("x"))
    sums = points.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("x")).alias("s")).select("s.*").first()
    mean, n = sums["mean"].toArray(), sums["count"]
    if not 0 < len(mean) <= MAX_WIDTH:
        raise ValueError(f"vectors must have between 1 and {MAX_WIDTH} coordinates, got {len(mean)}")
    total = float(sums["variance"].toArray().sum() * (n - 1) / n)
    fitted = PCA(k=k, inputCol="x", outputCol="y").fit(points)
    components = fixed_sign(np.asarray(fitted.pc.toArray()).T)
    return PcaModel(mean, components, np.asarray(fitted.explainedVariance.toArray()) * total, total)


class WidePca:
    """A PCA of few rows with very many coordinates: the components stay a table (dim, mean, loadings)."""

    def __init__(self, variances: np.ndarray, total: float, loadings: DataFrame) -> None:
        self.variances, self.total, self.loadings = variances, total, loadings

    def table(self, spark) -> DataFrame:
        return PcaModel(None, None, self.variances, self.total).table(spark)

    def scores(self, df: DataFrame, key: str, vec: str) -> DataFrame:
        """(key, scores) of rows by the components."""
        joined = vector_entries(df, vec, key).join(self.loadings, "dim")
        parts = joined.select(key, F.posexplode(F.transform("loadings", lambda c: c * (F.col("value") - F.col("mean")))).alias("_j", "_v"))
        sums = parts.groupBy(key, "_j").agg(F.sum("_v").alias("_v"))
        return sums.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", "_v"))), lambda e: e["_v"]).alias("scores"))


def pca_wide(df: DataFrame, key: str, vec: str, k: int, limit: int = 2_000) -> WidePca:
    """Principal components of few rows with very many coordinates, from the row-by-row Gram matrix X X^T.

    Coordinates are the distributed side: each becomes one row of n values, n being checked against `limit`. The driver
    sees the n x n matrix and the largest loading of each component, whose sign is made positive.
    """
    n = df.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"pca_wide takes at most {limit} rows; use pca")
    entries = vector_entries(df, vec, key)
    packed = entries.groupBy("dim").agg(F.avg("value").alias("m"),
                                        F.array_sort(F.collect_list(F.struct(key, "value"))).alias("_r"))
    columns = cut(packed.select("dim", "m", F.transform("_r", lambda r: r["value"] - F.col("m")).alias("x")))
    gram = np.asarray(_rows(columns, "x").computeGramianMatrix().toArray()) / n
    values, vectors = np.linalg.eigh(gram)
    best = np.argsort(values)[::-1][:k]
    weights = vectors[:, best] / np.sqrt(np.maximum(values[best], 1e-300) * n)
    # component j = sum over rows of weight * centred row: one narrow projection per coordinate
    loaded = columns.select("dim", F.col("m").alias("mean"), F.array(*[dot(F.col("x"), literal_vector(weights[:, j])) for j in range(len(best))]).alias("loadings"))
    tops = loaded.select(*[F.max_by(F.get("loadings", F.lit(j)), F.struct(F.abs(F.get("loadings", F.lit(j))), -F.col("dim"))).alias(f"t{j}") for j in range(len(best))]).first()
    signs = literal_vector([-1.0 if t is not None and t < 0 else 1.0 for t in tops])
    turned = loaded.withColumn("loadings", F.zip_with("loadings", signs, lambda c, s: c * s))
    return WidePca(values[best], float(values.clip(min=0).sum()), turned)


def pca_error_curve(df: DataFrame, vec: str, ks: list[int], limit: float | None = None) -> tuple[DataFrame, int | None]:
    """Mean squared rebuilding error per k from one fit: the sum of the dropped variances; smallest k under a limit."""
    model = pca(df, vec, max(ks))
    errors = [(k, float(model.total - model.variances[:k].sum())) for k in sorted(ks)]
    under = next((k for k, e in errors if limit is not None and e < limit), None)
    return df.sparkSession.createDataFrame(errors, "k int, error double"), under


def truncated_svd(df: DataFrame, vec: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors (k x width) as arrays, for narrow data; svd_model keeps the vectors as a table."""
    model, width = svd_model(df, vec, k), df.select(vector_width(vec).alias("w")).agg(F.max("w")).first()[0]
    return model.values, fixed_sign(model.components(width))


def vector_width(vec: str) -> Column:
    return F.when(F.col(vec).isNotNull(), F.size(vector_to_array(vec)))


def reduced_rows(df: DataFrame, vec: str, components: np.ndarray, out: str = "reduced") -> DataFrame:
    """Rows times the right vectors of truncated_svd; a row touches only the columns in which it is not zero.

    The components (k x width, model data that the fit already holds) are sent to each worker once.
    """
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(components.T))

    @F.pandas_udf("array<double>")
    def times(vectors: pd.DataFrame) -> pd.Series:
        table = shared.value            # a vector arrives as its parts; dense ones have no indices
        return pd.Series([np.asarray(x) @ (table if i is None else table[np.asarray(i, dtype=int)])
                          for i, x in zip(vectors["indices"], vectors["values"], strict=True)])
    return df.withColumn(out, times(vec))


def projection_matrix(basis: list[list[float]]) -> np.ndarray:
    """B (B^T B)^-1 B^T for a width x m basis; a plain list is one direction."""
    b = np.asarray(basis, dtype=float)
    b = b[:, None] if b.ndim == 1 else b
    return b @ np.linalg.solve(b.T @ b, b.T)


def project(df: DataFrame, vec: str, basis, out: str = "projected") -> DataFrame:
    """Orthogonal projection of each row: coefficients first, so no width x width matrix is handed out."""
    b = np.asarray(basis, dtype=float)
    b = b[:, None] if b.ndim == 1 else b
    left = np.linalg.solve(b.T @ b, b.T)
    x = F.transform(vec, lambda v: v.cast("double"))
    return (df.withColumn("_x", x)
            .withColumn("_coef", F.transform(literal_matrix(left), lambda r: dot(r, F.col("_x"))))
            .withColumn(out, F.transform(literal_matrix(b), lambda r: dot(r, F.col("_coef")))).drop("_x", "_coef"))


def select_features(df: DataFrame, features: list[str], target: str, min_var: float, min_corr: float) -> DataFrame:
    """Variance and target correlation of each column and whether both reach the limits; one pass."""
    one = df.agg(*[F.struct(F.var_pop(c).alias("variance"), F.corr(c, target).alias("corr")).alias(c) for c in features])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["variance"].alias("variance"), F.col(c)["corr"].alias("corr"))
                     for c in features])
    keep = (F.col("variance") >= min_var) & (F.abs("corr") >= min_corr)
    return one.select(F.inline(rows)).withColumn("kept", F.coalesce(keep, F.lit(False)))

