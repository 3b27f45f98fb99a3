"""Group totals, intervals, pivots, mean vectors, covariance and correlation."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.joins import checked_rows
from lumenframe.functions.ordering import sort_key


def group_sum(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias("total"))


def group_mean_ci(df: DataFrame, keys: list[str], col: str, z: float = 1.96) -> DataFrame:
    """Mean with a normal 95 % interval per group."""
    half = z * F.col("sd") / F.sqrt("n")
    return (df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"), F.count(col).alias("n"))
            .select(*keys, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high")))


def series_pivot(df: DataFrame, x: str, series: str, value: str, names: list[str]) -> DataFrame:
    """Sum of value per x with one column per series name."""
    return df.groupBy(x).pivot(series, names).agg(F.sum(value))


def concat_top(df: DataFrame, group: str, order: list[str], name: str, k: int, sep: str = " , ") -> DataFrame:
    """First k names of each group in order, joined to one string."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*[sort_key(o) for o in order]))
    top = df.withColumn("_rn", rank).where(F.col("_rn") <= k)
    names = F.transform(F.array_sort(F.collect_list(F.struct("_rn", name))), lambda s: s[name])
    return top.groupBy(group).agg(F.array_join(names, sep).alias("names"))


def max_of(df: DataFrame, col: str) -> DataFrame:
    """Largest number in a column that may hold text."""
    return df.agg(F.max(F.col(col).try_cast("long")).alias("max_value"))


def vector_entries(df: DataFrame, vec: str, *keep: str) -> DataFrame:
    """One row per coordinate: dim, value."""
    return df.select(*keep, F.posexplode(F.col(vec)).alias("dim", "_v")).withColumn("value", F.col("_v").cast("double")).drop("_v")


def mean_vector(df: DataFrame, vec: str) -> DataFrame:
    """Mean of each coordinate."""
    return vector_entries(df, vec).groupBy("dim").agg(F.avg("value").alias("mean"))


def class_mean_vectors(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Mean of each coordinate per class."""
    return vector_entries(df, vec, label).groupBy(label, "dim").agg(F.avg("value").alias("mean"))


def _pair_table(df: DataFrame, cols: list[str], fn, name: str) -> DataFrame:
    """One aggregate per unordered column pair in one pass, returned as a full (row, col) table."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[fn(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for r, c in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), F.col(f"`{i}`").alias(name)))
    return one.select(F.inline(F.array(*entries)))


def covariance_matrix(df: DataFrame, cols: list[str], sample: bool = False) -> DataFrame:
    """Population (default) or sample covariance of every column pair."""
    return _pair_table(df, cols, F.covar_samp if sample else F.covar_pop, "covariance")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    return _pair_table(df, cols, F.corr, "correlation")


def affine_map(df: DataFrame, key: str, vec: str, matrix: DataFrame, offset: DataFrame, limit: int = 250_000) -> DataFrame:
    """A x + b for each row, A as (i, j, a) and b as (i, b); both are checked to be small enough to hand out."""
    rows = matrix.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "a"))).alias("row"))
    lines = rows.join(offset, "i", "left").select("i", "row", F.coalesce("b", F.lit(0.0)).cast("double").alias("b"))
    total = lambda line: F.aggregate(
        line["row"], line["b"],
        lambda s, e: s + e["a"] * F.element_at(F.col(vec), e["j"].cast("int") + 1).cast("double"))
    out = F.transform("_lines", lambda line: F.struct(line["i"].alias("i"), total(line).alias("y")))
    return df.withColumn("_lines", checked_rows(lines, limit)).select(key, F.inline(out))


def affine_moments(mean: DataFrame, cov: DataFrame, matrix: DataFrame, offset: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Moments after x -> A x + b, from (i, mean), (row, col, covariance), (i, j, a) and (i, b) tables."""
    moved = (matrix.join(mean.withColumnRenamed("i", "j"), "j").groupBy("i").agg(F.sum(F.col("a") * F.col("mean")).alias("m"))
             .join(offset, "i", "left").select("i", (F.col("m") + F.coalesce("b", F.lit(0.0))).alias("mean")))
    left = (matrix.join(cov, F.col("j") == F.col("row")).groupBy("i", "col")
            .agg(F.sum(F.col("a") * F.col("covariance")).alias("part")))
    right = matrix.select(F.col("i").alias("i2"), F.col("j").alias("j2"), F.col("a").alias("a2"))
    spread = (left.join(right, F.col("col") == F.col("j2")).groupBy(F.col("i").alias("row"), F.col("i2").alias("col"))
              .agg(F.sum(F.col("part") * F.col("a2")).alias("covariance")))
    return moved, spread
