"""Looking at a table: counts, types, quantiles, frequencies, histograms."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.numbers import normal_quantile
from lumenframe.functions.ordering import cut, ranked, running, sort_key


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows in the given order."""
    return df.orderBy(*[sort_key(o) for o in order]).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "n_null")


def column_types(df: DataFrame) -> DataFrame:
    """One row per column with its Spark type."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v").where("v is not null")


def _steps(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column with their count n and the running count; equal values meet before the shuffle."""
    counts = _long(df, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return cut(running(counts, ["column"], ["v"], {"upto": ("sum", "n")}))


def _quantiles(steps: DataFrame, probs: list[float]) -> DataFrame:
    totals = steps.groupBy("column").agg(F.max("upto").alias("total"))  # one row per column name
    at = (steps.join(totals, "column")
          .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
          .withColumn("h", (F.col("total") - 1) * F.col("prob")))
    below = F.col("upto") - F.col("n")
    holds = lambda place: (place > below) & (place <= F.col("upto"))
    near = at.where(holds(F.floor("h") + 1) | holds(F.ceil("h") + 1))
    return near.groupBy("column", "prob", "h").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(
        "column", "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("h") - F.floor("h"))).alias("quantile"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation per column, from running counts over the distinct values."""
    return _quantiles(_steps(df, cols), probs)


def summary_stats(df: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """min, first quartile, median, mean, third quartile and max per column; accuracy switches to the sketch."""
    if accuracy:
        out = _long(df, cols).groupBy("column").agg(F.min("v").alias("min"), F.avg("v").alias("mean"), F.max("v").alias("max"),
                                                    F.percentile_approx("v", [0.25, 0.5, 0.75], accuracy).alias("q"))
        return out.select("column", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), "mean",
                          F.col("q")[2].alias("q3"), "max")
    steps = _steps(df, cols)        # the data is read once; everything else comes from the counted values
    ends = steps.groupBy("column").agg(F.min("v").alias("min"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"),
                                       F.max("v").alias("max"))
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    quartiles = _quantiles(steps, [0.25, 0.5, 0.75]).groupBy("column").agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    return ends.join(quartiles, "column").select("column", "min", "q1", "median", "mean", "q3", "max")


def category_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, col: str, k: int, skip: int = 0) -> DataFrame:
    """The k most frequent values after leaving out the first `skip` ranks; ties go to the smaller value."""
    best = category_counts(df, col).orderBy(F.desc("n"), F.asc(col)).limit(k + skip)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), F.asc(col)))
    return best.select(col, "n", rank.alias("rank")).where(F.col("rank") > skip)


def category_shares(df: DataFrame, col: str) -> DataFrame:
    """Percent of rows per value."""
    counts = category_counts(df, col)
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(col, "n", (100 * F.col("n") / total).alias("percent"))


def crosstab(df: DataFrame, a: str, b: str, wide_values: list | None = None) -> DataFrame:
    """Two-way frequencies: long, or one column per value of b when those values are given."""
    if wide_values is None:
        return category_counts(df, a, b)
    return df.groupBy(a).pivot(b, wide_values).count().na.fill(0)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed on both sides."""
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    if ends["lo"] is None:
        raise ValueError(f"column {col} has no values")
    width = (ends["hi"] - ends["lo"]) / bins or 1.0
    place = F.least(F.floor((F.col(col) - ends["lo"]) / width), F.lit(bins - 1))
    return (df.where(F.col(col).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (ends["lo"] + F.col("bin") * width).alias("left_edge"), "n"))


def density(df: DataFrame, col: str, grid: int = 64, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid: one pass with one average per grid point.

    The default bandwidth is 0.9 * min(sd, IQR / 1.34) * n^(-1/5); the grid reaches three bandwidths beyond the values.
    """
    s = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.stddev_samp(col).alias("sd"),
               F.count(col).alias("n")).first()
    if bandwidth is None:
        low, high = (r.quantile for r in exact_quantiles(df, [col], [0.25, 0.75]).orderBy("prob").collect())
        bandwidth = 0.9 * (min(s["sd"], (high - low) / 1.34) or s["sd"] or 1.0) * s["n"] ** -0.2
    h = bandwidth
    start, step = s["lo"] - 3 * h, (s["hi"] - s["lo"] + 6 * h) / (grid - 1)
    points = F.array(*[F.lit(start + i * step) for i in range(grid)])
    z = (F.col("x") - F.col("point")) / h
    kernel = F.exp(-z * z / 2) / (h * math.sqrt(2 * math.pi))
    # no shuffle of the data: every map task adds its rows up per grid point
    return (df.where(F.col(col).isNotNull()).select(F.col(col).alias("x"), F.posexplode(points).alias("grid_id", "point"))
            .groupBy("grid_id", "point").agg((F.sum(kernel) / s["n"]).alias("density")))


def qq_points(df: DataFrame, col: str, key: str) -> DataFrame:
    """Each value with its rank and the normal quantile at its plotting position."""
    rows = ranked(df.where(F.col(col).isNotNull()).select(key, F.col(col).cast("double").alias("sample")),
                  ["sample", key])
    n = rows.agg(F.max("rank")).scalar()
    a = F.when(n <= 10, 0.375).otherwise(0.5)
    return rows.select(key, "rank", "sample",
                       normal_quantile((F.col("rank") - a) / (n + 1 - 2 * a)).alias("theoretical"))
