"""Scores of classifiers and regressions, ROC and cumulative accuracy curves.

Curves come from the distinct scores with counts per score, so equal scores are added up before any ordering.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import running, value_steps


def _yes(label: str) -> Column:
    return F.col(label).cast("double")


def accuracy(df: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Share of rows on the right side of the cut."""
    return df.agg(F.avg(((F.col(score) >= cut) == (F.col(label) == 1)).cast("double")).alias("accuracy"))


def log_loss(df: DataFrame, label: str, score: str, eps: float = 1e-15) -> DataFrame:
    """Mean binary cross entropy, scores clipped to [eps, 1 - eps]."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(score)))
    return df.agg(F.avg(-(_yes(label) * F.ln(p) + (1 - _yes(label)) * F.ln(1 - p))).alias("log_loss"))


def confusion(df: DataFrame, label: str, score: str, cut: float = 0.5) -> DataFrame:
    """Counts of the four cells with accuracy, sensitivity, specificity and kappa."""
    up, yes = F.col(score) >= cut, F.col(label) == 1
    cells = df.agg(F.count_if(up & yes).alias("tp"), F.count_if(up & ~yes).alias("fp"),
                   F.count_if(~up & yes).alias("fn"), F.count_if(~up & ~yes).alias("tn"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    agree = (tp + tn) / n
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    return cells.select("tp", "fp", "fn", "tn", F.try_divide(tp + tn, n).alias("accuracy"),
                        F.try_divide(tp, tp + fn).alias("sensitivity"), F.try_divide(tn, tn + fp).alias("specificity"),
                        F.try_divide(agree - chance, 1 - chance).alias("kappa"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean squared error and R squared."""
    gap = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(gap * gap).alias("mse"), (1 - F.avg(gap * gap) / F.var_pop(actual)).alias("r2"))


def overfit_gap(train: DataFrame, test: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R squared on both parts and the difference."""
    other = regression_metrics(test, actual, predicted).select("r2").scalar()
    return regression_metrics(train, actual, predicted).select(
        F.col("r2").alias("train_r2"), other.alias("test_r2"), (F.col("r2") - other).alias("gap"))


def score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, from the highest down: positives, negatives and both running counts."""
    yes = (F.col(label) == 1).cast("long")
    return value_steps(df, score, {"pos": yes, "neg": 1 - yes}, descending=True)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every threshold, and the start point with a null threshold."""
    steps = score_steps(df, label, score)
    totals = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))).scalar()
    points = steps.select(F.col(score).alias("threshold"), F.try_divide(F.col("cum_neg"), totals["n"]).alias("fpr"),
                          F.try_divide(F.col("cum_pos"), totals["p"]).alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by trapezoids: one sum over the score steps."""
    piece = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2)
    return score_steps(df, label, score).agg(
        F.try_divide(F.sum(piece), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def cap_curve(df: DataFrame, label: str, score: str, key: str) -> DataFrame:
    """Positives among the first x rows by falling score; equal scores put positives first."""
    rows = df.select(key, F.col(score).alias("_s"), (F.col(label) == 1).cast("long").alias("_y"), F.lit(1).cast("long").alias("_one"))
    out = running(rows, [], ["-_s", "-_y", key], {"x": ("sum", "_one"), "y": ("sum", "_y")}).select("x", "y")
    return out.unionByName(df.sparkSession.createDataFrame([(0, 0)], "x long, y long"))


def cap_ratio(df: DataFrame, label: str, score: str) -> DataFrame:
    """(model area - random area) / (perfect area - random area)."""
    y0, pos, neg = (F.col("cum_pos") - F.col("pos")).cast("double"), F.col("pos").cast("double"), F.col("neg").cast("double")
    area = pos * y0 + pos * pos / 2 + neg * (y0 + pos)
    sums = score_steps(df, label, score).agg(F.sum(area).alias("model"), F.sum(pos).alias("p"), F.sum(neg).alias("q"))
    rand = (F.col("p") + F.col("q")) * F.col("p") / 2
    perfect = F.col("p") * F.col("p") / 2 + F.col("p") * F.col("q")
    return sums.select(F.try_divide(F.col("model") - rand, perfect - rand).alias("cap_ratio"))


def cap_at_half(df: DataFrame, label: str, score: str) -> DataFrame:
    """Percent of the positives found in the first half of the rows, with its rating."""
    steps = score_steps(df, label, score)
    n = df.where(F.col(score).isNotNull()).agg(F.count(F.lit(1))).scalar()
    half = F.floor(n / 2)
    x0 = F.col("cum_pos") + F.col("cum_neg") - F.col("pos") - F.col("neg")
    found = F.greatest(F.lit(0), F.least(half - x0, F.col("pos")))
    percent = F.try_divide(100 * F.sum(found), F.sum("pos"))
    one = steps.agg(percent.alias("percent"))
    rating = (F.when(F.col("percent") < 60, "Rubbish").when(F.col("percent") < 70, "Poor").when(F.col("percent") < 80, "Good")
              .when(F.col("percent") <= 90, "Very Good").when(F.col("percent") > 90, "Too Good to be True"))
    return one.select("percent", rating.alias("rating"))
