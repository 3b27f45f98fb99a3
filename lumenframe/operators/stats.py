"""Statistical tests. Spark aggregates to one row; tail probabilities are then a formula on that row."""
from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions import tails
from lumenframe.functions.joins import salted_join
from lumenframe.functions.numbers import log_normal_cdf, normal_quantile
from lumenframe.functions.ordering import cut, ranked, running, value_steps


def _with_p(one: DataFrame, p_of: Callable) -> DataFrame:
    """Add the p-value to a one-row result."""
    row = one.first()
    try:
        p = float(p_of(row))
    except (TypeError, ValueError, ZeroDivisionError, OverflowError):
        p = None
    return one.sparkSession.createDataFrame([(*row, p)], one.schema.add("p_value", "double"))


def covariance(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.covar_samp(a, b).alias("covariance"))


def pearson_test(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    one = both.agg(F.corr(a, b).alias("r"), (F.count(F.lit(1)) - 2).alias("df"))
    r = F.col("r")
    return _with_p(one.select("r", (r * F.sqrt(F.col("df") / (1 - r * r))).alias("t"), "df"),
                   lambda x: tails.student_two_sided(x["t"], x["df"]))


def _mid_ranks(pairs: DataFrame, col: str, out: str) -> DataFrame:
    """Average rank of each distinct value, from weighted counts."""
    steps = value_steps(pairs, col, {"w": F.col("n")})
    return steps.select(col, (F.col("cum_w") - (F.col("w") - 1) / 2).alias(out))


def spearman_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation with average ranks for ties."""
    pairs = cut(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))
    rows = salted_join(salted_join(pairs, _mid_ranks(pairs, a, "_ra"), a, "inner"), _mid_ranks(pairs, b, "_rb"), b, "inner")
    total = pairs.agg(F.sum("n")).scalar()
    x, y, n = F.col("_ra") - (total + 1) / 2, F.col("_rb") - (total + 1) / 2, F.col("n")
    one = rows.agg((F.sum(n * x * y) / F.sqrt(F.sum(n * x * x) * F.sum(n * y * y))).alias("rho"), F.sum("n").alias("n"))
    r = F.col("rho")
    return _with_p(one.select("rho", "n", (r * F.sqrt((F.col("n") - 2) / (1 - r * r))).alias("t")),
                   lambda v: tails.student_two_sided(v["t"], v["n"] - 2))


def kendall_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Tau-b without comparing pairs of rows.

    b is coded 1..m. Two codes differ first at one bit, so a pair is counted once: in the group of codes that share
    the bits above it, as a zero before a one. A running count of zeros by a in each group and bit gives all
    concordant pairs in log2(m) rows per distinct (a, b).
    """
    pairs = cut(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b"))
                .agg(F.count(F.lit(1)).alias("n")))
    codes = cut(ranked(pairs.select("b").distinct(), ["b"], "code"))
    m = codes.count()
    bits = max(1, m.bit_length())
    level = F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))
    coded = salted_join(pairs, codes, "b", "inner").withColumn("level", level)
    split = coded.select("level", "a", "n", F.expr("shiftright(code, level + 1)").alias("head"),
                         F.expr("shiftright(code, level) & 1").alias("bit"))
    sums = split.groupBy("level", "head", "a").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("zeros"),
                                                   F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("ones"))
    counted = running(sums, ["level", "head"], ["a"], {"upto": ("sum", "zeros")})
    conc = counted.agg(F.sum(F.col("ones").cast("double") * (F.col("upto") - F.col("zeros")))).scalar()
    two = lambda n: n.cast("double") * (n - 1) / 2
    ties = lambda c: pairs.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n")))).scalar()
    one = pairs.agg(F.sum("n").alias("n"), F.sum(two(F.col("n"))).alias("both")).select(
        "n", two(F.col("n")).alias("n0"), ties("a").alias("n1"), ties("b").alias("n2"), "both", conc.alias("c"))
    one = one.withColumn("d", F.col("n0") - F.col("n1") - F.col("n2") + F.col("both") - F.col("c"))
    tau = F.try_divide(F.col("c") - F.col("d"), F.sqrt((F.col("n0") - F.col("n1")) * (F.col("n0") - F.col("n2"))))
    return _with_p(one.select(tau.alias("tau"), F.col("c").alias("concordant"), F.col("d").alias("discordant"), "n"),
                   lambda v: tails.normal_two_sided(3 * v["tau"] * math.sqrt(v["n"] * (v["n"] - 1)) / math.sqrt(2 * (2 * v["n"] + 5))))


def chi_square(df: DataFrame, a: str, b: str, correct: bool = False) -> DataFrame:
    """Independence of two categories. Cells without rows enter through n * (sum of o^2 / (row * col) - 1).

    With `correct`, two by two tables get the continuity correction: with the same gap g in all four cells it replaces g
    by g - min(1/2, g), so the statistic is scaled by the square of the ratio.
    """
    cells = cut(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b"))
                .agg(F.count(F.lit(1)).alias("o")))
    row, col = (cells.groupBy(c).agg(F.sum("o").alias(f"n_{c}")) for c in ("a", "b"))
    o = F.col("o").cast("double")
    share = F.sum(o * o / (F.col("n_a").cast("double") * F.col("n_b")))
    gap = F.max(F.abs(o - F.col("n_a").cast("double") * F.col("n_b") / F.col("n")))
    total = cells.agg(F.sum("o").alias("n"))
    one = cells.join(row, "a").join(col, "b").join(F.broadcast(total), F.lit(True)).agg(
        (F.sum("o") * (share - 1)).alias("statistic"), ((F.count_distinct("a") - 1) * (F.count_distinct("b") - 1)).alias("df"),
        (F.count_distinct("a") * F.count_distinct("b")).alias("cells"), gap.alias("gap"))
    shrink = F.when((F.col("cells") == 4) & F.lit(correct) & (F.col("gap") > 0), F.pow((F.col("gap") - F.least(F.lit(0.5), F.col("gap"))) / F.col("gap"), 2)).otherwise(1.0)
    one = one.select((F.col("statistic") * shrink).alias("statistic"), "df")
    return _with_p(one, lambda v: tails.chi_square_upper(v["statistic"], v["df"]))


def anderson_darling(df: DataFrame, col: str) -> DataFrame:
    """A squared for normality with estimated mean and sample deviation; rank weights of ties are summed per value."""
    s = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_samp(col).alias("sd"), F.count(col).alias("n"))).scalar()
    steps = value_steps(df, col)
    z = (F.col(col) - s["m"]) / s["sd"]
    n, hi = s["n"].cast("double"), F.col("cum_n").cast("double")
    lo = hi - F.col("n")
    term = (hi * hi - lo * lo) * log_normal_cdf(z) + ((n - lo) * (n - lo) - (n - hi) * (n - hi)) * log_normal_cdf(-z)
    one = steps.agg(F.sum(term).alias("t"), F.sum("n").alias("n")).select((-F.col("n") - F.col("t") / F.col("n")).alias("a2"), "n")
    return _with_p(one, lambda v: tails.anderson_normal(v["a2"], v["n"]))


def shapiro_francia(df: DataFrame, col: str, key: str) -> DataFrame:
    """Squared correlation of the ordered values with normal scores."""
    rows = ranked(df.where(F.col(col).isNotNull()).select(key, F.col(col).cast("double").alias("sample")), ["sample", key])
    n = rows.agg(F.max("rank")).scalar()
    scored = rows.withColumn("score", normal_quantile((F.col("rank") - 0.375) / (n + 0.25)))
    one = scored.agg(F.corr("sample", "score").alias("r"), F.count(F.lit(1)).alias("n")).select((F.col("r") * F.col("r")).alias("w"), "n")
    return _with_p(one, lambda v: tails.shapiro_francia_p(v["w"], v["n"]))


def ks_two_sample(df: DataFrame, a: str, b: str) -> DataFrame:
    """Largest gap between the distribution functions of two columns."""
    long = df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).unpivot([], ["a", "b"], "side", "v")
    steps = value_steps(long, "v", {"na": (F.col("side") == "a").cast("long"), "nb": (F.col("side") == "b").cast("long")})
    t = df.agg(F.struct(F.count(a).alias("na"), F.count(b).alias("nb"))).scalar()
    one = steps.agg(F.max(F.abs(F.col("cum_na") / t["na"] - F.col("cum_nb") / t["nb"])).alias("d"),
                    F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    return _with_p(one, lambda v: tails.kolmogorov_upper(v["d"], v["na"] * v["nb"] / (v["na"] + v["nb"])))


def mardia(df: DataFrame, cols: list[str]) -> DataFrame:
    """Multivariate kurtosis and its normal statistic."""
    rows = df.dropna(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    s = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = s[f"c{i}_{j}"]
    inverse = np.linalg.inv(cov)
    x = [F.col(c) - s[f"m{i}"] for i, c in enumerate(cols)]
    d2 = sum((x[i] * x[j] * float(inverse[i, j]) for i in range(len(cols)) for j in range(len(cols))), F.lit(0.0))
    p = len(cols)
    one = rows.agg(F.avg(d2 * d2).alias("kurtosis"), F.count(F.lit(1)).alias("n"))
    return _with_p(one.select("kurtosis", ((F.col("kurtosis") - p * (p + 2)) / F.sqrt(8.0 * p * (p + 2) / F.col("n"))).alias("z"), "n"),
                   lambda v: tails.normal_two_sided(v["z"]))


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Line y = intercept + slope x with R squared and standard errors; one pass."""
    one = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
                 F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_avgx(y, x).alias("_mx"), F.regr_count(y, x).alias("n"))
    var = (1 - F.col("r2")) * F.col("_syy") / (F.col("n") - 2)
    return one.select("slope", "intercept", "r2", F.sqrt(var / F.col("_sxx")).alias("se_slope"),
                      F.sqrt(var * (1 / F.col("n") + F.col("_mx") * F.col("_mx") / F.col("_sxx"))).alias("se_intercept"), "n")


def anova_oneway(df: DataFrame, group: str, y: str) -> DataFrame:
    """Sums of squares between and within groups, F and p."""
    groups = df.groupBy(group).agg(F.count(y).alias("n"), F.avg(y).alias("m"), F.coalesce(F.var_pop(y), F.lit(0.0)).alias("v")).where("n > 0")
    grand = groups.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).scalar()
    gap = F.col("m") - grand
    one = groups.agg(F.sum(F.col("n") * gap * gap).alias("ss_between"), F.sum(F.col("n") * F.col("v")).alias("ss_within"),
                     (F.count(F.lit(1)) - 1).alias("df_between"), (F.sum("n") - F.count(F.lit(1))).alias("df_within"))
    f = F.try_divide(F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within"))
    return _with_p(one.withColumn("f", f), lambda v: tails.f_upper(v["f"], v["df_between"], v["df_within"]))

