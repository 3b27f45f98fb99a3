"""Scores of candidate selections and of bit strings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join


def score_selections(chosen: DataFrame, edges: DataFrame) -> DataFrame:
    """Cost of the chosen (candidate, edge) rows with (edge, cost), and fitness 1 - cost / cost of all edges."""
    total = edges.agg(F.sum("cost")).scalar()
    priced = salted_join(chosen.select("candidate", "edge"), edges.select("edge", "cost"), "edge", "inner")
    return priced.groupBy("candidate").agg(F.sum("cost").alias("cost")).select(
        "candidate", "cost", (1 - F.col("cost") / total).alias("fitness"))


def score_summary(scores: DataFrame) -> DataFrame:
    """Best and mean fitness of a population."""
    return scores.agg(F.max("fitness").alias("best"), F.avg("fitness").alias("mean"), F.count(F.lit(1)).alias("candidates"))


def decode(bits: Column, lo: float, hi: float, size: int) -> Column:
    """Number in [lo, hi] from a string of `size` bits."""
    return F.conv(bits, 2, 10).cast("double") * ((hi - lo) / (2 ** size - 1)) + lo


def decode_and_score(df: DataFrame, bits: str, size: int, lo: float = -6.0, hi: float = 6.0) -> DataFrame:
    """The second half of the string is x, the first half y; value is (x^2 + y - 11)^2 + (x + y^2 - 7)^2."""
    half = size // 2
    x, y = F.col("x"), F.col("y")
    out = df.withColumns({"x": decode(F.substring(bits, half + 1, half), lo, hi, half),
                          "y": decode(F.substring(bits, 1, half), lo, hi, half)})
    first, second = x * x + y - 11, x + y * y - 7
    return out.withColumn("value", first * first + second * second)
