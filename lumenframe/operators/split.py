"""Train, validation and test splits; folds."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.functions.ordering import cut, rank_in_group, ranked


def stable_bucket(key: Column, seed: int = 0, portable: bool = True) -> Column:
    """Number in 0..65535 from an integer key: plain arithmetic that any SQL engine repeats, or xxhash64."""
    if not portable:
        return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(65536))
    return F.pmod(F.pmod(key.cast("long"), F.lit(65536)) * 40503 + seed, F.lit(65536))


def split_random(df: DataFrame, key: str, fractions: dict[str, float], seed: int = 0, portable: bool = False) -> DataFrame:
    """Adds the name of the part each row falls in; a narrow step without a shuffle."""
    place = stable_bucket(F.col(key), seed, portable)
    names, edge, out = list(fractions), 0.0, None
    for name in names[:-1]:
        edge += fractions[name]
        test = place < F.lit(round(edge * 65536))
        out = F.when(test, name) if out is None else out.when(test, name)
    return df.withColumn("part", out.otherwise(names[-1]))


def split_ordered(df: DataFrame, order: list[str], n: int | None = None, fraction: float | None = None) -> DataFrame:
    """First n rows, or the first fraction, against the rest; the two parts are disjoint."""
    rows = ranked(df, order, "_rank")
    edge = F.lit(n) if n is not None else F.floor(rows.agg(F.max("_rank")).scalar() * fraction)
    return rows.withColumn("part", F.when(F.col("_rank") <= edge, "first").otherwise("rest")).drop("_rank")


def split_stratified(df: DataFrame, key: str, label: str, fraction: float, seed: int = 0, portable: bool = False) -> DataFrame:
    """The first ceil(fraction * class size) rows of each class in hash order are 'train', the others 'test'."""
    mixed = df.withColumn("_h", stable_bucket(F.col(key), seed, portable))
    rows = cut(rank_in_group(mixed, [label], ["_h", key], "_rank"))
    sizes = rows.groupBy(label).agg(F.max("_rank").alias("_size"))
    sized = salted_join(rows, sizes, label)
    return sized.withColumn("part", F.when(F.col("_rank") <= F.ceil(F.col("_size") * fraction), "train")
                            .otherwise("test")).drop("_h", "_rank", "_size")


def assign_folds(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """Fold 0..k-1, dealt out in key order within each class."""
    return rank_in_group(df, [label], [key], "_rank").withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(k))).drop("_rank")
