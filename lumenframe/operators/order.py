"""Sorting, top-k, running values and sliding windows."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.ordering import rank_in_group, ranked, running, sort_key


def sort_rows(df: DataFrame, order: list[str], rank: str = "rank") -> DataFrame:
    """Global order as a rank column."""
    return ranked(df, order, rank)


def top_k(df: DataFrame, order: list[str], k: int) -> DataFrame:
    return df.orderBy(*[sort_key(o) for o in order]).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """First k rows per group; the limit is applied in each map task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*[sort_key(o) for o in order]))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def running_sum(df: DataFrame, part: list[str], order: list[str], col: str, out: str = "running_sum") -> DataFrame:
    return running(df, part, order, {out: ("sum", col)})


def running_best(df: DataFrame, part: list[str], order: list[str], col: str, out: str = "running_best") -> DataFrame:
    return running(df, part, order, {out: ("max", col)})


def sliding_groups(df: DataFrame, part: list[str], order: list[str], col: str, n: int) -> DataFrame:
    """Every run of n consecutive rows per part as one list, keyed by the number of its first row.

    Each row is sent to the n windows it belongs to, so a long part is spread over many tasks.
    """
    rows = rank_in_group(df.select(*part, *[o.lstrip("-") for o in order], F.col(col).alias("_v")), part, order, "_rn")
    sent = rows.select(*part, F.explode(F.sequence(F.greatest(F.col("_rn") - (n - 1), F.lit(1)), "_rn")).alias("start"),
                       F.struct("_rn", "_v").alias("_row"))
    lists = sent.groupBy(*part, "start").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    return lists.where(F.size("_rows") == n).select(*part, "start", F.transform("_rows", lambda r: r["_v"]).alias("items"))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Reproducible permutation."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
