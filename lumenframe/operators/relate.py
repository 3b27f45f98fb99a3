"""Unions, joins, set membership and de-duplication."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.joins import hot_from_counts, pair_with_small, salted_join
from lumenframe.functions.ordering import sort_key


def union_aligned(*dfs: DataFrame) -> DataFrame:
    """Tables on top of each other by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def join_by_row_id(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of both tables that share the row id."""
    return a.join(b, key)


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, value: str, default=None,
                hot: list | None = None) -> DataFrame:
    """Value of each key from a lookup table, or the default."""
    if hot is None and "n" in lookup.columns:
        hot = hot_from_counts(lookup, key)      # a vocabulary knows how often each key occurs
    out = salted_join(df, lookup.select(key, value), key, hot=hot)
    return out if default is None else out.withColumn(value, F.coalesce(value, F.lit(default)))


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return salted_join(df, members.select(key).distinct(), key, "left_semi")


def remove_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return salted_join(df, members.select(key).distinct(), key, "left_anti")


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a without those of b, each counted as often as it occurs."""
    return a.exceptAll(b)


def all_pairs(a: DataFrame, b: DataFrame, limit: int = 10_000) -> DataFrame:
    """Every row of a with every row of b. b is the small side: more than `limit` rows is an error."""
    return pair_with_small(a, b, limit)


def dedupe_where(df: DataFrame, condition: Column, keys: list[str], order: list[str]) -> DataFrame:
    """Among rows that meet the condition keep the first per key; all other rows stay."""
    open_rows = df.where(~F.coalesce(condition, F.lit(False)))
    # row_number() = 1 is applied in each map task first, so copies of one key never meet in one task
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*[sort_key(o) for o in order]))
    kept = df.where(condition).withColumn("_rn", first).where("_rn = 1").drop("_rn")
    return open_rows.unionByName(kept)
