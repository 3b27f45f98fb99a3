"""Joins that stay balanced when one key holds a large share of the rows.

Small tables are never forced to broadcast by hint: adaptive execution broadcasts a side only after it has measured
it. What is added here is salting for hot keys, and pairing with a side whose row count is checked first.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 1_000
SALTS = 64
FREQUENT = 50_000             # keys whose rows are matched in place


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = HOT_KEYS) -> list:
    """Keys with more than hot_rows rows, the heaviest first; at most `most` of them, so the list is bounded.

    Keys beyond the list hold less than one `most`-th of all rows each and need no salt.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [r[0] for r in counts.where(F.col("_n") > hot_rows).orderBy(F.desc("_n")).limit(most).collect()]


def hot_from_counts(counts: DataFrame, key: str, n: str = "n", hot_rows: int = HOT_ROWS, most: int = HOT_KEYS) -> list:
    """The same list from a table that already holds the number of rows per key."""
    return [r[0] for r in counts.where(F.col(n) > hot_rows).orderBy(F.desc(n)).limit(most).select(key).collect()]


def spread(df: DataFrame) -> DataFrame:
    """More partitions for a scan that comes in fewer pieces than there are cores (few or unsplittable files).

    A scan that already feeds every core is left as it is, so large inputs are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", hot: list | None = None,
                salts: int = SALTS) -> DataFrame:
    """Equality join on one column; rows of hot keys are spread over `salts` tasks.

    The salt is a hash of the row and its partition, so equal rows spread too and a repeated task sends them to the
    same place. Rows with a null key match nothing; in a salted join they are spread like those of a hot key.
    """
    hot = hot_keys(big, key) if hot is None else hot
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    row = [F.col(c) for c, t in big.dtypes if "map<" not in t and "variant" not in t]
    lot = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), lot).otherwise(F.lit(0)))
    right = small.withColumn("_salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def counted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", n: str = "n", most: int = FREQUENT) -> DataFrame:
    """Equality join (left or inner) with a table that has one row per key and the number `n` of rows the key has in `big`.

    The keys with most rows, `most` at the utmost, are sent to every task, so their rows stay where they are; only rows of
    the many rare keys are shuffled, and none of these has more than a `most`-th of all rows. `big` is read twice, `n` left out.
    """
    steps = small.where(F.col(n).isNotNull()).groupBy(n).agg(F.count(F.lit(1)).alias("_k"))
    listed = steps.orderBy(F.desc(n)).limit(most).collect()         # a key each at least
    held, least = 0, None
    for r in listed:
        if held + r["_k"] > most:
            break
        held, least = held + r["_k"], r[n]
    if least is None:
        return salted_join(big, small.drop(n), key, how)
    head = small.where(F.col(n) >= least).drop(n)
    if held == sum(r["_k"] for r in listed) and len(listed) < most:
        rest = small.where(F.col(n).isNull())
        return big.join(F.broadcast(head), key, how) if rest.isEmpty() else _two(big, head, rest.drop(n), key, how)
    return _two(big, head, small.where((F.col(n) < least) | F.col(n).isNull()).drop(n), key, how)


def _two(big: DataFrame, head: DataFrame, rest: DataFrame, key: str, how: str) -> DataFrame:
    near = big.join(F.broadcast(head), key, "inner")
    far = big.join(F.broadcast(head.select(key)), key, "left_anti").join(rest, key, how)
    return near.unionByName(far)


def checked_rows(small: DataFrame, limit: int) -> Column:
    """All rows of a small table as one array value; fails when there are more than `limit` rows."""
    packed = F.collect_list(F.struct(*small.columns))
    checked = F.when(F.count(F.lit(1)) <= limit, packed).otherwise(
        F.raise_error(F.lit(f"more than {limit} rows on the side that is sent to every task")))
    return small.limit(limit + 1).agg(checked.alias("rows")).scalar()


def pair_with_small(big: DataFrame, small: DataFrame, limit: int = 10_000) -> DataFrame:
    """Every row of `big` with every row of `small`, whose row count must not exceed `limit`."""
    return big.withColumn("_pair", F.explode(checked_rows(small, limit))).select(*big.columns, "_pair.*")
