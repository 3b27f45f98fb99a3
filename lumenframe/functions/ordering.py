"""Global order, ranks and running totals without a one-task window.

Rows are range-partitioned on the full sort key and sorted inside each partition. The result is checkpointed,
because the sampled range borders may differ from run to run; after that the block number and the position in it
are fixed. A running value is then the value inside the block plus a carry from earlier blocks. The carry table
has fewer rows than there are blocks, so broadcasting it is safe at any data size, and a group that holds a large
share of all rows is spread over many blocks.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a local folder is made only in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    folder = folder or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lumenframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{os.urandom(8).hex()}"


def cut(df: DataFrame, keep_layout: bool = False) -> DataFrame:
    """Reliable checkpoint: cuts lineage and fixes the rows.

    keep_layout lets later joins use the hash partitioning and order of the rows. Spark records them only when the
    plan is fixed beforehand, so adaptive planning is off for this one job.
    """
    spark = df.sparkSession
    shared_folder(spark)
    if not keep_layout:
        return df.checkpoint(eager=True)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # a new DataFrame object, so that a plan made under the other setting is not reused
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def stored(df: DataFrame) -> DataFrame:
    """Written once as parquet below the shared folder: like `cut` for tables of many short rows, in a fraction of the space."""
    spark = df.sparkSession
    path = fresh_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def laid_out(df: DataFrame, *key: str) -> DataFrame:
    """Rows hash-partitioned and sorted by the key once, for many joins on it without another shuffle."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartition(parts, *key).sortWithinPartitions(*key), keep_layout=True)


def sort_key(name: str) -> Column:
    """'-x' sorts descending with nulls last, 'x' ascending with nulls first."""
    return F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_first()


def ordered_blocks(df: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """Add _blk and _pos so that (_blk, _pos) follows the given order."""
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [sort_key(o) for o in order]
    tagged = (df.repartitionByRange(blocks, *keys).sortWithinPartitions(*keys)
              .withColumn("_at", F.monotonically_increasing_id()))
    tagged = cut(tagged)
    return (tagged.withColumn("_blk", F.shiftright("_at", 33))
            .withColumn("_pos", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at"))


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Global row number 1..n. Give an order that ends in a unique key."""
    rows = ordered_blocks(df, order)
    ends = rows.groupBy("_blk").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (rows.join(F.broadcast(starts), "_blk")
            .withColumn(name, F.col("_start") + F.col("_pos") + 1).drop("_blk", "_pos", "_start"))


_MERGE = {
    "sum": lambda carry, local: F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)),
    "max": lambda carry, local: F.greatest(carry, local),
    "min": lambda carry, local: F.least(carry, local),
}
_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}


def running(df: DataFrame, part: list[str], order: list[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """Running sum, max or min in order inside each part: values = {output: (kind, column)}."""
    rows = ordered_blocks(df, [*part, *order])
    inside = (Window.partitionBy("_blk", *part).orderBy("_pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.select("*", *[_FOLD[k](c).over(inside).alias(f"_l_{o}") for o, (k, c) in values.items()])
    totals = rows.groupBy("_blk", *part).agg(*[_FOLD[k](c).alias(f"_t_{o}") for o, (k, c) in values.items()])
    by_part = Window.partitionBy(*(part or [F.lit(0)])).orderBy("_blk")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.select(
                F.col("_blk").alias("_cb"), *[F.col(p).alias(f"_c{i}") for i, p in enumerate(part)],
                F.row_number().over(by_part).alias("_cn"),
                *[_FOLD[k](f"_t_{o}").over(before).alias(f"_c_{o}") for o, (k, _) in values.items()])
             .where("_cn > 1").drop("_cn"))
    match = F.col("_blk") == F.col("_cb")
    for i, p in enumerate(part):
        match = match & F.col(p).eqNullSafe(F.col(f"_c{i}"))
    joined = local.join(F.broadcast(carry), match, "left")
    keep = [c for c in df.columns if c not in values]
    return joined.select(*keep, *[_MERGE[k](F.col(f"_c_{o}"), F.col(f"_l_{o}")).alias(o)
                                  for o, (k, _) in values.items()])


def rank_in_group(df: DataFrame, part: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Row number inside each part; a part may be larger than one task can hold."""
    return running(df.withColumn("_one", F.lit(1).cast("long")), part, order, {name: ("sum", "_one")}).drop("_one")


def value_steps(df: DataFrame, column: str, weights: dict[str, Column] | None = None,
                descending: bool = False) -> DataFrame:
    """Distinct values with weights summed per value and running sums: one row per value.

    Output: column, one total per weight, and cum_<weight> up to and including the value. Equal values are added
    up before the shuffle, so a value shared by many rows costs no more than a rare one.
    """
    weights = weights or {"n": F.lit(1).cast("long")}
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        *[F.sum(w).alias(name) for name, w in weights.items()])
    order = [f"-{column}" if descending else column]
    return running(counts, [], order, {f"cum_{name}": ("sum", name) for name in weights})
