"""Mixing sources to target weights by Poisson replication, with DataFrame operations only.

Every source gets a mean repetition rate: its target share of the wanted amount of text over the amount it has. Every
document draws its number of copies from a Poisson distribution with that mean by inverting the distribution function
at a uniform number taken from a hash of seed and doc_id. Copies are exploded and sorted globally by a hash of (seed,
doc_id, copy), which is a uniform shuffle and the same on every run.

The distribution table is one row per source (not per document) and joins by source: sent to every task when it was
counted to hold few sources, which leaves the documents where they are, else by a join that adaptive execution splits
for a hot source. Amounts are summed before the shuffle.

Defined results: a null source is a source of its own; null text has length 0; a source whose texts are all empty has
rate 0 for an amount of 0 and its documents go. Documents with the same doc_id draw the same number. A null doc_id
hashes as the empty string. An empty table gives an empty result. Extra columns pass through.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import landed, same

SEED = 7
ALPHA = 0.7
BROADCAST_SOURCES = 10_000
DIGITS = 13                       # hexadecimal digits of a hash that make a number below 2^52


def hashed(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def poisson_table(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... up to where the rest is below double precision; summed from logarithms."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cdf"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: Mapping[str | None, float] | None = None,
                 alpha: float = ALPHA, amount: float = 1.0) -> DataFrame:
    """(source, size, rate). Without `weights`, the target share of a source is proportional to its size ** alpha.

    `amount` is the wanted total as a multiple of what there is. Sources that `weights` does not name get share 0.
    """
    size = F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("size")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(size)
    if weights is None:
        aim = F.pow(F.col("size").cast("double"), F.lit(alpha))
    else:
        aim = F.lit(0.0)
        for name, w in weights.items():
            aim = F.when(same(F.col("source"), F.lit(name).cast("string")), F.lit(float(w))).otherwise(aim)
    sizes = sizes.withColumn("aim", aim)
    total = sizes.agg(F.sum("size").alias("all"), F.sum("aim").alias("aims"))
    rate = F.when((F.col("size") > 0) & (F.col("aims") > 0), F.lit(amount) * F.col("aim") / F.col("aims") * F.col("all") / F.col("size")).otherwise(0.0)
    return sizes.join(F.broadcast(total), F.lit(True)).select("source", "size", rate.alias("rate"))     # total is one row


def replicate(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """All columns of docs with rate, copy (from 1) and order_key, one row per copy."""
    rates = landed(rates, "mixing-rates")
    table = rates.select(F.col("source").alias("_source"), F.col("rate"), poisson_table(F.col("rate")).alias("_cdf"))
    table = F.broadcast(table) if rates.count() <= BROADCAST_SOURCES else table       # sources counted; beyond it an ordinary join
    rows = docs.drop("rate", "copy", "order_key").join(table, same(F.col(source_col), F.col("_source")))
    draw = hashed(F.lit(seed), F.col(id_col)) / F.lit(float(1 << 4 * DIGITS))
    copies = F.size(F.filter("_cdf", lambda p: p <= draw))
    wide = rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))).drop("_source", "_cdf")
    return wide.withColumn("order_key", hashed(F.lit(seed), F.col(id_col), F.col("copy")))


def shuffled(rows: DataFrame, key: str = "order_key") -> DataFrame:
    """Globally sorted by the random key: partitions hold ascending ranges of it."""
    return rows.repartitionByRange(F.col(key)).sortWithinPartitions(key)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: Mapping[str | None, float] | None = None, alpha: float = ALPHA, amount: float = 1.0, seed: int = SEED) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    rates = source_rates(docs, source_col, text_col, weights, alpha, amount)
    return shuffled(replicate(docs, rates, id_col, source_col, seed))
