"""Exact de-duplication as a stateful stream.

Every row is reduced to a digest of its normalised text (white space runs become one blank), a stable identifier and
a locator (the number its row got when the entries were written). The entries are read as a stream; keyed state on
disk (RocksDB, no watermark, so nothing expires) keeps per digest the smallest (doc_id, locator) and the number of
rows. Then the full bytes of all hits are checked: the distinct normalised texts behind each digest with two rows or
more are gathered (one text unless digests collide), and a digest that stands for several texts is resolved by the
texts themselves.

The stream commits its progress to the shared folder, each micro-batch writes its own folder again when repeated, and
counts are combined before the shuffle, so a text that a third of all rows carry is one state row.

Defined results: null text counts as empty. A null doc_id sorts after all others. Of repeated rows (same id and text)
exactly one is kept. An empty table gives an empty result. Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenframe.functions.ordering import fresh_path, shared_folder
from lumenframe.llm.common import ASCII_SPACE, landed, same

#: Settings of the state: on disk, with its memory bounded per executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",      # many small stores: no space set aside in advance
}
LAST_ID = (1 << 63) - 1


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), ASCII_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def entries_of(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, digest, uid), written once: the rows that the stream reads."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(normalised(text_col)).alias("digest"))
    return landed(rows.withColumn("uid", F.monotonically_increasing_id()), "dedup-entries")


def stream_groups(spark: SparkSession, entries: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """(digest, keep_id, keep_uid, n) after all entries have passed through the state."""
    source = entries.inputFiles()
    out, progress = fresh_path(spark, "dedup-groups"), fresh_path(spark, "dedup-progress")
    schema = "digest string, keep_id long, keep_uid long, n long"
    if not source:
        return spark.createDataFrame([], schema)
    files_per_batch = files_per_batch or max(16, 4 * spark.sparkContext.defaultParallelism)
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)

    def save(batch: DataFrame, number: int) -> None:
        (batch.select("digest", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.uid").alias("keep_uid"), "n")
         .write.mode("overwrite").parquet(f"{out}/batch={number}"))

    try:
        folder = source[0].rsplit("/", 1)[0]
        state = (spark.readStream.schema(entries.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
                 .groupBy("digest").agg(
                     F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"), "doc_id", "uid")).alias("keeper"),
                     F.count(F.lit(1)).alias("n")))
        (state.writeStream.outputMode("update").option("checkpointLocation", progress)
         .trigger(availableNow=True).foreachBatch(save).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    updates = spark.read.schema(f"{schema}, batch int").parquet(out)
    last = F.max_by(F.struct("keep_id", "keep_uid", "n"), "batch").alias("s")
    return updates.groupBy("digest").agg(last).select("digest", "s.*")


def colliding(docs: DataFrame, groups: DataFrame, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests of two rows or more that stand for different texts: all bytes of all hits are compared."""
    norm = normalised(text_col)
    hits = (docs.select(norm.alias("norm")).withColumn("digest", digest(F.col("norm")))
            .join(groups.where("n > 1").select("digest"), "digest"))
    spread = hits.repartition("digest", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    return spread.groupBy("digest").agg(F.collect_set("norm").alias("texts")).where(F.size("texts") > 1).select("digest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    spark = docs.sparkSession
    shared_folder(spark)
    entries = entries_of(docs, id_col, text_col, digest)
    groups = stream_groups(spark, entries, files_per_batch)
    groups = landed(groups, "dedup-state")
    clash = landed(colliding(docs, groups, text_col, digest), "dedup-clashes")
    found = (entries.join(groups, "digest")
             .select("doc_id", "digest", "keep_id", F.col("n").alias("group_size"), (F.col("uid") == F.col("keep_uid")).alias("kept")))
    if clash.isEmpty():
        return found
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("norm"))
            .withColumn("digest", digest(F.col("norm"))).join(clash, "digest"))
    order = Window.partitionBy("norm").orderBy(F.col("doc_id").asc_nulls_last())
    by_text = rows.select(
        "doc_id", "digest", F.first("doc_id").over(order).alias("keep_id"),
        F.count(F.lit(1)).over(Window.partitionBy("norm")).alias("group_size"), (F.row_number().over(order) == 1).alias("kept"))
    return found.join(clash, "digest", "left_anti").unionByName(by_text)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    rows = docs.withColumn("_own", sha256(normalised(text_col)))
    match = same(F.col(id_col), F.col("_id")) & (F.col("_own") == F.col("_digest"))
    return (rows.join(kept, match).dropDuplicates([id_col, "_own"]).select(*docs.columns))
