"""A corpus pipeline of five stages, each one operator of the subpackage llm on all that the stage before it kept.

language ID -> exact de-duplication -> SimHash near-duplicates -> mixing to target weights -> BPE encoding.
Every stage but the last returns the columns of `documents`; each result is written as Parquet and read again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import bpe, exact, langid, mixing, simhash
from lumenframe.llm.common import is_held_out, landed
from lumenframe.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this share of the median score of a language's training documents a text is not in that language.
LEAST_SHARE = 0.6


def least_scores(trained: DataFrame) -> DataFrame:
    """(lang_pred, least): LEAST_SHARE of the median score per language over all training documents, exact to three digits."""
    counts = trained.where(F.col("lang").isNotNull() & (F.col("lang_pred") != langid.UNDECIDED)).groupBy(
        "lang", F.round("score", 3).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.col("lang").alias("lang_pred")).agg((F.percentile("score", F.lit(0.5), F.col("n")) * LEAST_SHARE).alias("least"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns as op4 does and rejects texts without letters, or far less like the nearest profile than its training documents."""
    rows = docs.select(*COLUMNS)
    training = rows.where(~is_held_out())
    profiles = landed(langid.train_profiles(training), "profiles")
    least = landed(least_scores(langid.predict(training.select("text", "lang"), profiles)), "least-scores")
    found = langid.predict(rows, profiles).join(F.broadcast(least), "lang_pred")       # languages, bounded by the model
    return found.where(F.col("score") >= F.col("least")).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the one with the smallest doc_id stays."""
    return exact.keep_first(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of SimHash links the document with the smallest doc_id stays."""
    return simhash.keep_one(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or thinned to weights in proportion to size ** 0.7, in a global shuffle."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with digests of the ids and of the text decoded from them."""
    return bpe.encode_documents(docs.select(*COLUMNS), tokenizer_path(), keep=("doc_id", "source"),
                                want=("token_ids", "n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [("language_id", language), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
          ("mix_sources", mixing_stage), ("bpe", encoding)]

#: Language profiles, SimHash components and byte-pair encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
