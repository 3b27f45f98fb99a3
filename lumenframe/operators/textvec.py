"""Vocabularies, bags of words, tf-idf, encoded and padded sequences, word vectors."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.joins import counted_join, hot_from_counts, salted_join
from lumenframe.functions.ordering import cut, ranked, stored
from lumenframe.functions.words import WORD2, word_tokens
from lumenframe.operators.clean import encode_first_seen, encode_sorted
from lumenframe.operators.order import top_k_per_group


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """How often each token occurs; counted in each map task before the shuffle."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(counts: DataFrame, min_freq: int = 1, specials: tuple[str, ...] = ()) -> DataFrame:
    """Ids by falling frequency, then by token. Specials come first; without specials ids start at 1."""
    kept = counts.where(F.col("n") >= min_freq)
    offset = len(specials) - 1 if specials else 0
    vocab = ranked(kept, ["-n", "token"], "id").select("token", "n", (F.col("id") + offset).alias("id"))
    if not specials:
        return vocab
    head = counts.sparkSession.createDataFrame([(t, None, i) for i, t in enumerate(specials)], "token string, n long, id long")
    return head.unionByName(vocab)


ROWS_AT_ONCE = 1_000          # rows whose tokens are sorted together


def _counted(key: str, first: bool):
    """Per row: each of its tokens once, how often it occurs and, if asked, its first place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                lists = batch.column("_t")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                words = lists.flatten().dictionary_encode()
                row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
                pair = (row << 32) | words.indices.to_numpy().astype(np.int64)
                if first:
                    pair, at, tf = np.unique(pair, return_index=True, return_counts=True)
                    pos = [pa.array((at - (np.cumsum(sizes) - sizes)[pair >> 32]).astype(np.int32))]
                else:
                    pair, tf = np.unique(pair, return_counts=True)
                    pos = []
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(pair >> 32)), words.dictionary.take(pa.array(pair & 0xFFFFFFFF)),
                                                  pa.array(tf.astype(np.int64)), *pos], names=[key, "token", "tf", "pos"][:3 + first])
    return run


def term_counts(df: DataFrame, key: str, tokens: Column, first: bool = False) -> DataFrame:
    """(key, token, tf), with `first` also pos, the first place of the token in a text.

    Tokens are counted inside each row. Only when a key repeats are the counts of its rows added up in an exchange.
    """
    repeats = not df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()
    kind = dict(df.dtypes)[key]
    counts = df.select(key, tokens.alias("_t")).mapInArrow(_counted(key, first), f"`{key}` {kind}, token string, tf long" + (", pos int" if first else ""))
    if not repeats:
        return counts
    return counts.groupBy(key, "token").agg(F.sum("tf").alias("tf"), *([F.min("pos").alias("pos")] if first else []))


def bag_of_words(df: DataFrame, key: str, text: str) -> DataFrame:
    """Counts per text and term; words of two or more characters, term ids in alphabetical order."""
    counts = stored(term_counts(df, key, word_tokens(text, WORD2)))  # read three times below
    return encode_sorted(counts, "token").select(key, "token", F.col("code").alias("term_id"), "tf")


def term_document_matrix(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(term_id, key, tf) with term ids by first appearance in key and position order."""
    counts = stored(term_counts(df, key, tokens, first=True).select(key, "token", "tf", F.struct(key, "pos").alias("_at")))
    return encode_first_seen(counts, "token", "_at").select(F.col("code").alias("term_id"), "token", key, "tf")


def tfidf(df: DataFrame, key: str, tokens: Column, use_idf: bool = True, norm: bool = True, smooth: bool = True,
          n_docs: int | None = None) -> DataFrame:
    """Weights tf * (ln((1 + n) / (1 + df)) + 1), scaled to unit length per text.

    The (key, token) counts are written once, so texts are tokenized once; frequent terms meet their idf in place, and the
    length of a text is summed over its own terms only.
    """
    counts = stored(term_counts(df, key, tokens))
    if use_idf:
        n = df.count() if n_docs is None else n_docs
        add = 1 if smooth else 0
        idf = F.ln((F.lit(n) + add) / (F.col("df") + add)) + 1
        terms = stored(counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")))
        weighted = counted_join(counts, terms.select("token", "df", idf.alias("idf")), "token", "inner", n="df").select(key, "token", "tf", (F.col("tf") * F.col("idf")).alias("weight"))
    else:
        weighted = counts.withColumn("weight", F.col("tf").cast("double"))
    if not norm:
        return weighted
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return weighted.where(F.col(key).isNotNull()).select(key, "token", "tf", (F.col("weight") / length).alias("weight"))


def top_terms(weights: DataFrame, key: str, k: int) -> DataFrame:
    """Heaviest terms per text."""
    return top_k_per_group(weights.withColumn("_w", F.round("weight", 9)), [key], ["-_w", "token"], k).drop("_w")


def looked_up(rows: DataFrame, table: DataFrame, value: Column, how: str = "left") -> DataFrame:
    """Rows with a value of their token; a table that knows how often its tokens occur spares frequent ones the shuffle."""
    if "n" in table.columns:
        return counted_join(rows, table.select("token", F.col("n").alias("_n"), value), "token", how, n="_n")
    return salted_join(rows, table.select("token", value), "token", how)


def encode_sequences(df: DataFrame, key: str, tokens: Column, vocab: DataFrame, unknown: int = 1) -> DataFrame:
    """Token ids of each text in order, with the length."""
    rows = df.select(key, F.posexplode(tokens).alias("pos", "token"))
    hot = hot_from_counts(vocab, "token") if "n" in vocab.columns else None
    coded = salted_join(rows, vocab.select("token", F.col("id").alias("_id")), "token", hot=hot).select(
        key, F.struct("pos", F.coalesce("_id", F.lit(unknown)).alias("id")).alias("_e"))
    lists = coded.groupBy(key).agg(F.array_sort(F.collect_list("_e")).alias("_l"))
    ids = F.coalesce(F.transform("_l", lambda e: e["id"]), F.array().cast("array<bigint>"))
    return df.select(key).join(lists, key, "left").select(key, ids.alias("ids")).withColumn("length", F.size("ids"))


def pad_batches(seqs: DataFrame, order: list[str], ids: str, batch: int, pad: float = 0) -> DataFrame:
    """Batch number by order and every list filled up to the longest one of its batch."""
    rows = ranked(seqs, order, "_rank").withColumn("batch", F.floor((F.col("_rank") - 1) / batch)).drop("_rank")
    longest = rows.groupBy("batch").agg(F.max(F.size(ids)).alias("_max"))
    kind = dict(seqs.dtypes)[ids].removeprefix("array<").removesuffix(">")
    fill = F.array_repeat(F.lit(pad).cast(kind), F.col("_max") - F.size(ids))
    return rows.join(longest, "batch").withColumn("length", F.size(ids)).withColumn(ids, F.concat(ids, fill)).drop("_max")


def word2vec(df: DataFrame, tokens: Column, size: int = 100, window: int = 5, min_count: int = 5, seed: int = 1,
             partitions: int = 1, iterations: int = 1):
    """Skip-gram vectors; use .getVectors() and .findSynonyms(). At least `partitions` tasks train side by side.

    Fitted by operators.skipgram: the vocabulary and the vectors stay on the executors, so neither is bounded by the driver.
    """
    from lumenframe.operators.skipgram import WordVectors, skipgram
    return WordVectors(cut(skipgram(df, tokens, size, window, min_count, passes=iterations, seed=seed, least=partitions)))


def embed_tokens(df: DataFrame, key: str, tokens: Column, vectors: DataFrame) -> DataFrame:
    """Mean of the given (token, vector[, n]) over the known tokens of each text: (key, dim, value).

    Tokens are counted per text first, so each vector is read once per text and term.
    """
    known = looked_up(stored(term_counts(df, key, tokens)), vectors, F.col("vector"), "inner")
    parts = known.select(key, "tf", F.posexplode("vector").alias("dim", "v"))
    return parts.groupBy(key, "dim").agg((F.sum(F.col("tf") * F.col("v")) / F.sum("tf")).alias("value"))
