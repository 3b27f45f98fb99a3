"""Table-level text operators: base forms, ordered corpora, phrase counts, sentiment by lexicon."""
from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.functions.ordering import rank_in_group, stored
from lumenframe.functions.words import phrase_runs, word_tokens
from lumenframe.operators.order import top_k_per_group
from lumenframe.operators.profile import category_shares
from lumenframe.operators.textvec import looked_up, term_counts


def token_rows(df: DataFrame, key: str, tokens) -> DataFrame:
    """One row per token: key, pos, token."""
    return df.select(key, F.posexplode(tokens).alias("pos", "token"))


def normalize_tokens(tokens: DataFrame, forms: DataFrame, hot: list | None = None) -> DataFrame:
    """Base form of each token from a (token, base) table; unknown tokens stay."""
    out = salted_join(tokens, forms.select("token", "base"), "token", hot=hot)
    return out.withColumn("base", F.coalesce("base", "token"))


def concat_corpus(df: DataFrame, group: str, order: list[str], text: str, rows_per_chunk: int = 1_000,
                  sep: str = " ") -> DataFrame:
    """All texts of a group in order, as numbered chunks of bounded size that together hold the whole text."""
    ranked = rank_in_group(df, [group], order, "_rn")
    chunk = F.floor((F.col("_rn") - 1) / rows_per_chunk)
    lists = ranked.groupBy(group, chunk.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("_rn", text))).alias("_t"))
    return lists.select(group, "chunk", F.array_join(F.transform("_t", lambda t: t[text]), sep).alias("corpus"))


def phrase_counts(df: DataFrame, text: str, stopwords: Iterable[str]) -> DataFrame:
    """Candidate phrases and how often each occurs."""
    return df.select(F.explode(phrase_runs(text, stopwords)).alias("phrase")).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))


def lexicon_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity of the known words of each text and the class it stands for; 0 when no word is known."""
    # words are counted per text before the lookup
    known = looked_up(stored(term_counts(df, key, word_tokens(text))), lexicon, F.col("polarity"), "inner")
    means = known.groupBy(key).agg((F.sum(F.col("tf") * F.col("polarity")) / F.sum("tf")).alias("polarity"))
    scored = df.join(means, key, "left").withColumn("polarity", F.round(F.coalesce("polarity", F.lit(0.0)), 9))
    return scored.withColumn("sentiment", F.when(F.col("polarity") > 0, "positive").when(F.col("polarity") == 0, "neutral")
                             .otherwise("negative"))


def sentiment_report(scored: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Share of each sentiment with its first k texts."""
    shares = category_shares(scored, "sentiment").select("sentiment", "percent")
    return top_k_per_group(scored, ["sentiment"], [key], k).join(shares, "sentiment")


def apply_text(df: DataFrame, col: str, fn: Callable[[str], str], out: str | None = None) -> DataFrame:
    """A user's own per-value function, in Arrow batches. Use the expressions in functions.words where they suffice."""
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(fn, na_action="ignore")
    return df.withColumn(out or col, run(F.col(col)))
