"""Issue extraction: sentences go to device, patient or other; phrases around the keywords are kept.

Everything up to the phrase corpus is one narrow projection of array expressions per text. The text is lower-cased
first, so that finding a keyword and splitting at it agree.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.functions.ordering import cut
from lumenframe.functions.words import (ISSUE_STOPWORDS, ISSUE_SYMBOLS, issue_tokens, numeric_tokens,
                                        split_sentences, tokenize_issue)

CLASSES = ("device", "patient", "other")
# The keywords that route a sentence. In each chain the first keyword found takes the sentence.
TWO_CHAINS = {"device": "device", "reported": "reported", "customer": "customer", "patient": "patient"}
ONE_CHAIN = {"device": "device", "patient": "patient"}


def sentences(col) -> Column:
    """Lower-cased sentences of a text column name; a Column is taken as a list of sentences already."""
    return split_sentences(F.lower(F.col(col))) if isinstance(col, str) else col


def route_sentences(col, keywords: dict[str, str] = TWO_CHAINS) -> dict[str, Column]:
    """Sentence lists by route. The device and the customer chain are independent; what the second leaves is 'other'."""
    sents = sentences(col)
    has = lambda t, k: t.contains(keywords[k])
    pick = lambda test: F.filter(sents, test)
    return {
        "device": pick(lambda t: has(t, "device")),
        "reported": pick(lambda t: ~has(t, "device") & has(t, "reported")),
        "customer": pick(lambda t: has(t, "customer")),
        "patient": pick(lambda t: ~has(t, "customer") & has(t, "patient")),
        "other": pick(lambda t: ~has(t, "customer") & ~has(t, "patient")),
    }


def route_exclusive(col, keywords: dict[str, str] = ONE_CHAIN) -> dict[str, Column]:
    """Each sentence to the first of device, patient, other."""
    sents = sentences(col)
    device, patient = keywords["device"], keywords["patient"]
    return {
        "device": F.filter(sents, lambda t: t.contains(device)),
        "patient": F.filter(sents, lambda t: ~t.contains(device) & t.contains(patient)),
        "other": F.filter(sents, lambda t: ~t.contains(device) & ~t.contains(patient)),
    }


def phrases(parts: Column, trim=F.trim) -> Column:
    """Comma-separated pieces of every text in a list."""
    return F.flatten(F.transform(parts, lambda p: F.transform(F.split(p, ","), lambda x: trim(x))))


def keyword_context(sents: Column, keyword: str, sides: str = "both", trim=F.trim) -> Column:
    """Phrases between the first and second keyword of each sentence, then those before the first."""
    piece = lambda i: F.transform(sents, lambda t: F.split_part(t, F.lit(keyword), F.lit(i)))
    after = phrases(piece(2), trim)
    return after if sides == "after" else F.concat(after, phrases(piece(1), trim))


def class_phrases(col, keywords: dict[str, str] = TWO_CHAINS) -> dict[str, Column]:
    routes = route_sentences(col, keywords)
    around = lambda name: keyword_context(routes[name], keywords[name])
    return {"device": F.concat(around("device"), around("reported")),
            "patient": F.concat(around("patient"), around("customer")),
            "other": phrases(routes["other"])}


def class_phrases_after(col, keywords: dict[str, str] = ONE_CHAIN) -> dict[str, Column]:
    routes = route_exclusive(col, keywords)
    return {"device": keyword_context(routes["device"], keywords["device"], "after", F.ltrim),
            "patient": keyword_context(routes["patient"], keywords["patient"], "after", F.ltrim),
            "other": phrases(routes["other"], F.ltrim)}


def extract_issues(df: DataFrame, text: str, keywords: dict[str, str] = TWO_CHAINS, sep: str = ",",
                   stopwords: Iterable[str] = ISSUE_STOPWORDS, symbols: Iterable[str] = ISSUE_SYMBOLS) -> DataFrame:
    """Six text columns: phrases and scores (tokens with a digit) for device, patient and other."""
    out = df.withColumn("_sents", sentences(text))
    for name, found in class_phrases(F.col("_sents"), keywords).items():
        tokens = F.transform(found, lambda p: issue_tokens(p, stopwords, symbols))
        out = out.withColumn(f"_{name}", F.filter(tokens, lambda t: F.size(t) > 0))
    joined = lambda n: F.array_join(F.transform(f"_{n}", lambda t: F.array_join(t, " ")), sep)
    scores = lambda n: F.array_join(numeric_tokens(F.flatten(f"_{n}")), sep)
    return (out.withColumns({c: v for n in CLASSES for c, v in ((n, joined(n)), (f"{n}_score", scores(n)))})
            .drop("_sents", *[f"_{n}" for n in CLASSES]))


def extract_issues_first(df: DataFrame, text: str, keywords: dict[str, str] = ONE_CHAIN,
                         stopwords: Iterable[str] = (*ISSUE_STOPWORDS, "wa", "reported"),
                         symbols: Iterable[str] = ISSUE_SYMBOLS) -> DataFrame:
    """Array columns; only the first class that has phrases is filled."""
    found = class_phrases_after(F.col("_sents"), keywords)
    out = df.withColumn("_sents", sentences(text)).withColumns({f"_{n}": F.transform(found[n], lambda p: issue_tokens(p, stopwords, symbols)) for n in CLASSES})
    free = F.lit(True)
    cols = {}
    for n in CLASSES:
        here = free & (F.size(f"_{n}") > 0)
        none = F.array().cast("array<string>")
        words = F.transform(f"_{n}", lambda t: F.array_join(t, " "))
        digits = F.filter(F.transform(f"_{n}", lambda t: F.array_join(numeric_tokens(t), " ")), lambda x: x != "")
        cols[n] = F.when(here, words).otherwise(none)
        cols[f"{n}_score"] = F.when(here, digits).otherwise(none)
        free = free & (F.size(f"_{n}") == 0)
    return out.withColumns(cols).drop("_sents", *[f"_{n}" for n in CLASSES])


def _phrase_rows(df: DataFrame, key: str, text: str, keywords, stopwords, symbols) -> DataFrame:
    """(key, class, counts, pos, phrase): counts tells whether the text's first phrase of the class is not empty."""
    found = class_phrases_after(F.col("_sents"), keywords)
    packs = F.array(*[F.struct(F.lit(n).alias("class"), found[n].alias("raw")) for n in CLASSES])
    rows = df.select(key, sentences(text).alias("_sents")).select(key, F.inline(packs)).where(F.size("raw") > 0)
    return rows.select(key, "class", (F.col("raw")[0] != "").alias("counts"), F.posexplode("raw").alias("pos", "_p")).select(
        key, "class", "counts", "pos", tokenize_issue("_p", stopwords, symbols).alias("phrase"))


def _corpus(rows: DataFrame) -> DataFrame:
    counted = rows.where("counts")
    # a class takes part only when it has at least three phrases; there are three classes, so this table is tiny
    big = F.broadcast(counted.groupBy("class").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 3").select("class"))
    return (counted.where(F.size(F.split("phrase", " ")).isin(2, 3)).select("class", "phrase").distinct()
            .join(big, "class", "left_semi"))


def phrase_corpus(df: DataFrame, key: str, text: str, keywords: dict[str, str] = ONE_CHAIN,
                  stopwords: Iterable[str] = ISSUE_STOPWORDS, symbols: Iterable[str] = ISSUE_SYMBOLS) -> DataFrame:
    """Distinct phrases of two or three words per class over all texts."""
    return _corpus(_phrase_rows(df, key, text, keywords, stopwords, symbols))


def extract_issues_phrases(df: DataFrame, key: str, text: str, corpus: DataFrame | None = None,
                           keywords: dict[str, str] = ONE_CHAIN, stopwords: Iterable[str] = ISSUE_STOPWORDS,
                           symbols: Iterable[str] = ISSUE_SYMBOLS) -> DataFrame:
    """Per text and class the phrases that the corpus holds, in order."""
    rows = cut(_phrase_rows(df, key, text, keywords, stopwords, symbols))      # read for the corpus and for the lookup
    corpus = _corpus(rows) if corpus is None else corpus
    joint = F.concat_ws("\t", "class", "phrase").alias("_k")
    kept = salted_join(rows.where(F.size(F.split("phrase", " ")).isin(2, 3)).select("*", joint),
                       corpus.select(joint), "_k", "left_semi")
    lists = kept.groupBy(key).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("class") == n, F.struct("pos", "phrase")))),
                    lambda s: s["phrase"]).alias(n) for n in CLASSES])
    empty = F.array().cast("array<string>")
    return df.select(key).join(lists, key, "left").select(key, *[F.coalesce(n, empty).alias(n) for n in CLASSES])
