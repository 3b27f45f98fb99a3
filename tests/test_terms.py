"""Packed rows of terms and the models on them against numpy and brute force."""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.operators import models, svd, terms
from lumenframe.plans import registry

TEXTS = ["red apple red", "green apple pear", "blue sea sea sea", "", None, "blue sky over the sea", "apple pear plum", "the sky", "green pear", "sea sky", "red plum", "lone word"]


@pytest.fixture()
def few_tokens(monkeypatch):
    monkeypatch.setattr(terms, "TOKENS", 6)
    monkeypatch.setattr(models, "MAX_TERMS", 3, raising=False)          # the former limit


def dense(rows):
    """(rows x words, words, kept) of packed rows."""
    word = {r["id"]: r["word"] for r in rows.vocabulary.collect()}
    names = sorted(word.values())
    out = {}
    for b in rows.blocks.collect():
        starts, places, numbers = np.frombuffer(b["starts"], "<i8"), np.frombuffer(b["places"], "<i4"), np.frombuffer(b["numbers"], "<f8")
        ids = np.concatenate([np.frombuffer(b["columns"], "<i8"), np.frombuffer(b["own"], "<i8")])
        for i, k in enumerate(b["kept"]):
            line = np.zeros(len(names))
            for p, v in zip(places[starts[i]:starts[i + 1]], numbers[starts[i]:starts[i + 1]], strict=True):
                line[names.index(word[ids[p]])] = v
            out[k["id"]] = line
    return np.array([out[i] for i in sorted(out)]), names


def table_of(spark, parts=3):
    return spark.createDataFrame([(i, t, i % 2, "ab"[i % 2]) for i, t in enumerate(TEXTS)], "id long, text string, label int, source string").repartition(parts)


def brute(texts):
    counts = [Counter(re.findall(r"\w{2,}", t or "")) for t in texts]
    names, df = sorted(set().union(*counts)), Counter(w for c in counts for w in c)
    x = np.array([[c[w] * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w in names] for c in counts])
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1), names


def test_tfidf_rows_equal_brute_force(spark, few_tokens):
    rows = models.tfidf_vectors(table_of(spark), W.word_tokens("text", W.WORD2), keep=["id", "label", "source"])
    (x, names), (want, all_names) = dense(rows), brute(TEXTS)
    assert rows.n == len(TEXTS) and names == all_names and np.allclose(x, want)
    own = sum(len(b["own"]) for b in rows.blocks.collect())
    assert own > 0 and rows.blocks.count() > 3                    # words of one block, and words that blocks share


def test_svd_of_terms_and_held_out_rows(spark, few_tokens):
    df = table_of(spark).withColumn("held", F.col("id") >= 8)
    rows = models.tfidf_vectors(df, W.word_tokens("text", W.WORD2), keep=["id", "held"])
    x, _ = dense(rows)
    model = svd.svd_of_blocks(rows.part("held", False).blocks, 3, tol=1e-6)
    _, values, right = np.linalg.svd(x[:8], full_matrices=False)
    assert np.allclose(model.values, values[:3], rtol=1e-4)
    got = {r.id: r.reduced for r in model.transform_blocks(rows.part("held", True).blocks, ["id"]).collect()}
    assert sorted(got) == list(range(8, 12))
    assert np.allclose(np.abs([got[i] for i in sorted(got)]), np.abs(x[8:] @ right[:3].T), atol=1e-3)


def test_group_means_and_clusters(spark, few_tokens):
    rows = models.tfidf_vectors(table_of(spark), W.word_tokens("text", W.WORD2), keep=["id", "source"])
    x, names = dense(rows)
    got = {(r.cluster, r.term): r.weight for r in models.group_top_terms(rows, "source", 3).collect()}
    for j in range(2):
        mean = x[j::2].mean(axis=0)
        best = sorted(zip(-mean, names, strict=True))[:3]
        assert all(math.isclose(got.pop((j, w)), -v, rel_tol=1e-9) for v, w in best)
    assert not got
    found = models.kmeans(rows, 3, 50)
    assert all(b <= a + 1e-9 for a, b in zip(found.costs, found.costs[1:], strict=False))
    y = {}
    for b in found.shares.join(rows.blocks.select("block", "kept"), "block").collect():
        y |= dict(zip([k["id"] for k in b["kept"]], np.frombuffer(b["y"], "<f8").reshape(-1, found.k), strict=True))
    share = np.array([y[i] for i in sorted(y)])
    centres = share.T @ x
    nearest = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert np.allclose(share.sum(axis=0), 1.0) and (share.argmax(axis=1) == nearest.argmin(axis=1)).all()


@pytest.mark.parametrize("inside", [False, True])
def test_grid_equals_fits_one_by_one(spark, monkeypatch, inside):
    monkeypatch.setattr(terms, "TOKENS", 60)
    rng = np.random.default_rng(5)
    lines = [" ".join(rng.choice([f"w{j}" for j in range(12)], 6, p=np.roll(np.arange(1, 13), 5 * (i % 2)) / 78)) for i in range(60)]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(lines)], "id long, text string, label int").repartition(3)
    tokens = W.word_tokens("text", W.WORD2)
    grid = [{"reg_param": 0.01} | ({"use_idf": u} if inside else {}) for u in ((True, False) if inside else (True,))]
    rows = terms.term_rows(df, tokens, ["id", "label"]) if inside else models.tfidf_vectors(df, tokens, keep=["id", "label"])
    got = models.text_grid_search(rows, "id", "label", grid, folds=3, max_iter=40)
    y, fold = np.arange(60) % 2, np.arange(60) // 2 % 3
    for point, accuracy in zip(grid, got, strict=True):
        hits = []
        for f in range(3):
            train = fold != f
            counts = np.array([[line.split().count(f"w{j}") for j in range(12)] for line in lines], float)
            known = counts if inside else counts[:]
            base = known[train] if inside else known
            idf = np.log((1 + len(base)) / (1 + (base > 0).sum(axis=0))) + 1 if point.get("use_idf", True) else np.ones(12)
            x = known * idf
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            z, w = np.c_[x, np.ones(60)], np.zeros(13)
            for _ in range(50):
                p = 1 / (1 + np.exp(-z[train] @ w))
                ridge = 0.01 * np.r_[np.ones(12), 0.0]
                w -= np.linalg.solve((z[train] * (p * (1 - p))[:, None]).T @ z[train] / train.sum() + np.diag(ridge), z[train].T @ (p - y[train]) / train.sum() + ridge * w)
            hits.append(((z[~train] @ w > 0) == y[~train]).mean())
        assert math.isclose(accuracy, np.mean(hits), abs_tol=1e-9)


def test_queries_have_no_limit_of_terms(spark, few_tokens, tmp_path):
    """A vocabulary above models.MAX_TERMS was an error."""
    table_of(spark).withColumnRenamed("id", "doc_id").where("text is not null").drop("label").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    book = registry()
    for name in ("truncated_svd", "truncated_svd_held_out", "truncated_svd_pairs", "cluster_top_terms", "cluster_top_weights", "logistic_regression_total"):
        assert book[name].run(spark, str(tmp_path)).count() > 0
