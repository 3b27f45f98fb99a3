"""Word vectors on texts with planted synonyms."""
from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import graph, skipgram

GROUPS = 12


def planted(spark, n=1500):
    """Every text is about one subject; twins a7 and b7 stand for each other among the words of subject 7."""
    rng = random.Random(0)
    texts = []
    for _ in range(n):
        g = rng.randrange(GROUPS)
        words = [f"t{g}x{rng.randrange(6)}" for _ in range(8)] + [rng.choice(["the", "of", "and"]) for _ in range(2)]
        rng.shuffle(words)
        words[4] = rng.choice("ab") + str(g)
        texts.append((words,))
    return spark.createDataFrame([*texts, (None,), ([],), (["alone"],), ([None, "rare"],)], "words array<string>").repartition(4)


@pytest.mark.parametrize("blocks", [1, 3])
def test_planted_synonyms_are_near(spark, blocks):
    df = planted(spark)
    got = skipgram.skipgram(df, F.col("words"), size=24, window=4, min_count=5, passes=5, blocks=blocks).cache()
    counts = {r.token: r.n for r in df.select(F.explode("words").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.token: r.n for r in got.collect()} == {t: n for t, n in counts.items() if t is not None and n >= 5}
    assert all(len(r.vector) == 24 and np.isfinite(r.vector).all() for r in got.collect())
    asked = spark.createDataFrame([(f"a{g}",) for g in range(GROUPS)] + [("unknown",)], "word string")
    rows = skipgram.similar_words(got, asked, 8).collect()
    assert len(rows) == 8 * GROUPS
    own = sum(r.token.startswith(("t" + r.word[1:] + "x", "b" + r.word[1:])) for r in rows)
    assert own >= 0.75 * 7 * GROUPS                                        # seven words belong to each subject besides a


def test_a_batch_moves_vectors_towards_neighbours_and_away_from_samples():
    rng = np.random.default_rng(0)
    w, c = rng.standard_normal((3, 8)).astype(np.float32), rng.standard_normal((4, 8)).astype(np.float32)
    word, before = w[0].copy(), c.copy()
    skipgram.train(np.zeros(4, int), np.ones(4, int), w, c, np.array([0.0, 0.0, 1.0, 0.0]), 2, 0.05, rng)
    assert word @ c[1] > word @ before[1] and word @ c[2] < word @ before[2]
    same = w[1:].copy(), c[[0, 3]].copy()
    skipgram.train(np.zeros(4, int), np.ones(4, int), w, c, np.array([0.0, 0.0, 1.0, 0.0]), 2, 0.05, rng)
    assert (w[1:] == same[0]).all() and (c[[0, 3]] == same[1]).all()      # words out of the batch stay


def test_no_words(spark):
    df = spark.createDataFrame([(None,), ([],), (["x"],)], "words array<string>")
    assert skipgram.skipgram(df, F.col("words"), size=4).count() == 0
    assert skipgram.skipgram(df, F.col("words"), size=4, min_count=1, blocks=2).select("token", F.size("vector")).collect() == [("x", 4)]


def test_nodes_of_one_part_are_near(spark):
    rng = random.Random(1)
    edges = [(a, b) for part in (range(10), range(10, 20)) for a in part for b in part if a < b and rng.random() < 0.8] + [(0, 10)]
    g = graph.build_graph(spark.createDataFrame(edges, "src long, dst long"))
    got = {int(r.word): np.array(r.vector) for r in graph.node_vectors(graph.random_walks(g, length=12, walks=40), dim=8, window=4).collect()}
    assert sorted(got) == list(range(20))
    cosine = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    inside = np.mean([cosine(a, b) for a in range(20) for b in range(20) if a < b and (a < 10) == (b < 10)])
    across = np.mean([cosine(a, b) for a in range(10) for b in range(10, 20)])
    assert inside > across + 0.3


def test_samples_that_a_run_shares_give_the_expected_step():
    """The mean of many small updates is the gradient of the pairs with `negatives` samples each."""
    rng = np.random.default_rng(3)
    w, c = rng.standard_normal((5, 6)).astype(np.float32), rng.standard_normal((7, 6)).astype(np.float32)
    words, others = np.array([0, 0, 0, 3]), np.array([1, 2, 1, 6])
    weight = np.array([3.0, 1.0, 2.0, 0.5, 1.5, 1.0, 1.0])
    share, sig = 3 * weight / weight.sum(), lambda v: 1 / (1 + np.exp(-v))
    dw, dc = np.zeros((5, 6)), np.zeros((7, 6))
    for a, b in zip(words, others, strict=True):
        for t in range(7):
            push = (1 - sig(w[a] @ c[t]) if t == b else 0.0) - (0.0 if t == b else share[t] * sig(w[a] @ c[t]))
            dw[a] += push * c[t]
            dc[t] += push * w[a]
    got_w, got_c = np.zeros((5, 6)), np.zeros((7, 6))
    for k in range(200):
        w1, c1 = w.copy(), c.copy()
        skipgram.train(words, others, w1, c1, weight, 3, 0.01, np.random.default_rng(k))
        got_w += (w1 - w) / 0.01 / 200
        got_c += (c1 - c) / 0.01 / 200
    assert np.allclose(got_w, dw, atol=0.02) and np.allclose(got_c, dc, atol=0.02)


def test_pairs_are_written_before_too_many_are_held(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(skipgram, "HELD", 1_000)
    lists = [list(range(100))] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["_id", "codes"])
    out = list(skipgram._pairs(3, 1, 1)(iter([batch])))
    assert len(out) > 10 and all(sum(len(x) for x in b.column(2).to_pylist()) <= 2 * 2_000 for b in out)


def test_word2vec_keeps_nothing_on_the_driver(spark):
    from pyspark.ml.util import JavaMLReadable

    from lumenframe.operators import textvec
    model = textvec.word2vec(planted(spark, 600), F.col("words"), size=16, window=4, min_count=5, partitions=4, iterations=4)
    assert not isinstance(model, JavaMLReadable) and isinstance(model.rows, type(spark.range(1)))
    near = [r.word for r in model.findSynonyms("t3x0", 5).collect()]
    assert len(near) == 5 and sum(w[-1] == "3" or w.startswith("t3x") for w in near) >= 3
