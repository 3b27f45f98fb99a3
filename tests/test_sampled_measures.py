"""Centralities from some sources or from sketches, next to the exact ones."""
from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from lumenframe.operators import graph


@pytest.fixture(scope="module")
def wide(spark):
    """A ring with chords, a star of leaves on one node, a second part and lone nodes."""
    rng = random.Random(0)
    edges = [(i, (i + 1) % 120) for i in range(120)] + [(rng.randrange(120), rng.randrange(120)) for _ in range(60)]
    edges += [(0, 200 + i) for i in range(30)] + [(300, 301), (301, 302)]
    nodes = spark.createDataFrame([(400,), (401,)], "id long")
    return graph.build_graph(spark.createDataFrame(edges, "src long, dst long"), nodes)


def values(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_all_sources_are_the_exact_form(wide):
    exact = values(graph.betweenness(wide), "bc")
    named = graph.betweenness(wide, sources=wide.vertices, spread=True, batch=50)
    assert values(named, "bc") == pytest.approx(exact) and named.where("bc_error <> 0").isEmpty()


def test_sources_add_up_to_the_whole(spark, wide):
    ids = sorted(r.id for r in wide.vertices.collect())
    parts = [ids[:70], ids[70:]]
    found = [values(graph.betweenness(wide, sources=spark.createDataFrame([(i,) for i in p], "id long")), "bc") for p in parts]
    exact = values(graph.betweenness(wide), "bc")
    assert {i: sum(f[i] * len(p) / len(ids) for f, p in zip(found, parts, strict=True)) for i in ids} == pytest.approx(exact)


def test_estimate_and_error_of_drawn_sources(spark, wide):
    """One source at a time gives the dependencies of which the estimate is n times the mean."""
    drawn = [r.id for r in graph.pivots(wide, 2).collect()]
    assert drawn == [r.id for r in graph.pivots(wide, 2).collect()]
    alone = [values(graph.betweenness(wide, sources=spark.createDataFrame([(i,)], "id long")), "bc") for i in drawn]
    rows = graph.betweenness(wide, sources=graph.pivots(wide, 2), spread=True).collect()
    assert len(rows) == wide.n
    for r in rows:
        a, b = (x[r.id] for x in alone)
        assert r.bc == pytest.approx((a + b) / 2)
        assert r.bc_error == pytest.approx(math.sqrt((a - b) ** 2 / 2 / 2 * (1 - 2 / wide.n)))


def test_unknown_and_no_sources(spark, wide):
    none = graph.betweenness(wide, sources=spark.createDataFrame([(-1,)], "id long"), spread=True)
    assert none.count() == wide.n and none.where("bc <> 0").isEmpty()


@pytest.mark.parametrize("lg_k,most", [(12, 0.08), (6, 0.6)])
def test_sketches_are_close_to_the_exact_sums(wide, lg_k, most):
    sums = graph.distance_sketch(wide, lg_k)
    for measure, name in ((graph.closeness, "cc"), (graph.harmonic, "hc")):
        exact, about = values(measure(wide), name), values(measure(wide, sums), name)
        assert exact.keys() == about.keys()
        assert max(abs(about[i] - x) / x if x else about[i] for i, x in exact.items()) <= most


def test_sketch_of_lone_nodes(spark):
    g = graph.build_graph(spark.createDataFrame([], "src long, dst long"), spark.createDataFrame([(1,), (2,)], "id long"))
    assert graph.distance_sketch(g).select("reached", "far", F.col("near")).distinct().collect() == [(0, 0.0, 0.0)]
