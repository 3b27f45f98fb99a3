import numpy as np
import itertools
import math

import pytest
from pyspark.sql import functions as F

from lumenframe.functions import tails
from lumenframe.operators import evaluate, graph, scoring, stats


def graph_of(spark, edges, nodes=None):
    ids = spark.createDataFrame([(n,) for n in nodes], "id long") if nodes else None
    return graph.build_graph(spark.createDataFrame(edges, "src long, dst long"), ids)


def values(df, col):
    return {r["id"]: round(r[col], 6) for r in df.collect()}


PATH = [(i, i + 1) for i in range(9)]
PETERSEN = [(i, (i + 1) % 5) for i in range(5)] + [(i, i + 5) for i in range(5)] + [(5 + i, 5 + (i + 2) % 5) for i in range(5)]


def test_build_graph_merges_and_drops_loops(spark):
    g = graph_of(spark, [(1, 2), (2, 1), (2, 2), (2, 3)], [1, 2, 3, 4])
    assert tuple(graph.graph_size(g).first()) == (4, 2)
    assert values(graph.degrees(g), "degree") == {1: 1, 2: 2, 3: 1, 4: 0}


def test_path_of_ten(spark):
    g = graph_of(spark, PATH)
    assert graph.is_connected(g) and tuple(graph.euler_check(g).first()) == (2, True, "path")
    ends = spark.createDataFrame([(0,)], "id long")
    assert values(graph.shortest_levels(g, ends), "distance") == {i: i for i in range(10)}
    near = values(graph.closeness(g), "cc")
    assert near[0] == round(9 / 45, 6) and near[4] == round(9 / 25, 6)
    between = values(graph.betweenness(g), "bc")
    assert between[0] == 0 and between[4] == round(2 * 4 * 5 / 72, 6)
    assert between == values(graph.betweenness(g, batch=6), "bc")
    assert set(values(graph.clustering(g), "coeff").values()) == {0.0}


def test_petersen(spark):
    g = graph_of(spark, PETERSEN)
    assert tuple(graph.graph_size(g).first()) == (10, 15)
    assert set(values(graph.degree_centrality(g), "dc").values()) == {round(3 / 9, 6)}
    assert set(values(graph.pagerank(g), "pr").values()) == {0.1} and set(values(graph.clustering(g), "coeff").values()) == {0.0}
    assert set(values(graph.harmonic(g), "hc").values()) == {6.0}
    assert set(values(graph.eigenvector_centrality(g), "ec").values()) == {round(1 / math.sqrt(10), 6)}


def test_star_has_no_oscillation_and_full_betweenness(spark):
    g = graph_of(spark, [(0, i) for i in range(1, 6)])
    ec = values(graph.eigenvector_centrality(g, 200, 1e-9), "ec")
    assert abs(ec[0] - 1 / math.sqrt(2)) < 1e-4
    assert values(graph.betweenness(g), "bc")[0] == 1.0


def test_distance_sums_in_several_batches(spark):
    n = 150
    edges = [(i, i // 6) for i in range(1, n)] + [(0, 75), (10, 120)]
    g = graph_of(spark, edges)
    one, many = graph._distance_sums(g, words=8), graph._distance_sums(g, words=1)
    read = lambda t: sorted((r["id"], r["reached"], r["far"], round(r["near"], 9)) for r in t.collect())
    assert read(one) == read(many) and len(read(one)) == n


def test_components_on_long_path_and_many_parts(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100), (200, 150)]
    g = graph_of(spark, edges, [999])
    got = values(graph.connected_components(g), "component")
    assert {got[i] for i in range(61)} == {0} and got[102] == 100 and got[200] == 150 and got[999] == 999
    assert not graph.is_connected(g)


def test_pagerank_sums_to_one_with_lonely_nodes(spark):
    g = graph_of(spark, [(1, 2), (2, 3)], [1, 2, 3, 4, 5])
    assert abs(sum(r["pr"] for r in graph.pagerank(g).collect()) - 1) < 1e-9


def test_hot_node_is_salted_without_changing_results(spark):
    g = graph_of(spark, [(0, i) for i in range(1, 40)] + [(1, 2), (3, 4)])
    hot = graph.Graph(g.edges, g.vertices, g.n, [0])
    assert values(graph.clustering(g), "coeff") == values(graph.clustering(hot), "coeff")
    assert values(graph.pagerank(g, iters=8), "pr") == values(graph.pagerank(hot, iters=8), "pr")


@pytest.mark.parametrize("p,q,weighted", [(1.0, 1.0, False), (0.5, 2.0, True)])
def test_walks_follow_edges(spark, p, q, weighted):
    edges = [(a, b, 1.0 + (a + b) % 3 if weighted else 1.0) for a, b in PETERSEN]
    g = graph.build_graph(spark.createDataFrame(edges, "src long, dst long, weight double"))
    walks = graph.random_walks(g, length=6, walks=3, p=p, q=q)
    paths = {r["walk"]: [s["id"] for s in sorted(r["s"], key=lambda s: s["step"])] for r in
             walks.groupBy("walk").agg(F.collect_list(F.struct("step", "id")).alias("s")).collect()}
    links = set(PETERSEN) | {(b, a) for a, b in PETERSEN}
    assert len(paths) == 30 and all(len(w) == 6 for w in paths.values())
    assert all((a, b) in links for w in paths.values() for a, b in zip(w, w[1:]))


def test_kendall_against_pairs(spark):
    data = [(i * 7 % 11, i * i % 13) for i in range(60)]
    c = d = ta = tb = 0
    for (a1, b1), (a2, b2) in itertools.combinations(data, 2):
        z = (a1 - a2) * (b1 - b2)
        c, d, ta, tb = c + (z > 0), d + (z < 0), ta + (a1 != a2), tb + (b1 != b2)
    r = stats.kendall_test(spark.createDataFrame(data, "a int, b int"), "a", "b").first()
    assert (r["concordant"], r["discordant"]) == (c, d) and abs(r["tau"] - (c - d) / math.sqrt(ta * tb)) < 1e-12


def test_tails_at_known_points():
    assert abs(tails.student_two_sided(2.228139, 10) - 0.05) < 1e-6
    assert abs(tails.chi_square_upper(3.841459, 1) - 0.05) < 1e-6 and abs(tails.chi_square_upper(18.307038, 10) - 0.05) < 1e-6
    assert abs(tails.f_upper(4.964603, 1, 10) - 0.05) < 1e-6 and abs(tails.normal_two_sided(1.959964) - 0.05) < 1e-6
    assert abs(tails.kolmogorov_upper(1.3581, 1) - 0.05) < 1e-4


def test_chi_square_two_by_two(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    r = stats.chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert abs(r["statistic"] - 100 * (10 * 40 - 20 * 30) ** 2 / (30 * 70 * 40 * 60)) < 1e-9 and r["df"] == 1


def test_normality_tests_tell_normal_from_exponential(spark):
    df = spark.range(1, 400).select("id", F.expr("(id - 0.5) / 399").alias("u"))
    from lumenframe.functions.numbers import normal_quantile
    df = df.select("id", normal_quantile(F.col("u")).alias("z"), (-F.ln(1 - F.col("u"))).alias("e"))
    assert stats.anderson_darling(df, "z").first()["p_value"] > 0.9 and stats.anderson_darling(df, "e").first()["p_value"] < 1e-6
    assert stats.shapiro_francia(df, "z", "id").first()["w"] > 0.999 and stats.shapiro_francia(df, "e", "id").first()["w"] < 0.9


def test_cap_and_roc(spark):
    rows = [(i, 1 if i < 4 else 0, 1 - i / 10) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, y int, s double")
    assert evaluate.auc(df, "y", "s").first()["auc"] == 1.0 and evaluate.cap_ratio(df, "y", "s").first()["cap_ratio"] == 1.0
    assert tuple(evaluate.cap_at_half(df, "y", "s").first()) == (100.0, "Too Good to be True")
    flat = df.withColumn("s", F.lit(0.5))
    assert evaluate.auc(flat, "y", "s").first()["auc"] == 0.5
    curve = sorted((r["x"], r["y"]) for r in evaluate.cap_curve(df, "y", "s", "id").collect())
    assert curve[0] == (0, 0) and curve[4] == (4, 4) and curve[-1] == (10, 4)


def test_power_law_prefers_true_exponent(spark):
    xs = [(1 - (i + 0.5) / 2000) ** (-1 / 1.5) for i in range(2000)]
    r = graph.power_law_fit(spark.createDataFrame([(round(x, 6),) for x in xs], "x double"), "x").first()
    assert abs(r["alpha"] - 2.5) < 0.1


def brute_power_law(xs):
    values, counts = np.unique(np.array(xs, float), return_counts=True)
    out = []
    for i in range(len(values) - 1):
        x, n = values[i:], counts[i:]
        alpha = 1 + n.sum() / (n * np.log(x / x[0])).sum()
        out.append((x[0], alpha, np.abs(1 - (x / x[0]) ** (1 - alpha) - (np.cumsum(n) - n) / n.sum()).max(), int(n.sum())))
    return out


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_power_law_by_blocks_equals_all_values_at_once(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "CANDIDATES", block)
    rng = np.random.default_rng(block)
    xs = np.concatenate([np.floor(rng.pareto(1.4, 150) * 3) + 1, rng.integers(1, 9, 60)]).tolist()
    table = spark.createDataFrame([(x,) for x in [*xs, None, 0.0, -3.0]], "x double").repartition(4)
    want = brute_power_law(xs)
    got = sorted(tuple(r) for r in graph.power_law_candidates(table, "x").collect())
    assert np.allclose(got, want)
    assert np.allclose(tuple(graph.power_law_fit(table, "x").first()), min(want, key=lambda r: (round(r[2], 9), r[0])))


def test_power_law_without_a_tail(spark):
    for rows in ([], [(2.0,)], [(2.0,), (2.0,)], [(None,), (-1.0,)]):
        assert graph.power_law_fit(spark.createDataFrame(rows, "x double"), "x").count() == 0


def test_scoring(spark):
    edges = spark.createDataFrame([(i, float(i + 1)) for i in range(4)], "edge long, cost double")
    chosen = spark.createDataFrame([(1, e) for e in range(4)] + [(2, 0)], "candidate long, edge long")
    got = {r["candidate"]: round(r["fitness"], 6) for r in scoring.score_selections(chosen, edges).collect()}
    assert got == {1: 0.0, 2: 0.9}
    bits = spark.createDataFrame([("0" * 8 + "1" * 8,)], "b string")
    r = scoring.decode_and_score(bits, "b", 16).first()
    assert (r["x"], r["y"]) == (6.0, -6.0) and abs(r["value"] - ((36 - 6 - 11) ** 2 + (6 + 36 - 7) ** 2)) < 1e-9


def test_rounds_move_numbers_of_hubs_only(spark, monkeypatch):
    """Two hubs with 200 leaves and a path: a leaf's edge lies with the leaf, so a hub is sent once to a part."""
    edges = [(h, 10 + i) for h in (0, 1) for i in range(200)] + [(500, 501), (501, 502)]
    g = graph_of(spark, edges, [900, None])
    monkeypatch.setattr(graph, "FEWEST", 100)
    flow = graph._Flow(g.edges, g.vertices, graph.degrees(g))
    assert flow.parts == 8
    assert flow.routes.count() <= 2 * flow.parts + 4 and flow.down.count() + flow.up.count() == 2 * len(edges)
    assert all(r["id"] in (0, 1, 500, 501, 502) for r in flow.routes.collect())
    homes = {r["part"] for r in flow.start.select("part").distinct().collect()}
    assert flow.start.select("part", F.spark_partition_id()).distinct().count() == len(homes)
    state = flow.step(flow.start.withColumn("x", F.coalesce(F.col("id"), F.lit(0)).cast("double")), lambda x, heard: 2 * x + heard)
    want = {i: 2.0 * i for i in [0, 1, 500, 501, 502, 900, *range(10, 210)]}
    for a, b in edges:
        want[a] += b
        want[b] += a
    assert {r["id"]: r["x"] for r in state.collect()} == {**want, None: 0.0}
