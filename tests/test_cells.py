"""Graph measures on packed cells against brute force, with several blocks and batches."""
import itertools

import pytest

from lumenframe.operators import cells, graph


def edges_of(n):
    return [(a, b) for a, b in itertools.combinations(range(n), 2) if (a * 7 + b * 13) % 11 < 3 or b == a + 1]


@pytest.fixture(scope="module")
def mesh(spark):
    old = cells.BLOCK
    cells.BLOCK = 16
    g = graph.build_graph(spark.createDataFrame(edges_of(70), "src long, dst long"), spark.createDataFrame([(i,) for i in range(75)], "id long"))
    g.cells
    cells.BLOCK = old
    return g


@pytest.fixture(scope="module")
def near():
    out = {i: set() for i in range(75)}
    for a, b in edges_of(70):
        out[a].add(b), out[b].add(a)
    return out


def test_pieces_hold_every_edge_once_in_a_few_bytes(mesh, near):
    got, size = [], 0
    for p in mesh.cells.pieces.collect():
        rows, counts, places = (memoryview(bytes(p[c])).cast(k) for c, k in zip("abc", "HiH"))
        at = iter(places)
        got += [(p["j"] * 16 + r, p["i"] * 16 + next(at)) for r, n in zip(rows, counts) for _ in range(n)]
    ids = {r["_ix"]: r["id"] for r in mesh.cells.nodes.collect()}
    assert sorted((ids[a], ids[b]) for a, b in got) == sorted((a, b) for a in near for b in near[a])


def test_clustering_over_blocks(mesh, near):
    got = {r["id"]: r["coeff"] for r in graph.clustering(mesh).collect()}
    for v, around in near.items():
        k, linked = len(around), sum(b in near[a] for a, b in itertools.combinations(around, 2))
        assert got[v] == pytest.approx(2 * linked / (k * (k - 1)) if k > 1 else 0.0)


def test_no_row_per_path_is_moved(mesh):
    """The counting plan joins packed pieces only: nothing in it is as long as the edges."""
    plan = cells.closed_pairs(mesh.cells)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Join") == 1


def test_walk_steps_move_the_walkers_only(spark, mesh, near):
    rows = graph.random_walks(mesh, length=11, walks=2)
    paths = {}
    for r in rows.collect():
        paths.setdefault(r["walk"], {})[r["step"]] = r["id"]
    assert len(paths) == 2 * sum(1 for v in near if near[v])
    for walk, path in paths.items():
        assert sorted(path) == list(range(11)) and str(path[0]) == walk.split("-")[0]
        assert all(path[i + 1] in near[path[i]] for i in range(10))


def rows_with_flaws(spark):
    rows = [*edges_of(70), *[(b, a) for a, b in edges_of(70)[::3]], (3, 3), (None, 4), (5, None)]
    return spark.createDataFrame(rows, "src long, dst long"), spark.createDataFrame([(i,) for i in [*range(75), None]], "id long")


@pytest.fixture(scope="module")
def dense(spark):
    """The same graph with edges in both directions, repeats, loops and ends without a number, packed where it is found."""
    old = cells.BLOCK, cells.HELD, cells.LONG
    cells.BLOCK, cells.HELD, cells.LONG = 16, 500, 40
    g = graph.build_graph(*rows_with_flaws(spark), dense=True)
    g.cells
    cells.BLOCK, cells.HELD, cells.LONG = old
    return g


def test_measures_make_no_row_per_edge(spark, dense, near):
    """Everything but walks with a bias works on the cells; the edges as rows are never made."""
    plain, few = graph.build_graph(*rows_with_flaws(spark)), spark.createDataFrame([(0,), (7,), (74,), (99,)], "id long")
    for measure in (graph.connected_components, graph.degrees, graph.clustering, graph.closeness, graph.harmonic, lambda g: graph.shortest_levels(g, few), lambda g: graph.betweenness(g, batch=7),
                    lambda g: graph.eigenvector_centrality(g, 8, None), lambda g: graph.pagerank(g, 0.85, 8, None), graph.euler_check, graph.graph_size):
        got, want = (sorted(map(tuple, measure(g).collect()), key=str) for g in (dense, plain))
        assert [g[:-1] for g in got] == [w[:-1] for w in want]
        assert [g[-1] for g in got] == (pytest.approx([w[-1] for w in want]) if isinstance(got[0][-1], float) else [w[-1] for w in want])
    assert "edges" not in vars(dense) and len(vars(dense)["cells"].pieces.collect()) > 25
    assert sorted((r["src"], r["dst"]) for r in dense.edges.collect()) == sorted((a, b) for a in near for b in near[a])


def test_a_search_moves_no_cells(spark, dense):
    """All levels of a search run in one task: the plan reads neither edges nor pieces, and no exchange is as long as they are."""
    plan = cells.distance_sums(dense.cells)._jdf.queryExecution().optimizedPlan().toString()
    assert "j#" not in plan and plan.count("Join") == 1


def test_packed_walks_are_those_over_rows(spark, dense, mesh):
    got, want = (sorted(map(tuple, graph.random_walks(g, length=9, walks=3, seed=5).collect())) for g in (dense, mesh))
    assert got == want
    steps = spark.createDataFrame([("a", 0, 1), ("b", 0, 0), ("c", 99, 1), ("d", None, 1)], "name string, src long, dst long")
    assert sorted(r["name"] for r in graph.off_edges(dense, steps).collect()) == ["b", "c", "d"]


def test_sketches_count_small_components_and_estimate_others(spark):
    rows = [(10_000 + 2 * k, 10_001 + 2 * k) for k in range(300)] + [(0, k) for k in range(1, 3_000)]
    g = graph.build_graph(spark.createDataFrame(rows, "src long, dst long"), dense=True)
    got = {r["id"]: (r["reached"], r["far"]) for r in graph.distance_sketch(g).collect()}
    assert all(got[k] == (1, 1.0) for k in range(10_000, 10_600))
    assert got[0][0] == pytest.approx(2_999, rel=0.08) and got[5][0] == pytest.approx(2_999, rel=0.08)


def test_string_ids_and_an_empty_dense_graph(spark):
    g = graph.build_graph(spark.createDataFrame([("b", "a"), ("b", "c"), ("x", "y")], "src string, dst string"), dense=True)
    assert {r["id"]: r["component"] for r in graph.connected_components(g).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    none = graph.build_graph(spark.createDataFrame([], "src long, dst long"), spark.createDataFrame([(1,)], "id long"), dense=True)
    assert [tuple(r) for r in graph.connected_components(none).collect()] == [(1, 1)]
    for measure in (graph.clustering, graph.closeness, graph.betweenness, graph.pagerank, graph.eigenvector_centrality):
        assert [r["id"] for r in measure(none).collect()] == [1]
    assert graph.random_walks(none).count() == 0 and graph.distance_sketch(none).first()["reached"] == 0
