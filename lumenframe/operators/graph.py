"""Undirected simple graphs as edge tables: components, distances, centralities, triangles, walks.

Edges are stored in both directions, hash-partitioned by source and checkpointed once, so each round of an iteration
moves only the vertex state. Nodes with very many edges are salted in every join (see functions.joins). The state is
checkpointed each few rounds to keep plans short and to survive lost executors.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import Word2Vec
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import HOT_KEYS, HOT_ROWS, hot_from_counts, hot_keys, salted_join
from lumenframe.functions.ordering import cut, laid_out, rank_in_group, ranked, running, value_steps
from lumenframe.operators import cells as packed
from lumenframe.operators.cells import Cells, closed_pairs, distance_sums, packed_cells, path_shares
from lumenframe.operators.skipgram import skipgram

ROUNDS_PER_CUT = 4
SUMS_PER_CUT = 8
EDGES = 20_000_000            # directed edges of a part of a flow at most, however many cores there are
FEWEST = 20_000               # and at least, however few
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Graph:
    """Both directions of every edge (src, dst, weight), all vertices (id), and the heaviest sources."""
    edges: DataFrame
    vertices: DataFrame
    n: int
    hot: list = field(default_factory=list)

    def push(self, state: DataFrame) -> DataFrame:
        """Edge rows with the state of their source; state is keyed by id."""
        return salted_join(self.edges, state.withColumnRenamed("id", "src"), "src", "inner", hot=self.hot)

    @cached_property
    def cells(self) -> Cells:
        """The packed adjacency matrix, made once."""
        return packed_cells(packed.bundled(self.edges.where("src < dst")), self.vertices, self.n)


class PackedGraph(Graph):
    """A graph whose edges, all of weight 1, are held as packed cells; rows (edges) are made only for measures that need them."""

    def __init__(self, bundles: DataFrame, vertices: DataFrame, n: int) -> None:
        for name, value in (("bundles", bundles), ("vertices", vertices), ("n", n)):
            object.__setattr__(self, name, value)

    @cached_property
    def cells(self) -> Cells:
        return packed_cells(self.bundles, self.vertices, self.n)

    @cached_property
    def edges(self) -> DataFrame:
        return laid_out(packed.edge_rows(self.cells).withColumn("weight", F.lit(1.0)), "src")

    @cached_property
    def hot(self) -> list:
        return hot_from_counts(degrees(self), "id", "degree")


def build_graph(edges: DataFrame, nodes: DataFrame | None = None, dense: bool = False) -> Graph:
    """Simple undirected graph from (src, dst[, weight]): loops dropped, repeated edges merged, weights added up.

    `dense` is for graphs without weights that have many more edges than nodes: edges are packed where they are found.
    """
    weight = F.col("weight").cast("double") if "weight" in edges.columns else None
    if dense and weight is None:
        bundles = packed.bundled(edges)
        ids = packed.bundle_ids(bundles)
        vertices = cut(ids if nodes is None else nodes.select("id").unionByName(ids).distinct())
        return PackedGraph(bundles, vertices, vertices.count())
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"),
                                             (weight if weight is not None else F.lit(1.0)).alias("weight"))
    merged = pairs.groupBy("a", "b").agg((F.sum if weight is not None else F.max)("weight").alias("weight"))
    both = merged.select(F.inline(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst"), "weight"),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst"), "weight"))))
    kept = laid_out(both, "src")
    ends = kept.select(F.col("src").alias("id"))
    ids = ends.distinct() if nodes is None else nodes.select("id").unionByName(ends).distinct()
    vertices = cut(ids)
    return Graph(kept, vertices, vertices.count(), hot_keys(kept, "src"))


def graph_size(g: Graph) -> DataFrame:
    """Node and edge counts."""
    if isinstance(g, PackedGraph):
        return degrees(g).agg((F.sum("degree") / 2).cast("long").alias("n_edges")).select(F.lit(g.n).cast("long").alias("n_nodes"), "n_edges")
    return g.edges.agg((F.count(F.lit(1)) / 2).cast("long").alias("n_edges")).select(F.lit(g.n).cast("long").alias("n_nodes"), "n_edges")


def degrees(g: Graph) -> DataFrame:
    """(id, degree, strength); nodes without edges have 0."""
    if isinstance(g, PackedGraph):
        return packed.cell_degrees(g.cells).withColumn("strength", F.col("degree").cast("double"))
    none = g.vertices.select("id", F.lit(0).cast("long").alias("d"), F.lit(0.0).alias("w"))
    one = g.edges.select(F.col("src").alias("id"), F.lit(1).cast("long").alias("d"), F.col("weight").alias("w"))
    return one.unionByName(none).groupBy("id").agg(F.sum("d").alias("degree"), F.sum("w").alias("strength"))


def degree_centrality(g: Graph) -> DataFrame:
    return degrees(g).select("id", (F.col("degree") / max(g.n - 1, 1)).alias("dc"))


def _min_neighbour(rows: DataFrame) -> tuple[DataFrame, list]:
    """Smallest neighbour per node with the heavy nodes; the minimum is taken in each map task first."""
    low = cut(rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n")))
    hot = [r[0] for r in low.where(F.col("_n") > HOT_ROWS).orderBy(F.desc("_n")).limit(HOT_KEYS).select("u").collect()]
    return low.select("u", F.least("u", "m").alias("m")), hot


def connected_components(g: Graph, max_rounds: int = 100) -> DataFrame:
    """(id, component): the smallest id of the component.

    Alternating star contraction: larger neighbours, then smaller ones, are hooked to the smallest neighbour until
    every component is a star. The number of rounds grows with the logarithm of the size, not with the diameter.
    """
    if isinstance(g, PackedGraph):
        edges = cut(packed.component_links(g.cells))        # tasks join what they see, so few links are left to contract
    else:
        edges = g.edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u > v")
    mark = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, hot = _min_neighbour(both)
        large = salted_join(both.where("v > u"), low, "u", "inner", hot=hot).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low, hot = _min_neighbour(down)
        hooked = salted_join(down, low, "u", "inner", hot=hot).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hooked.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    root = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    own = g.vertices.select("id", F.col("id").alias("component"))
    return root.unionByName(own).groupBy("id").agg(F.min("component").alias("component"))


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def is_connected(g: Graph) -> bool:
    return g.n > 0 and connected_components(g).select("component").distinct().limit(2).count() == 1


def shortest_levels(g: Graph, sources: DataFrame) -> DataFrame:
    """Hop distance from each given source to every node it reaches: (source, id, distance)."""
    front = cut(sources.select(F.col("id").alias("source"), "id").distinct())
    visited = front.withColumn("distance", F.lit(0))
    if isinstance(g, PackedGraph):
        return visited.unionByName(packed.levels(g.cells, front.select("id"), front.count()))
    level = 0
    while True:
        level += 1
        step = g.push(front).select("source", F.col("dst").alias("id")).distinct()
        front = cut(step.join(visited.select("source", "id"), ["source", "id"], "left_anti"))
        if front.isEmpty():
            return visited
        visited = visited.unionByName(front.withColumn("distance", F.lit(level)))
        if level % ROUNDS_PER_CUT == 0:
            visited = cut(visited)


def _distance_sums(g: Graph, words: int | None = None) -> DataFrame:
    """Per node: reached nodes, sum of distances and of inverse distances, over all other nodes.

    Searches from 64 * words sources run in a task, by default as many as its memory bound allows and all cores need;
    each vertex holds one bit per source, and the packed cells of the graph stream by in every round. No (source, node)
    pairs and no rows per edge are written.
    """
    return distance_sums(g.cells, words)


def closeness(g: Graph, sums: DataFrame | None = None) -> DataFrame:
    """Reached nodes over their distance sum, scaled by the reached share of the graph."""
    r = F.col("reached")
    value = F.coalesce(F.try_divide(r, F.col("far")) * r / max(g.n - 1, 1), F.lit(0.0))
    return (sums if sums is not None else _distance_sums(g)).select("id", value.alias("cc"))


def harmonic(g: Graph, sums: DataFrame | None = None) -> DataFrame:
    """Sum of inverse distances."""
    return (sums if sums is not None else _distance_sums(g)).select("id", F.col("near").alias("hc"))


def distance_sketch(g: Graph, lg_k: int = 12) -> DataFrame:
    """Estimates of what _distance_sums counts, from one sketch of reached nodes per vertex.

    Round d merges the sketches of all neighbours, so its size is the number of nodes within d steps: as many rounds as
    the longest shortest path, and none per batch of sources. The relative error of a size is about 1.04 / sqrt(2 ** lg_k)
    (1.6 % by default; components of a few hundred nodes are counted); closeness and harmonic centrality inherit it. A task
    holds some of the registers of all nodes, so sketches do not travel.
    """
    return packed.sketch_sums(g.cells, connected_components(g), lg_k)


def pivots(g: Graph, count: int, seed: int = 0) -> DataFrame:
    """(id): the nodes whose hashes come first; the same ones in every run."""
    return g.vertices.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(count)


def betweenness(g: Graph, batch: int = 1_024, normalized: bool = True, sources: DataFrame | None = None, spread: bool = False) -> DataFrame:
    """Share of shortest paths through each node: path counts forward, dependencies backward, level by level.

    Without `sources` all nodes are sources and the result is exact. With a table of sources (`pivots` draws some) only
    paths from them are followed and sums are scaled by nodes / sources, which is right on average for drawn sources; with
    `spread` a column bc_error holds the standard error of that estimate (zero if every node is a source). A task follows
    at most `batch` sources, fewer where the graph is large, over the packed cells of the graph (operators.cells).
    """
    chosen = g.vertices if sources is None else cut(sources.select("id").distinct().join(g.vertices, "id", "left_semi"))
    n_sources = g.n if sources is None else chosen.count()
    total = path_shares(g.cells, chosen, n_sources, batch)
    scale = 1.0 / ((g.n - 1) * (g.n - 2)) if normalized and g.n > 2 else 0.5
    blown = g.n / n_sources if n_sources else 0.0
    out = total.select("id", (F.col("delta") * scale * blown).alias("bc"), *([_pivot_error(g.n, n_sources, scale).alias("bc_error")] if spread else []))
    return out


def _pivot_error(n: int, k: int, scale: float):
    """Standard error of n times the mean of k dependencies drawn without replacement."""
    if k in (0, n):
        return F.lit(0.0)
    if k == 1:
        return F.lit(float("inf"))
    variance = F.greatest((F.col("square") - F.col("delta") * F.col("delta") / k) / (k - 1), F.lit(0.0))
    return scale * n * F.sqrt(variance / k * (1 - k / n))


class _Flow:
    """A weighted sum over the neighbours of every node, for many rounds.

    An edge lies where its end of lower degree lives, in both directions. So the numbers of well linked nodes are sent once
    to each part that has an edge of theirs, and their sums come back once from each, while other nodes are met in place:
    a round moves no rows per edge. Parts are as few as the cores and EDGES allow, and a hub is spread over all of them.
    """

    def __init__(self, edges: DataFrame, vertices: DataFrame, deg: DataFrame) -> None:
        self.spark = edges.sparkSession
        rows = edges.count()
        self.parts = max(1, min(2 * self.spark.sparkContext.defaultParallelism, rows // FEWEST), math.ceil(rows / EDGES))
        known = deg.select("id", "degree")
        self.home = home = self._homes()
        hot = hot_from_counts(known, "id", "degree")
        ends = salted_join(edges, known.select(F.col("id").alias("src"), F.col("degree").alias("_s")), "src", "inner", hot=hot)
        ends = salted_join(ends, known.select(F.col("id").alias("dst"), F.col("degree").alias("_d")), "dst", "inner", hot=hot)
        low = F.struct("_d", "dst") < F.struct("_s", "src")                      # the target has the lower degree
        placed = cut(ends.select("src", "dst", "weight", low.alias("_low"), F.when(low, home("dst")).otherwise(home("src")).alias("part")))
        self.down = self._laid(placed.where("_low").select("part", "src", "dst", "weight"), "src")
        self.up = self._laid(placed.where("not _low").select("part", "src", "dst", "weight"), "src")
        self.routes = self._laid(self.down.select(home("src").alias("part"), F.col("src").alias("id"), F.col("part").alias("to")).distinct(), "id")
        self.start = self._laid(vertices.select(home("id").alias("part"), "id"), "id")

    def _homes(self):
        """Part of a node. A part is named by a number whose hash leads to a partition of its own, so all are of like size."""
        names = self.spark.range(64 * self.parts).select(F.col("id").cast("int").alias("part")).withColumn("at", F.pmod(F.hash("part"), F.lit(self.parts)))
        named = {r["at"]: r["part"] for r in names.groupBy("at").agg(F.min("part").alias("part")).collect()}
        listed = F.array(*[F.lit(named.get(at, at)) for at in range(self.parts)])
        return lambda c: F.element_at(listed, F.pmod(F.xxhash64(c), F.lit(self.parts)).cast("int") + 1)

    def _laid(self, df: DataFrame, key: str) -> DataFrame:
        return cut(df.repartition(self.parts, "part").sortWithinPartitions("part", key), keep_layout=True)

    def step(self, state: DataFrame, value) -> DataFrame:
        """(part, id, x) with x = value(x, sum of weight * x over the sources of the edges to id)."""
        met = state.hint("merge")                                               # never through the driver
        sent = met.join(self.routes, ["part", "id"]).select(F.col("to").alias("part"), F.col("id").alias("src"), "x").repartition(self.parts, "part")
        near = self.down.join(sent.hint("merge"), ["part", "src"]).groupBy("part", F.col("dst").alias("id")).agg(F.sum(F.col("weight") * F.col("x")).alias("_near"))
        own = self.up.join(state.withColumnRenamed("id", "src").hint("merge"), ["part", "src"])
        sums = own.groupBy("part", F.col("dst").alias("id")).agg(F.sum(F.col("weight") * F.col("x")).alias("_far"))
        far = (sums.select(self.home("id").alias("part"), "id", "_far").repartition(self.parts, "part")
               .groupBy("part", "id").agg(F.sum("_far").alias("_far")))
        none = F.lit(0.0)
        heard = F.coalesce("_near", none) + F.coalesce("_far", none)
        new = met.join(near, ["part", "id"], "left").hint("merge").join(far, ["part", "id"], "left").select("part", "id", value(F.col("x"), heard).alias("x"))
        # parts are told by one of the two join columns; rows of a part are together already
        before = self.spark.conf.get(CO_PARTITION)
        self.spark.conf.set(CO_PARTITION, "false")
        try:
            return cut(new, keep_layout=True)
        finally:
            self.spark.conf.set(CO_PARTITION, before)


class _CellFlow:
    """The same over packed cells: the numbers are written once a round, and a task adds up those of the neighbours of its rows."""

    def __init__(self, g: Graph, scale: DataFrame | None = None) -> None:
        self.cells = g.cells
        rows = self.cells.nodes.select("_ix", "id")
        self.start = cut(rows.withColumn("_w", F.lit(1.0)) if scale is None else rows.join(scale, "id", "left"))

    def step(self, state: DataFrame, value) -> DataFrame:
        sums = packed.neighbour_sums(self.cells, state.where("_w is not null").select("_ix", (F.col("x") * F.col("_w")).alias("x")))
        heard = F.coalesce("_heard", F.lit(0.0))
        return cut(state.join(sums.withColumnRenamed("x", "_heard"), "_ix", "left").select("_ix", "id", "_w", value(F.col("x"), heard).alias("x")))


def eigenvector_centrality(g: Graph, iters: int = 100, tol: float | None = 1e-6) -> DataFrame:
    """Power iteration on A + I from an even start, scaled to unit length; stops early when tol is given."""
    if isinstance(g, PackedGraph):
        flow = _CellFlow(g)
        flow.start = flow.start.where("id is not null")
    else:
        flow = _Flow(g.edges.select("src", "dst", F.lit(1.0).alias("weight")), g.vertices.where("id is not null"), cut(degrees(g)))
    state, before = flow.start.withColumn("x", F.lit(1.0 / max(g.n, 1))), None
    for i in range(1, iters + 1):
        state = flow.step(state, lambda x, heard: x + heard)
        if i % SUMS_PER_CUT and i != iters:
            continue        # only the direction matters, so lengths are reset once in a few rounds
        length = math.sqrt(state.agg(F.sum(F.col("x") * F.col("x"))).first()[0] or 0.0) or 1.0
        state = state.withColumn("x", F.col("x") / length)
        if tol is not None and before is not None and _moved(state, before) < g.n * tol:
            break
        before = state
    return state.select("id", F.col("x").alias("ec"))


def _moved(now: DataFrame, before: DataFrame) -> float:
    """Total change since the last checkpoint; this is stricter than the change in one round."""
    both = now.join(before.select("id", F.col("x").alias("y")), "id")
    return both.agg(F.sum(F.abs(F.col("x") - F.col("y")))).first()[0] or 0.0


def clustering(g: Graph) -> DataFrame:
    """Share of neighbour pairs that are linked: common neighbours along the edges, counted on packed cells."""
    deg = degrees(g).select("id", "degree")
    share = F.try_divide(2 * F.coalesce("t", F.lit(0)), F.col("degree") * (F.col("degree") - 1))
    return deg.join(closed_pairs(g.cells), "id", "left").select("id", F.coalesce(share, F.lit(0.0)).alias("coeff"))


def pagerank(g: Graph, alpha: float = 0.85, iters: int = 100, tol: float | None = 1e-6) -> DataFrame:
    """Weighted PageRank. Nodes without edges all hold the same value, so their mass is one number, not an aggregate."""
    deg = cut(degrees(g))
    lone = deg.where("degree = 0").count()
    if isinstance(g, PackedGraph):
        flow = _CellFlow(g, deg.where("degree > 0").select("id", (1 / F.col("strength")).alias("_w")))
    else:
        shares = salted_join(g.edges, deg.select(F.col("id").alias("src"), "strength"), "src", "inner", hot=g.hot)
        flow = _Flow(shares.select("src", "dst", (F.col("weight") / F.col("strength")).alias("weight")), g.vertices, deg)
    state, single, before = flow.start.withColumn("x", F.lit(1.0 / max(g.n, 1))), 1.0 / max(g.n, 1), None
    for i in range(1, iters + 1):
        base = alpha * single * lone / g.n + (1 - alpha) / g.n
        state = flow.step(state, lambda x, heard, base=base: base + alpha * heard)
        single = base
        if i % SUMS_PER_CUT == 0 or i == iters:
            if tol is not None and before is not None and _moved(state, before) < g.n * tol:
                break
            before = state
    return state.select("id", F.col("x").alias("pr"))


def measures_table(g: Graph) -> DataFrame:
    """One row per node with the seven measures."""
    sums = cut(_distance_sums(g))
    out = degree_centrality(g)
    for t in (closeness(g, sums), betweenness(g), harmonic(g, sums), eigenvector_centrality(g), clustering(g), pagerank(g)):
        out = out.join(t, "id")
    return out.select("id", "dc", "cc", "bc", "hc", "ec", "coeff", "pr")


def pdf_ccdf(df: DataFrame, col: str) -> DataFrame:
    """Share of rows at each value and at or above it."""
    steps = value_steps(df, col)
    total = df.where(F.col(col).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return steps.select(col, (F.col("n") / total).alias("pdf"), ((total - F.col("cum_n") + F.col("n")) / total).alias("ccdf"))


CANDIDATES = 1_024            # values in a block of power_law_candidates


def _tails(df: DataFrame, col: str) -> DataFrame:
    """(_ix, x, tail, alpha) of every distinct positive value: rows from it on, and the exponent if it is the lower end."""
    counts = df.where(F.col(col) > 0).groupBy(F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    sums = running(counts.withColumn("logs", F.col("n") * F.ln("x")), [], ["-x"], {"tail": ("sum", "n"), "above": ("sum", "logs")})
    alpha = 1 + F.try_divide(F.col("tail"), F.col("above") - F.col("tail") * F.ln("x"))
    return cut(ranked(sums.select("x", "tail", alpha.alias("alpha")), ["x"], "_ix").select((F.col("_ix") - 1).alias("_ix"), "x", "tail", "alpha"))


def _packed_values(rows: DataFrame, number: Column) -> DataFrame:
    """(block, x, tail, alpha): up to CANDIDATES values a row, in ascending order."""
    one = F.struct("x", "tail", "alpha")
    packs = rows.groupBy(F.floor(number / CANDIDATES).alias("block")).agg(F.array_sort(F.collect_list(one)).alias("l"))
    part = lambda c: F.transform("l", lambda e: e[c]).alias(c)
    return packs.select("block", part("x"), part("tail"), part("alpha"))


def _distances(candidates: DataFrame, values: DataFrame, last: int) -> DataFrame:
    """The largest gap between fitted and counted shares at the given values, for every candidate; a task sees two blocks."""
    pairs = candidates.select(F.col("block").alias("_c"), *[F.col(c).alias(f"_{c}") for c in ("x", "tail", "alpha")],
                              F.explode(F.sequence(F.col("first"), F.lit(last))).alias("block")).join(values.drop("alpha"), "block")

    def gaps(batches):
        for b in batches:
            for xs, tails, alphas, x, tail in zip(b["_x"], b["_tail"], b["_alpha"], b["x"], b["tail"], strict=True):
                low, n, a = (np.asarray(v, float)[:, None] for v in (xs, tails, alphas))
                x, tail = np.asarray(x, float)[None, :], np.asarray(tail, float)[None, :]
                gap = np.where(x >= low, np.abs(1 - (np.maximum(x, low) / low) ** (1 - a) - (n - tail) / n), 0.0)
                yield pd.DataFrame({"xmin": low[:, 0], "alpha": a[:, 0], "distance": gap.max(axis=1), "n_tail": n[:, 0].astype(np.int64)})
    found = pairs.mapInPandas(gaps, "xmin double, alpha double, distance double, n_tail long")
    return found.groupBy("xmin").agg(F.any_value("alpha").alias("alpha"), F.max("distance").alias("distance"), F.any_value("n_tail").alias("n_tail"))


def power_law_candidates(df: DataFrame, col: str) -> DataFrame:
    """For each possible lower end: exponent by maximum likelihood and distance to the fitted distribution.

    Values and candidates are compared block by block; nothing but the number of blocks reaches the driver.
    """
    rows = _tails(df, col)
    top = rows.agg(F.max("_ix")).first()[0] or 0
    able = _packed_values(rows.where(F.col("_ix") < top), F.col("_ix"))                 # the largest value has no tail
    return _distances(able.withColumn("first", F.col("block")), _packed_values(rows, F.col("_ix")), top // CANDIDATES)


def power_law_fit(df: DataFrame, col: str) -> DataFrame:
    """The candidate with the smallest distance, the smallest value among equals (to nine digits).

    The distance at some of the values (every CANDIDATES-th one and the largest) is a lower bound. The candidate with the
    least bound is measured in full, and only candidates whose bound is not above its distance are measured at all.
    """
    rows = _tails(df, col)
    top = rows.agg(F.max("_ix")).first()[0] or 0
    last, able = top // CANDIDATES, rows.where(F.col("_ix") < top)
    some = rows.where((F.col("_ix") % CANDIDATES == 0) | (F.col("_ix") == top))
    coarse = _packed_values(some, F.floor(F.col("_ix") / CANDIDATES))
    blocks = cut(_packed_values(rows, F.col("_ix")))
    low = _distances(_packed_values(able, F.col("_ix")).withColumn("first", F.floor(F.col("block") / CANDIDATES)), coarse, last // CANDIDATES)
    low = cut(low.select(F.col("xmin").alias("x"), F.col("distance").alias("bound")))
    narrow = lambda which: _packed_values(able.join(which.select("x"), "x"), F.col("_ix")).withColumn("first", F.col("block"))
    best = _distances(narrow(low.orderBy("bound", "x").limit(1)), blocks, last).first()
    if best is None:
        return low.select(F.col("x").alias("xmin"), F.lit(0.0).alias("alpha"), F.lit(0.0).alias("distance"), F.lit(0).cast("long").alias("n_tail"))
    full = _distances(narrow(low.where(F.col("bound") <= best["distance"] + 1e-9)), blocks, last)
    return full.withColumn("_d", F.round("distance", 9)).orderBy("_d", "xmin").limit(1).drop("_d")


def random_walks(g: Graph, length: int = 30, walks: int = 200, p: float = 1.0, q: float = 1.0, seed: int = 0) -> DataFrame:
    """(walk, step, id): `walks` walks of `length` nodes from every node with an edge.

    A walker proposes one of its neighbours by number, which is an equality join spread evenly even at a hub, and
    accepts it with probability weight * bias / largest; refused walkers propose again. The hash of walk, step and
    try is the random number, so a rerun gives the same walks. The numbered neighbours are laid out once, so a step moves
    only the walkers, and these carry no more of their path than the nodes since the last checkpoint. Where all neighbours
    are as likely and the edges are packed, walkers stay in their task and the cells are read once a step.
    """
    if isinstance(g, PackedGraph) and p == q == 1.0 and -(1 << 31) <= seed < 1 << 31:
        return packed.even_walks(g.cells, length, walks, seed).select("walk", F.posexplode("path").alias("step", "id"))
    listed = rank_in_group(g.edges, ["src"], ["dst"], "_nr")
    deg = degrees(g).where("degree > 0").select("id", "degree")
    top = g.edges.groupBy("src").agg(F.max("weight").alias("_top"))
    nxt = salted_join(listed, deg.select(F.col("id").alias("dst"), F.col("degree").alias("next_degree")), "dst", "inner", hot=g.hot)
    table = laid_out(salted_join(nxt, top, "src", "inner", hot=g.hot).select(
        F.col("src").alias("id"), "_nr", F.col("dst").alias("next"), "next_degree", (F.col("weight") / F.col("_top")).alias("_w")), "id", "_nr")
    even = p == q == 1.0 and table.where("_w < 1").isEmpty()
    biggest = max(1.0, 1 / p, 1 / q)
    known = g.edges.select(F.col("src").alias("prev"), F.col("dst").alias("next"), F.lit(True).alias("_near"))
    start = deg.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))))
    kind = dict(g.vertices.dtypes)["id"]
    null_prev, nothing = F.lit(None).cast(kind), F.array().cast(f"array<{kind}>")
    now = start.select(F.concat_ws("-", "id", "_k").alias("walk"), "id", "degree", null_prev.alias("prev"), F.array("id").alias("path"))
    step_on = [F.col("walk"), F.col("next").alias("id"), F.col("next_degree").alias("degree"), F.col("id").alias("prev"),
               F.concat("path", F.array("next")).alias("path")]
    parts, at = [], 0
    piece = lambda rows, first: rows.select("walk", F.struct(F.lit(first).alias("at"), "path").alias("_p"))
    for step in range(1, length):
        open_, moved, tries = now, None, 0
        while True:
            number = F.pmod(F.xxhash64("walk", F.lit(step), F.lit(tries), F.lit(seed)), F.col("degree")) + 1
            offer = open_.withColumn("_nr", number).join(table, ["id", "_nr"])
            if even:
                moved = offer.select(*step_on)
                break
            offer = offer.join(known, ["prev", "next"], "left")
            bias = (F.when(F.col("prev").isNull(), F.lit(1.0)).when(F.col("next") == F.col("prev"), 1 / p)
                    .when(F.col("_near"), 1.0).otherwise(1 / q))
            luck = F.pmod(F.xxhash64(F.lit("luck"), "walk", F.lit(step), F.lit(tries), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
            offer = cut(offer.withColumn("_ok", luck < F.col("_w") * bias / biggest))
            taken = offer.where("_ok").select(*step_on)
            moved = taken if moved is None else moved.unionByName(taken)
            open_ = offer.where("not _ok").select("walk", "id", "degree", "prev", "path")
            tries += 1
            if open_.isEmpty():
                break
        now = moved
        if step % ROUNDS_PER_CUT == 0 or not even:
            now = cut(moved)
            parts.append(piece(now, at))
            now, at = now.withColumn("path", nothing), step + 1
    parts.append(piece(now, at))
    pieces = reduce(DataFrame.unionByName, parts)
    whole = pieces.groupBy("walk").agg(F.flatten(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["path"])).alias("path"))
    return whole.select("walk", F.posexplode("path").alias("step", "id"))


def off_edges(g: Graph, rows: DataFrame) -> DataFrame:
    """Those of the rows (src, dst, ...) that are no edge of the graph."""
    return packed.missing(g.cells, rows) if isinstance(g, PackedGraph) else rows.join(g.edges.select("src", "dst"), ["src", "dst"], "left_anti")


def node_embeddings(walks: DataFrame, dim: int = 2, window: int = 10, seed: int = 1, partitions: int = 1) -> DataFrame:
    """(word, vector) per node, by Spark ML Word2Vec over the walks."""
    lists = walks.groupBy("walk").agg(F.array_sort(F.collect_list(F.struct("step", "id"))).alias("_s"))
    sentences = lists.select(F.transform("_s", lambda s: s["id"].cast("string")).alias("nodes"))
    return Word2Vec(vectorSize=dim, windowSize=window, minCount=1, seed=seed, numPartitions=partitions,
                    inputCol="nodes", outputCol="v").fit(sentences).getVectors()


def node_vectors(walks: DataFrame, dim: int = 2, window: int = 10, passes: int = 5, seed: int = 1) -> DataFrame:
    """(word, vector) per node by the skip-gram of operators.skipgram, for graphs whose vectors do not fit one machine."""
    lists = walks.groupBy("walk").agg(F.array_sort(F.collect_list(F.struct("step", "id"))).alias("_s"))
    sentences = lists.select(F.transform("_s", lambda s: s["id"].cast("string")).alias("nodes"))
    return skipgram(sentences, F.col("nodes"), dim, window, 1, passes=passes, seed=seed).select(F.col("token").alias("word"), "vector")


def euler_check(g: Graph) -> DataFrame:
    """Number of odd nodes, whether all edges hang together, and tour, path or none."""
    deg = cut(degrees(g))
    together = connected_components(g).join(deg.where("degree > 0").select("id"), "id", "left_semi").select("component").distinct().limit(2).count() <= 1
    odd = deg.agg(F.count_if(F.col("degree") % 2 == 1).alias("odd_nodes"))
    kind = (F.when(~F.lit(together), "none").when(F.col("odd_nodes") == 0, "tour").when(F.col("odd_nodes") == 2, "path").otherwise("none"))
    return odd.select("odd_nodes", F.lit(together).alias("connected"), kind.alias("euler"))
