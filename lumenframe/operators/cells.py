"""A graph as packed cells of its adjacency matrix, for measures that look from every node at every other.

Nodes are numbered and cut into blocks of bounded size; the edges from one block to another are a cell, kept as pieces of
compressed rows with two bytes an edge. Edges are packed where they are found, so rows with one edge each are neither
shuffled nor written. The cells are written once below the shared folder, a block of rows after the other, and tasks read
them from there as often as they need: a search holds the numbers of all nodes for a batch of sources (their count falls as
the graph grows, so this is bounded by STATE) and goes through all its levels in one task. Nothing is written on the way.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.ordering import cut, fresh_path, ranked, stored

BLOCK = 8_192                 # nodes of a block at most
LEAST = 128                   # and at least, if there are as many
SPLIT = 16                    # blocks of a graph that fits fewer
STATE = 1 << 25               # bytes of one array over all nodes that a task holds
HELD = 1 << 21                # edges packed together
LONG = 1 << 20                # edges of a piece at most
KEPT = 1 << 26                # bytes of cells that a task keeps instead of reading them again
WALKERS = 1 << 18             # walkers of a task
ENDED = 50_000                # walks of a partition
_PIECE = "j int, i int, a binary, b binary, c binary"


class Files:
    """What tasks read: the pieces of a block of rows, and the ids of all nodes in the order of their numbers."""

    def __init__(self, pieces: dict[int, list[str]], nodes: list[str], keep: bool) -> None:
        self.pieces, self.nodes, self.kept = pieces, nodes, {} if keep else None

    def rows(self, j: int) -> Iterator[tuple]:
        """(i, rows, starts, places) of the pieces of block j, by i."""
        if self.kept is None:
            return self._read(j)
        if j not in self.kept:
            self.kept[j] = list(self._read(j))
        return iter(self.kept[j])

    def _read(self, j: int) -> Iterator[tuple]:
        for uri in self.pieces.get(j, ()):
            store, path = pafs.FileSystem.from_uri(uri)
            with store.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=8, columns=["i", "a", "b", "c"]):
                    a, b, c = (batch.column(x) for x in ("a", "b", "c"))
                    for at, i in enumerate(batch.column("i").to_pylist()):
                        yield i, *_piece(a[at], b[at], c[at])

    def ids(self) -> pa.Array:
        whole = _table(self.nodes)
        return whole.column("id").combine_chunks().take(pc.sort_indices(whole.column("_ix")))


def _table(uris: list[str]) -> pa.Table:
    tables = []
    for uri in uris:
        store, path = pafs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as file:
            tables.append(pq.read_table(file, partitioning=None))
    return pa.concat_tables(tables)


def _numbers(uris: list[str], n: int) -> np.ndarray:
    """x by _ix, 0 where there is none."""
    rows, out = _table(uris), np.zeros(n)
    out[rows.column("_ix").to_numpy()] = rows.column("x").to_numpy()
    return out


class Cells:
    """(_ix, id) of all nodes, and pieces (j, i, a, b, c): rows a of block j with b neighbours each, listed in c, in block i."""

    def __init__(self, nodes: DataFrame, pieces: DataFrame, files: Files, n: int, block: int) -> None:
        self.nodes, self.pieces, self.files, self.n, self.block, self.blocks = nodes, pieces, files, n, block, math.ceil(n / block)


def _spans(n: int, block: int) -> Callable[[int], slice]:
    return lambda i: slice(i * block, min(n, (i + 1) * block))


# ---- packing -----------------------------------------------------------------------------------------------------


def bundled(pairs: DataFrame) -> DataFrame:
    """(a, b, d, c) rows of many (src, dst) rows each: the ids a with b neighbours each, as places c in the ids d. Written once."""
    kind = dict(pairs.dtypes)["src"]

    def bundle(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        left, right = (rows.column(x).combine_chunks().dictionary_encode() for x in (0, 1))
        code = np.unique(left.indices.to_numpy().astype(np.int64) * len(right.dictionary) + right.indices.to_numpy())
        row, place = np.divmod(code, len(right.dictionary))
        small = len(right.dictionary) <= 1 << 16
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays([whole(left.dictionary), pa.array([np.bincount(row).astype("<i4").tobytes()], pa.binary()), whole(right.dictionary),
                                           pa.array([place.astype("<u2" if small else "<u4").tobytes()], pa.binary())], names=["a", "b", "d", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= HELD:
                yield bundle(held)
                held, n = [], 0
        if held:
            yield bundle(held)
    return stored(pairs.select("src", "dst").where("src <> dst").mapInArrow(work, f"a array<{kind}>, b binary, d array<{kind}>, c binary"))


def bundle_ids(bundles: DataFrame) -> DataFrame:
    """(id): the ends of all edges."""
    return bundles.select(F.explode("a").alias("id")).unionByName(bundles.select(F.explode("d").alias("id"))).distinct()


def _dealt(files: Files, block: int):
    """Bundles as (j, i, c) rows: both directions of their edges by cell, as sorted numbers row * block + column."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = None
        for batch in batches:
            ids = files.ids() if ids is None else ids
            for at in range(batch.num_rows):
                a, d = (pc.index_in(batch.column(x)[at].values, value_set=ids).to_numpy().astype(np.int64) for x in ("a", "d"))
                count, place = np.frombuffer(batch.column("b")[at].as_buffer(), "<i4"), batch.column("c")[at].as_buffer()
                place = np.frombuffer(place, "<u2" if len(d) <= 1 << 16 else "<u4")
                ends = np.repeat(a, count), d[place]
                blocks = -(-len(ids) // block)
                for to, start in (ends, ends[::-1]):
                    code = np.sort((((to // block) * blocks + start // block) * block + to % block) * block + start % block)
                    cell = code // (block * block)
                    edges = [*np.flatnonzero(np.diff(cell, prepend=-1)).tolist(), len(cell)]
                    first, code = cell[edges[:-1]], (code - cell * (block * block)).astype("<i4")
                    yield pa.RecordBatch.from_arrays([pa.array(first // blocks, pa.int32()), pa.array(first % blocks, pa.int32()),
                                                      pa.array([code[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], names=["j", "i", "c"])
    return work


def _merged(block: int):
    """Pieces of whole cells from sorted (j, i, c) rows; an edge that came more than once counts once."""
    def pieces(key: tuple[int, int], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sum(map(len, held)) > LONG:
            flags = np.zeros(block * block, bool)
            for x in held:
                flags[x] = True
            code = np.flatnonzero(flags)
        else:
            code = np.unique(np.concatenate(held))
        for at in range(0, len(code), LONG):
            row, place = np.divmod(code[at:at + LONG], block)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            parts = (row[first].astype("<u2"), np.diff(np.append(first, len(row))).astype("<i4"), place.astype("<u2"))
            yield pa.RecordBatch.from_arrays([*[pa.array([k], pa.int32()) for k in key], *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["j", "i", "a", "b", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at, key in enumerate(zip(batch.column("j").to_pylist(), batch.column("i").to_pylist(), strict=True)):
                    yield key, np.frombuffer(batch.column("c")[at].as_buffer(), "<i4")
        for key, group in groupby(rows(), lambda x: x[0]):
            yield from pieces(key, [x for _, x in group])
    return work


def _written(df: DataFrame, label: str, *by: str) -> str:
    """Parquet in small row groups, so that a reader holds little."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("parquet.block.size", 8 << 20).option("parquet.enable.dictionary", "false").partitionBy(*by).parquet(path)
    return path


def packed_cells(bundles: DataFrame, vertices: DataFrame, n: int) -> Cells:
    """The cells of a graph from its bundles and its nodes (id); one move of its edges, about four bytes each."""
    spark = vertices.sparkSession
    nodes = stored(ranked(vertices, ["id"], "_ix").select("id", (F.col("_ix") - 1).cast("int").alias("_ix")))
    block = max(1, min(BLOCK, max(LEAST, math.ceil(n / SPLIT))))
    listed = Files({}, nodes.inputFiles(), False)
    dealt = bundles.mapInArrow(_dealt(listed, block), "j int, i int, c binary").repartition(max(1, math.ceil(n / block)), "j").sortWithinPartitions("j", "i")
    path = _written(dealt.mapInArrow(_merged(block), _PIECE).sortWithinPartitions("j", "i"), "cells", "j")
    if n and not bundles.isEmpty():
        pieces = spark.read.schema(_PIECE).parquet(path).select("j", "i", "a", "b", "c")
        size = pieces.agg(F.sum(F.octet_length("a") + F.octet_length("b") + F.octet_length("c"))).first()[0]
        uris = pieces.inputFiles()
    else:
        pieces, size, uris = spark.createDataFrame([], _PIECE), 0, []
    by_block: dict[int, list[str]] = {}
    for uri in sorted(uris):
        by_block.setdefault(int(uri.split("/j=")[-1].split("/")[0]), []).append(uri)
    return Cells(nodes, pieces, Files(by_block, listed.nodes, size <= KEPT), n, block)


def _piece(a, b, c) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a piece, the starts of their neighbours and the neighbours."""
    count = np.frombuffer(b.as_buffer(), "<i4")
    return np.frombuffer(a.as_buffer(), "<u2"), np.cumsum(count) - count, np.frombuffer(c.as_buffer(), "<u2")


def _gathered(how: np.ufunc, table: np.ndarray, into: np.ndarray, wanted: np.ndarray, rows: np.ndarray, starts: np.ndarray, places: np.ndarray) -> None:
    """into[row] = how(into[row], table of its neighbours) for the rows that are wanted, some at a time."""
    mine = np.flatnonzero(wanted[rows])
    if not len(mine):
        return
    ends = np.append(starts[1:], len(places))
    if len(mine) < len(rows):
        size = ends[mine] - starts[mine]
        before = np.cumsum(size) - size
        places = places[np.repeat(starts[mine] - before, size) + np.arange(size.sum())]
        rows, starts, ends = rows[mine], before, before + size
    lot = max(1, (1 << 24) // max(1, table[0].nbytes if len(table) else 1))
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + lot, side="right")))
        part = how.reduceat(table[places[starts[at]:ends[to - 1]]], starts[at:to] - starts[at], axis=0)
        into[rows[at:to]] = how(into[rows[at:to]], part)
        at = to


# ---- rows, degrees, components -----------------------------------------------------------------------------------


def _ends(block: int, j: int, i: int, rows: np.ndarray, starts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of both ends of the edges of a piece."""
    return np.repeat(rows.astype(np.int64), np.diff(np.append(starts, len(places)))) + j * block, places.astype(np.int64) + i * block


def _over(cells: Cells, use: Callable, schema: str, half: bool = False) -> DataFrame:
    """use(j, i, rows, starts, places) for every piece (with `half` those that hold each edge once, or twice in a cell of one block)."""
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (j, i) in enumerate(zip(batch.column("j").to_pylist(), batch.column("i").to_pylist(), strict=True)):
                yield pa.RecordBatch.from_arrays(use(j, i, *_piece(*(batch.column(x)[at] for x in ("a", "b", "c")))), names=names)
    return (cells.pieces.where("j <= i") if half else cells.pieces).mapInArrow(work, schema)


def edge_rows(cells: Cells) -> DataFrame:
    """(src, dst): both directions of every edge as rows."""
    files, block, kind = cells.files, cells.block, dict(cells.nodes.dtypes)["id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = None
        for batch in batches:
            ids = files.ids() if ids is None else ids
            for at, (j, i) in enumerate(zip(batch.column("j").to_pylist(), batch.column("i").to_pylist(), strict=True)):
                a, b = _ends(block, j, i, *_piece(*(batch.column(x)[at] for x in ("a", "b", "c"))))
                for lo in range(0, len(a), 1 << 17):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(x[lo:lo + (1 << 17)])) for x in (a, b)], names=["src", "dst"])
    return cells.pieces.mapInArrow(work, f"src {kind}, dst {kind}")


def cell_degrees(cells: Cells) -> DataFrame:
    """(id, degree) of all nodes."""
    block = cells.block

    def use(j, i, rows, starts, places):
        return [pa.array(rows.astype(np.int64) + j * block), pa.array(np.diff(np.append(starts, len(places))).astype(np.int64))]
    counts = _over(cells, use, "_ix long, d long").groupBy("_ix").agg(F.sum("d").alias("degree"))
    return cells.nodes.join(counts, "_ix", "left").select("id", F.coalesce("degree", F.lit(0).cast("long")).alias("degree"))


def _joined(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the trees of u and v; every node points to the least node of its tree, before and after."""
    while True:
        a, b = parent[u], parent[v]
        far = a != b
        if not far.any():
            return
        u, v, a, b = u[far], v[far], a[far], b[far]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _stars(n: int, ends: Callable):
    """(u, v): every node of a task's edges with the least one that they lead it to; fewer rows than nodes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent = np.arange(n)
        for batch in batches:
            for u, v in ends(batch):
                _joined(parent, u, v)
        far = np.flatnonzero(parent != np.arange(n))
        for lo in range(0, len(far), 1 << 17):
            some = far[lo:lo + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(parent[some])], names=["u", "v"])
    return work


def component_links(cells: Cells) -> DataFrame:
    """(u, v), u > v: ids whose links lead to the same components as all edges, a few for each node."""
    block, n = cells.block, cells.n

    def of_pieces(batch):
        for at, (j, i) in enumerate(zip(batch.column("j").to_pylist(), batch.column("i").to_pylist(), strict=True)):
            yield _ends(block, j, i, *_piece(*(batch.column(x)[at] for x in ("a", "b", "c"))))

    def of_rows(batch):
        yield batch.column("u").to_numpy(), batch.column("v").to_numpy()
    found = cells.pieces.where("j <= i").mapInArrow(_stars(n, of_pieces), "u long, v long")
    found = found.repartition(4, F.floor(F.col("u") / block)).mapInArrow(_stars(n, of_rows), "u long, v long").distinct()
    low, high = (cells.nodes.select(F.col("id").alias(x), F.col("_ix").cast("long").alias(y)) for x, y in (("low", "v"), ("high", "u")))
    return found.join(low, "v").join(high, "u").select(F.col("high").alias("u"), F.col("low").alias("v"))


# ---- sums over neighbours ----------------------------------------------------------------------------------------


def neighbour_sums(cells: Cells, numbers: DataFrame) -> DataFrame:
    """(_ix, x): for every node with an edge the sum of x over its neighbours; numbers (_ix, x) are written once and read by the tasks."""
    n, block, span = cells.n, cells.block, _spans(cells.n, cells.block)
    files, uris = cells.files, stored(numbers.select("_ix", "x")).inputFiles()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = None
        for batch in batches:
            for j in batch.column(0).to_pylist():
                x = _numbers(uris, n) if x is None else x
                size = len(range(n)[span(j)])
                out, met = np.zeros(size), np.zeros(size, bool)
                for i, rows, starts, places in files.rows(j):
                    out[rows] += np.add.reduceat(x[span(i)][places], starts)
                    met[rows] = True
                some = np.flatnonzero(met)
                yield pa.RecordBatch.from_arrays([pa.array((some + j * block).astype(np.int32)), pa.array(out[some])], names=["_ix", "x"])
    spark = cells.nodes.sparkSession
    return spark.range(0, cells.blocks, 1, min(cells.blocks, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(work, "_ix int, x double")


# ---- neighbours in common ----------------------------------------------------------------------------------------


def _bits(pieces: list, block: int) -> np.ndarray:
    """One cell as bits, from its pieces."""
    wide = -(-block // 64) * 8
    flags = np.zeros(block * wide, np.uint8)
    for r, c in pieces:
        at = r.astype(np.int64) * wide + (c >> 3)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        flags[at[first]] |= np.bitwise_or.reduceat(np.left_shift(1, c & 7).astype(np.uint8), first)
    return flags.view(np.uint64).reshape(block, -1)


def _columns(rows: Iterator[tuple]) -> Iterator[tuple[int, list]]:
    """(i, pieces as (rows, places) of every edge) of a block of rows, one cell after the other."""
    for i, group in groupby(rows, lambda x: x[0]):
        yield i, [(np.repeat(a, np.diff(np.append(starts, len(c)))), c) for _, a, starts, c in group]


def _common(files: Files, block: int):
    """Per pair of blocks (p, q): for every node of p and of q, the neighbours it shares with its neighbours in the other block."""
    def pair(p: int, q: int) -> Iterator[pa.RecordBatch]:
        edges = next((held for i, held in _columns(files.rows(p)) if i == q), [])
        if not edges:
            return
        sums = np.zeros((2, block), np.int64)
        others = _columns(files.rows(q))
        k, held = next(others, (math.inf, []))
        for i, own in _columns(files.rows(p)):
            if p != q:
                while k < i:
                    k, held = next(others, (math.inf, []))
                if k > i:
                    continue
            left = _bits(own, block)
            right = left if p == q else _bits(held, block)
            step = max(1, (1 << 21) // left.shape[1])
            for r, c in edges:
                for at in range(0, len(r), step):
                    u, v = r[at:at + step], c[at:at + step]
                    n = np.bitwise_count(left[u] & right[v]).sum(axis=1, dtype=np.int64)
                    sums[0] += np.bincount(u, n, block).astype(np.int64)
                    if p != q:
                        sums[1] += np.bincount(v, n, block).astype(np.int64)
        for which, b in enumerate((p, q) if p != q else (p,)):
            some = np.flatnonzero(sums[which])
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(b * block + some, pa.int64()), pa.array(sums[which][some], pa.int64())], names=["_ix", "t"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, q in zip(batch.column("p").to_pylist(), batch.column("q").to_pylist(), strict=True):
                yield from pair(p, q)
    return work


def closed_pairs(cells: Cells) -> DataFrame:
    """(id, t): linked pairs of neighbours per node that has any; every pair counts once.

    For an edge (u, v), the neighbours that u and v share close a triangle. A task holds two blocks of nodes and reads their
    rows one column block at a time as bits.
    """
    spark, blocks = cells.nodes.sparkSession, cells.blocks
    tasks = max(1, min(blocks * (blocks + 1) // 2, 16 * spark.sparkContext.defaultParallelism))
    pairs = spark.range(blocks * blocks).select(F.expr(f"cast(id div {max(1, blocks)} as int)").alias("p"), (F.col("id") % max(1, blocks)).cast("int").alias("q"))
    dealt = pairs.where("p <= q").repartition(tasks)
    found = dealt.mapInArrow(_common(cells.files, cells.block), "_ix long, t long").groupBy("_ix").agg(F.sum("t").alias("t"))
    return cells.nodes.join(found, "_ix").select("id", F.expr("t div 2").alias("t"))


# ---- searches ----------------------------------------------------------------------------------------------------


def _batch_size(cells: Cells, sources: int, bytes_each: int, least: int, most: int | None) -> int:
    """Sources (or words of 64) of a batch: enough batches for all cores, and an array over all nodes within STATE."""
    cores = cells.nodes.sparkSession.sparkContext.defaultParallelism
    return max(1, min(STATE // max(1, bytes_each * cells.n), max(least, math.ceil(sources / (2 * cores))), most or sources, sources))


def _levels(cells: Cells, width: int):
    """search(places): from sources with the numbers `places`, a bit each in `width` words: (level, new bits of all nodes) one after the other."""
    n, span, blocks, files = cells.n, _spans(cells.n, cells.block), cells.blocks, cells.files

    def search(places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        front, new = np.zeros((n, width), np.uint64), np.zeros((n, width), np.uint64)
        s = np.arange(len(places))
        np.bitwise_or.at(front, (places, s // 64), np.uint64(1) << (s % 64).astype(np.uint64))
        all_ = np.zeros(width, np.uint64)
        np.bitwise_or.at(all_, s // 64, np.uint64(1) << (s % 64).astype(np.uint64))
        seen, level = front.copy(), 0
        while True:
            level += 1
            busy = [front[span(i)].any() for i in range(blocks)]
            for j in range(blocks):
                at = span(j)
                heard, wanted = np.zeros_like(seen[at]), (seen[at] != all_).any(axis=1)
                if wanted.any():
                    for i, rows, starts, c in files.rows(j):
                        if busy[i]:
                            _gathered(np.bitwise_or, front[span(i)], heard, wanted, rows, starts, c)
                new[at] = heard & ~seen[at]
                seen[at] |= heard
            if not new.any():
                return
            yield level, new
            front, new = new, front
    return search


def distance_sums(cells: Cells, words: int | None = None) -> DataFrame:
    """(id, reached, far, near): reached nodes, sum of distances and of inverse distances, over all other nodes.

    Every node holds one bit per source of the batch, and a step is a bitwise or over its neighbours. Distances are the same in
    both directions, so what is counted is how many nodes each source finds at every level: a row per node leaves the tasks.
    """
    n = cells.n
    if not n:
        return cells.nodes.select("id", F.lit(0).cast("long").alias("reached"), F.lit(0).cast("long").alias("far"), F.lit(0.0).alias("near"))
    width = _batch_size(cells, math.ceil(n / 64), 8, 1, words)
    batches = math.ceil(n / 64 / width)
    spark, search = cells.nodes.sparkSession, _levels(cells, width)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for number in batch.column(0).to_pylist():
                places = np.arange(number * 64 * width, min(n, (number + 1) * 64 * width))
                reached, far, near = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64), np.zeros(len(places))
                for level, new in search(places):
                    found = np.zeros(64 * width, np.int64)
                    lot = max(1, (1 << 22) // (64 * width))
                    for lo in range(0, n, lot):
                        found += np.unpackbits(new[lo:lo + lot].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                    found = found[:len(places)]
                    reached, far, near = reached + found, far + found * level, near + found * (1.0 / level)
                yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(reached), pa.array(far), pa.array(near)], names=["_ix", "reached", "far", "near"])
    rows = spark.range(0, batches, 1, batches).mapInArrow(work, "_ix int, reached long, far long, near double")
    return cells.nodes.join(rows, "_ix").select("id", "reached", "far", "near")


def _of_batch(cells: Cells, sources: DataFrame, width: int) -> DataFrame:
    """(batch, l): the numbers of up to `width` of the given nodes (id) in a row."""
    chosen = ranked(cells.nodes.join(sources.select("id"), "id", "left_semi"), ["_ix"], "_s")
    return chosen.groupBy(F.floor((F.col("_s") - 1) / width).cast("int").alias("batch")).agg(F.array_sort(F.collect_list("_ix")).alias("l"))


def levels(cells: Cells, sources: DataFrame, n_sources: int) -> DataFrame:
    """(source, id, distance) of the nodes that each of the given ones (id) reaches, itself left out."""
    kind, files = dict(cells.nodes.dtypes)["id"], cells.files
    width = _batch_size(cells, max(1, math.ceil(n_sources / 64)), 8, 1, None)
    search = _levels(cells, width)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = None
        for batch in rows:
            for l in batch.column("l"):  # noqa: E741
                ids = files.ids() if ids is None else ids
                places = l.values.to_numpy().astype(np.int64)
                own, lot = ids.take(pa.array(places)), max(1, (1 << 20) // (64 * width))
                for level, new in search(places):
                    for lo in range(0, len(new), lot):
                        at, s = np.nonzero(np.unpackbits(new[lo:lo + lot].view(np.uint8), axis=1, bitorder="little"))
                        if len(at):
                            yield pa.RecordBatch.from_arrays([own.take(pa.array(s)), ids.take(pa.array(at + lo)), pa.array(np.full(len(at), level, np.int32))], names=["source", "id", "distance"])
    return _of_batch(cells, sources, 64 * width).repartition(max(1, math.ceil(n_sources / 64 / width)), "batch").mapInArrow(work, f"source {kind}, id {kind}, distance int")


def path_shares(cells: Cells, sources: DataFrame, n_sources: int, batch: int | None = None) -> DataFrame:
    """(id, delta, square): for every node the sum, over the given sources (id), of its dependency and of its square.

    Path counts go forward level by level, dependencies backward; a source itself counts nothing for its own paths. A task
    goes through its batches one after the other and hands on their sums, so rows grow with the tasks, not with the sources.
    """
    n, span, blocks, files = cells.n, _spans(cells.n, cells.block), cells.blocks, cells.files
    if not n_sources:
        return cells.nodes.select("id", F.lit(0.0).alias("delta"), F.lit(0.0).alias("square"))
    width = _batch_size(cells, n_sources, 8, 8, batch)
    tasks = min(math.ceil(n_sources / width), 8 * cells.nodes.sparkSession.sparkContext.defaultParallelism)

    def summed(send: np.ndarray, busy: list, j: int, wanted: np.ndarray) -> np.ndarray:
        heard = np.zeros((len(wanted), send.shape[1]))
        if wanted.any():
            for i, rows, starts, c in files.rows(j):
                if busy[i]:
                    _gathered(np.add, send[span(i)], heard, wanted, rows, starts, c)
        return heard

    def shares(places: np.ndarray) -> np.ndarray:
        level, sigma, send = np.full((n, len(places)), -1, np.int32), np.zeros((n, len(places))), np.zeros((n, len(places)))
        level[places, np.arange(len(places))], sigma[places, np.arange(len(places))] = 0, 1.0
        depth, more = 0, True
        while more:
            depth, more = depth + 1, False
            for i in range(blocks):
                send[span(i)] = np.where(level[span(i)] == depth - 1, sigma[span(i)], 0.0)
            busy = [send[span(i)].any() for i in range(blocks)]
            for j in range(blocks):
                at = span(j)
                heard = summed(send, busy, j, (level[at] < 0).any(axis=1))
                new = (level[at] < 0) & (heard > 0)
                if new.any():
                    more = True
                    level[at] = np.where(new, np.int32(depth), level[at])
                    sigma[at] = np.where(new, heard, sigma[at])
        delta = np.zeros((n, len(places)))
        for d in range(depth - 1, 1, -1):               # the sources themselves take no part
            for i in range(blocks):
                at = span(i)
                here = level[at] == d
                send[at] = np.divide(1.0 + delta[at], sigma[at], out=np.zeros(here.shape), where=here)
            busy = [send[span(i)].any() for i in range(blocks)]
            for j in range(blocks):
                at = span(j)
                up = level[at] == d - 1
                delta[at] += np.where(up, sigma[at] * summed(send, busy, j, up.any(axis=1)), 0.0)
        return delta

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = None, None
        for row in rows:
            for l in row.column("l"):  # noqa: E741
                if total is None:
                    total, square = np.zeros(n), np.zeros(n)
                delta = shares(l.values.to_numpy().astype(np.int64))
                total += delta.sum(axis=1)
                square += np.einsum("ij,ij->i", delta, delta)
        if total is not None:
            some = np.flatnonzero(total)
            for lo in range(0, len(some), 1 << 17):
                part = some[lo:lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part]), pa.array(square[part])], names=["_ix", "delta", "square"])

    dealt = cut(_of_batch(cells, sources, width).select("l", (F.col("batch") % tasks).alias("_t"))).repartitionByRange(tasks, "_t")
    rows = dealt.select("l").mapInArrow(work, "_ix int, delta double, square double")
    total = rows.groupBy("_ix").agg(F.sum("delta").alias("delta"), F.sum("square").alias("square"))
    return cells.nodes.join(total, "_ix", "left").select("id", F.coalesce("delta", F.lit(0.0)).alias("delta"), F.coalesce("square", F.lit(0.0)).alias("square"))


# ---- sketches ----------------------------------------------------------------------------------------------------


def _estimate(m: int, zeros: int, rest: float) -> float:
    """Distinct values in m registers of which `zeros` are empty and the others have `rest` as the sum of 2 ** -value (Ertl 2017)."""
    x, y, power, before = zeros / m, 1.0, zeros / m, -1.0
    if zeros == m:
        return 0.0
    while power != before:
        x, before = x * x, power
        power, y = power + x * y, 2 * y
    return m * m / (2 * math.log(2)) / (m * power + rest)


def sketch_sums(cells: Cells, components: DataFrame, lg_k: int) -> DataFrame:
    """(id, reached, far, near) as estimated from 2 ** lg_k registers a node, whose greatest values go to all neighbours.

    A task holds some registers of all nodes and goes through all levels; how full they are is added up over the tasks, and
    the estimates are taken from that. Nodes of a component of a few hundred nodes have a register each, so these are counted.
    """
    n, m, span, blocks, files, spark = cells.n, 1 << lg_k, _spans(cells.n, cells.block), cells.blocks, cells.files, cells.nodes.sparkSession
    if not n:
        return cells.nodes.select("id", F.lit(0).cast("long").alias("reached"), F.lit(0.0).alias("far"), F.lit(0.0).alias("near"))
    width = max(1, min(STATE // n, math.ceil(m / (2 * spark.sparkContext.defaultParallelism))))
    of = cells.nodes.join(components, "id")
    small = cut(of.groupBy("component").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") <= max(1, 3 * m // 32)).select("component"))
    own = F.row_number().over(Window.partitionBy("component").orderBy("_ix")) - 1
    counted = of.join(small, "component").select("_ix", own.alias("slot"), F.lit(1).alias("value"), F.lit(True).alias("small"))
    spread, bits = F.xxhash64(F.col("id").cast("string")), 64 - lg_k
    zeros = F.length(F.regexp_extract(F.lpad(F.bin(F.shiftrightunsigned(spread, lg_k)), bits, "0"), "^0*", 0))
    hashed = of.join(small, "component", "left_anti").select("_ix", spread.bitwiseAND(F.lit(m - 1)).cast("int").alias("slot"), (zeros + 1).alias("value"), F.lit(False).alias("small"))
    first = stored(counted.unionByName(hashed))
    uris = first.inputFiles()

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for number in batch.column(0).to_pylist():
                low, wide = number * width, min(width, m - number * width)
                table = _table(uris)
                ix, slot, value = (table.column(x).to_numpy() for x in ("_ix", "slot", "value"))
                mine = (slot >= low) & (slot < low + wide)
                state, weight = np.zeros((n, wide), np.uint8), np.append(0.0, 0.5 ** np.arange(1, 256))
                state[ix[mine], slot[mine] - low] = value[mine]
                new, level, grew = state.copy(), 0, [state[span(i)].any() for i in range(blocks)]
                full = lambda x: (np.count_nonzero(x, axis=1), weight[x].sum(axis=1))
                lot = max(1, (1 << 21) // wide)
                while any(grew) or not level:
                    for j in range(blocks):
                        at = span(j)
                        heard = state[at].copy()
                        if level:
                            for i, a, starts, c in files.rows(j):
                                if grew[i]:
                                    _gathered(np.maximum, state[span(i)], heard, np.ones(len(heard), bool), a, starts, c)
                        new[at] = heard
                    before, grew = grew, [False] * blocks
                    for j in range(blocks):
                        at = span(j)
                        for lo in range(at.start, at.stop, lot):
                            part = slice(lo, min(at.stop, lo + lot))
                            changed = np.flatnonzero((new[part] != state[part]).any(axis=1)) if level else np.flatnonzero(new[part].any(axis=1))
                            if not len(changed):
                                continue
                            grew[j] = True
                            used, rest = full(new[part][changed])
                            if level:
                                was, less = full(state[part][changed])
                                used, rest = used - was, rest - less
                            yield pa.RecordBatch.from_arrays([pa.array((changed + lo).astype(np.int32)), pa.array(np.full(len(changed), level, np.int32)), pa.array(used.astype(np.int64)), pa.array(rest)],
                                                             names=["_ix", "level", "used", "rest"])
                    state, new, level = new, state, level + 1

    batches = math.ceil(m / width)
    steps = spark.range(0, batches, 1, batches).mapInArrow(work, "_ix int, level int, used long, rest double").groupBy("_ix", "level").agg(F.sum("used").alias("used"), F.sum("rest").alias("rest"))
    listed = steps.join(first.select("_ix", "small"), "_ix").groupBy("_ix", "small").agg(F.array_sort(F.collect_list(F.struct("level", "used", "rest"))).alias("l"))

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for ix, exact, l in zip(*(batch.column(x).to_pylist() for x in ("_ix", "small", "l")), strict=True):  # noqa: E741
                held, used, rest, far, near = 1, 0, 0.0, 0.0, 0.0
                for step in l:
                    used, rest = used + step["used"], rest + step["rest"]
                    more = max(0, (used if exact else round(_estimate(m, m - used, rest))) - held) if step["level"] else 0
                    if more:
                        held, far, near = held + more, far + step["level"] * more, near + more / step["level"]
                out.append((ix, held - 1, far, near))
            kinds = (pa.int32(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=["_ix", "reached", "far", "near"])
    found = listed.mapInArrow(sums, "_ix int, reached long, far double, near double")
    none = {"reached": F.lit(0).cast("long"), "far": F.lit(0.0), "near": F.lit(0.0)}
    return cells.nodes.join(found, "_ix", "left").select("id", *[F.coalesce(c, z).alias(c) for c, z in none.items()])


# ---- walks -------------------------------------------------------------------------------------------------------

_P1, _P2, _P3, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _hash_on(seen: np.ndarray, number: int) -> np.ndarray:
    """Spark's xxhash64 of one more int, from the hashes of the columns before it."""
    with np.errstate(over="ignore"):
        h = seen.view(np.uint64) + (_P5 + np.uint64(4))
        h ^= np.uint64(number & 0xFFFFFFFF) * _P1
        h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * _P2 + _P3
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def _nth(files: Files, block: int, size: Callable, at: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The neighbour with the given number, from 0, of every node in `at`."""
    order = np.argsort(at, kind="stable")
    out, parts = np.empty(len(at), np.int32), at[order] // block
    cuts = [*np.flatnonzero(np.diff(parts, prepend=-1)).tolist(), len(order)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        open_, j = order[lo:hi], int(parts[lo])
        row, left = at[open_] - j * block, number[open_].astype(np.int64)
        count, first = np.zeros(size(j), np.int64), np.zeros(size(j), np.int64)
        for i, rows, starts, places in files.rows(j):
            count[:], first[rows] = 0, starts
            count[rows] = np.diff(np.append(starts, len(places)))
            here = left < count[row]
            out[open_[here]] = places[first[row[here]] + left[here]] + i * block
            far = ~here
            left = (left - count[row])[far]
            open_, row = open_[far], row[far]
            if not len(open_):
                break
    return out


def even_walks(cells: Cells, length: int, walks: int, seed: int) -> DataFrame:
    """(walk, path): `walks` walks of `length` nodes from every node with an edge; every neighbour is as likely.

    A task holds the places of some walkers and reads the cells once a step; paths are dealt by walk when they are whole.
    """
    n, block, files, spark = cells.n, cells.block, cells.files, cells.nodes.sparkSession
    kind, span = dict(cells.nodes.dtypes)["id"], _spans(cells.n, cells.block)
    degree = stored(cells.nodes.join(cell_degrees(cells).where("degree > 0"), "id").select("_ix", "id", F.col("degree").cast("double").alias("x")))
    uris = degree.inputFiles()
    tasks = max(1, min(n, 2 * spark.sparkContext.defaultParallelism), math.ceil(n * walks / WALKERS))
    each = degree.repartition(tasks, "_ix").select("id", "_ix", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("_k"))
    starts = each.select(F.concat_ws("-", "id", "_k").alias("walk"), "_ix").select("walk", F.xxhash64("walk").alias("seen"), "_ix")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, around = [], None, None

        def walked() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            seen, at = (rows.column(x).to_numpy() for x in ("seen", "_ix"))
            path = np.empty((len(at), length), np.int32)
            path[:, 0] = at
            for step in range(1, length):
                number = np.mod(_hash_on(_hash_on(_hash_on(seen, step), 0), seed), around[at])
                at = _nth(files, block, lambda j: len(range(n)[span(j)]), at, number)
                path[:, step] = at
            names = rows.column("walk").combine_chunks()
            for lo in range(0, len(path), 1 << 14):
                some = path[lo:lo + (1 << 14)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, some.size + 1, length), pa.int32()), ids.take(pa.array(some.ravel())))
                yield pa.RecordBatch.from_arrays([names[lo:lo + len(some)], lists], names=["walk", "path"])

        waiting = 0
        for batch in batches:
            if ids is None:
                ids, around = files.ids(), _numbers(uris, n).astype(np.int64)
            if batch.num_rows:
                held.append(batch)
                waiting += batch.num_rows
            if waiting >= WALKERS:
                yield from walked()
                held, waiting = [], 0
        if held:
            yield from walked()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * walks / ENDED))
    return starts.mapInArrow(work, f"walk string, path array<{kind}>").repartition(parts, "walk")


def missing(cells: Cells, rows: DataFrame) -> DataFrame:
    """Those of the rows (src, dst, ...) that are no edge."""
    block, files = cells.block, cells.files

    def off(held: list[pa.RecordBatch], ids: pa.Array) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        u, v = (pc.fill_null(pc.index_in(table.column(x), value_set=ids), -1).to_numpy().astype(np.int64) for x in ("src", "dst"))
        known, sought = np.zeros(len(u), bool), np.flatnonzero((u >= 0) & (v >= 0))
        sought = sought[np.lexsort((v[sought], u[sought]))]
        parts = u[sought] // block
        cuts = [*np.flatnonzero(np.diff(parts, prepend=-1)).tolist(), len(sought)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            j, mine = int(parts[lo]), sought[lo:hi]
            for i, a, starts, c in files.rows(j):
                here = mine[v[mine] // block == i]
                if len(here):
                    code = np.repeat(a.astype(np.int64), np.diff(np.append(starts, len(c)))) * block + c
                    want = (u[here] - j * block) * block + v[here] - i * block
                    at = np.searchsorted(code, want).clip(max=len(code) - 1)
                    known[here] |= code[at] == want
        yield from table.filter(pa.array(~known)).to_batches()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, ids = [], 0, None
        for batch in batches:
            ids = files.ids() if ids is None else ids
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= HELD:
                yield from off(held, ids)
                held, n = [], 0
        if held:
            yield from off(held, ids)
    return rows.mapInArrow(work, rows.schema)
