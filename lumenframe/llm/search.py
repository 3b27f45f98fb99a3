"""Nearest neighbours of a stated query set by a block matrix join.

Vectors are packed into blocks. Every cell of the grid (strip of candidate blocks, panel of query blocks) is one group of
bounded size. In a cell each vector is rounded to int8 with a scale of its own; a tile product of the int8 blocks gives
all distances of the tile up to the two rounding errors, which are known exactly, so each distance has a lower and an
upper bound. Pairs whose lower bound is not above the k-th best upper bound survive, are recomputed from the original
vectors in double precision, and go into one heap per query. The k best of each cell are ranked over all cells.
Bounds are taken in units of a power of two that fits the rows compared, so that squares neither overflow nor vanish;
rows of very unlike size are compared apart, so that one huge vector does not blunt the bounds of the others.

The bounds never cut a true neighbour, so the result is exact for any data; poor rounding only lets more pairs survive.
Candidates move once per panel and queries once per strip.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without id; of rows with one id the least vector counts. Only vectors of the same length are compared. Ties go to the
smaller id; a distance beyond the largest double is infinite, and such candidates are returned like any other ties. With
fewer than k candidates all are returned; empty tables give an empty result. Wide vectors go in blocks of fewer rows
(`BLOCK_BYTES`). Extra columns are ignored.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import landed

ROWS = 2_048
STRIP_BLOCKS = 16
PANEL_BLOCKS = 4
BLOCK_BYTES = 4 << 20
EXACT_NUMBERS = 1 << 22
SPAN = 256                         # powers of two between the largest components of rows that share their units
UNSEEN = 2.0 ** -480               # lengths, in these units, that squares below the smallest double may hide
FARTHEST = 2.0 ** 512 * (1 - 1e-6)  # from here on a square may be infinite
INNER = 1_024                      # 127 * 127 * 1024 < 2^24: a float product of int8 numbers is exact so far


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(dim, ids, vectors) with up to `size` rows and about BLOCK_BYTES of one width in each block; rows are (id, vector)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim, parts):
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "ids": pa.array([np.concatenate([p[0] for p in parts]).tobytes()], pa.binary()),
                "vectors": pa.array([np.concatenate([p[1] for p in parts]).tobytes()], pa.binary())})

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"), batch.column(1)
            flat, widths = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8"), lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(widths) - widths
            for dim in np.unique(widths):
                at = np.flatnonzero(widths == dim)
                matrix = flat[starts[at][:, None] + np.arange(dim)[None, :]]
                most = max(1, min(size, BLOCK_BYTES // (8 * int(dim))))
                for i in range(0, len(at), most):
                    parts = held.setdefault(int(dim), [])
                    parts.append((ids[at[i:i + most]], matrix[i:i + most]))
                    if sum(len(p[0]) for p in parts) >= most:
                        yield block(int(dim), held.pop(int(dim)))
        for dim, parts in held.items():
            yield block(dim, parts)

    return rows.mapInArrow(pack, "dim int, ids binary, vectors binary")


def _by_size(x: np.ndarray) -> list[tuple[int, np.ndarray | slice]]:
    """Rows by the exponent of their largest component in steps of SPAN: (step, rows); nearly always one step."""
    step = np.frexp(np.abs(x).max(axis=1))[1] // SPAN
    found = np.unique(step).tolist()
    return [(found[0], slice(None))] if len(found) == 1 else [(v, np.flatnonzero(step == v)) for v in found]


def _quantised(x: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In units of 2 ** units: int8 rows, their scale, squared length after rounding, and the length of the rounding error."""
    x = np.ldexp(x, -units)
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale < 2.0 ** -960] = 1.0                 # rounds to zero: far below UNSEEN
    small = np.rint(x / scale[:, None]).astype(np.int8)
    back = small * scale[:, None]
    return small, scale, (back * back).sum(axis=1), np.sqrt(((x - back) ** 2).sum(axis=1))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], INNER):
        out += a[:, at:at + INNER].astype(np.float32) @ b[:, at:at + INNER].astype(np.float32).T
    return out


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added up in the order of the components; beyond the largest double it is infinite."""
    with np.errstate(over="ignore", under="ignore"):
        d = (a - b).T
        return np.sqrt((d * d).sum(axis=0)) if len(a) else np.zeros(0)


def _survivors(q_ids: np.ndarray, q: tuple, ids: np.ndarray, x: tuple, units: int, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the (query, candidate) pairs that may be among the k nearest, from quantised rows in the same units."""
    (qs, q_scale, q_norm, q_err), (xs, x_scale, x_norm, x_err) = q, x
    square = q_norm[:, None] + x_norm[None, :] - 2.0 * q_scale[:, None] * x_scale[None, :] * _product(qs, xs)
    about = np.sqrt(np.maximum(square, 0.0))
    with np.errstate(over="ignore", under="ignore"):
        # squares of the original numbers vanish below 2 ** -537 and are infinite beyond FARTHEST
        lost = UNSEEN + np.ldexp(np.sqrt(qs.shape[1]) * 2.0 ** -537, -units)
        kth, farthest = np.ldexp(kth, -units), np.ldexp(FARTHEST, -units)
    slack = q_err[:, None] + x_err[None, :] + 1e-6 * (np.sqrt(q_norm)[:, None] + np.sqrt(x_norm)[None, :]) + lost
    own = q_ids[:, None] == ids[None, :]
    upper = np.where(own, np.inf, about + slack)
    limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(q_ids), np.inf)
    limit = np.where(limit >= farthest, np.inf, limit)
    return np.nonzero((about - slack <= np.minimum(limit, kth)[:, None]) & ~own)


def search_cell(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
    """The k nearest (distance, id) of every query among the candidates of some blocks."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    q_parts, q_small = _by_size(q), {}
    pairs = max(1, EXACT_NUMBERS // q.shape[1])
    for ids, x in blocks:
        for x_step, x_at in _by_size(x):
            part_ids, part, x_small = ids[x_at], x[x_at], {}
            for q_step, q_at in q_parts:
                units = (max(q_step, x_step) + 1) * SPAN
                if (q_step, units) not in q_small:
                    q_small[q_step, units] = _quantised(q[q_at], units)
                if units not in x_small:
                    x_small[units] = _quantised(part, units)
                numbers = np.arange(len(q))[q_at]
                kth = np.array([-heaps[i][0][0] if len(heaps[i]) == k else np.inf for i in numbers.tolist()])
                qi, xi = _survivors(q_ids[q_at], q_small[q_step, units], part_ids, x_small[units], units, kth, k)
                for at in range(0, len(qi), pairs):
                    a, b = numbers[qi[at:at + pairs]], xi[at:at + pairs]
                    for i, d, v in zip(a.tolist(), exact_distance(q[a], part[b]).tolist(), part_ids[b].tolist(), strict=True):
                        h = heaps[i]
                        if len(h) < k:
                            heapq.heappush(h, (-d, -v))
                        elif (-d, -v) > h[0]:
                            heapq.heapreplace(h, (-d, -v))
    return [sorted((-d, -v) for d, v in h) for h in heaps]


def nearest_of(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows (Euclidean) of every row for which `is_query` holds."""
    plain = rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    one = plain.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(vector_col).alias("vector"), F.max(is_query.cast("int")).alias("ask"))
    one = landed(one, "search-rows")
    candidates = landed(packed(one.select("vec_id", "vector"), block).withColumn("no", F.monotonically_increasing_id()), "search-candidates")
    queries = landed(packed(one.where("ask = 1").select("vec_id", "vector").coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism)), block)
                     .withColumn("no", F.monotonically_increasing_id()), "search-queries")
    n_strips = max(1, -(-candidates.count() // STRIP_BLOCKS))
    n_panels = max(1, -(-queries.count() // PANEL_BLOCKS))
    lot = lambda n: F.pmod(F.xxhash64("no"), F.lit(n)).cast("int")
    left = candidates.withColumn("strip", lot(n_strips)).withColumn("panel", F.explode(F.sequence(F.lit(0), F.lit(n_panels - 1))))
    right = queries.withColumn("panel", lot(n_panels)).withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(n_strips - 1))))

    def cell(cand: pa.Table, ask: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        blocks = [(np.frombuffer(i, "<i8"), np.frombuffer(v, "<f8").reshape(-1, d))
                  for i, v, d in zip(cand["ids"].to_pylist(), cand["vectors"].to_pylist(), cand["dim"].to_pylist(), strict=True)]
        for i, v, d in zip(ask["ids"].to_pylist(), ask["vectors"].to_pylist(), ask["dim"].to_pylist(), strict=True):
            ids = np.frombuffer(i, "<i8")
            for q, near in zip(ids.tolist(), search_cell(ids, np.frombuffer(v, "<f8").reshape(-1, d), blocks, k), strict=True):
                found["query_id"] += [q] * len(near)
                found["vec_id"] += [x for _, x in near]
                found["score"] += [s for s, _ in near]
        return pa.table({"query_id": pa.array(found["query_id"], pa.int64()), "vec_id": pa.array(found["vec_id"], pa.int64()),
                         "score": pa.array(found["score"], pa.float64())})

    key = ["dim", "strip", "panel"]
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(cell, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
