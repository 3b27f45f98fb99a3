"""Distances, exact nearest neighbours and similarity joins.

Exact neighbour search works on blocks. A bounded set of pivot rows cuts space into cells. For each cell the largest
distance of its rows to the pivot and an upper bound for the k-th neighbour distance are known, so by the triangle
inequality a candidate is sent only to cells where it can still be a neighbour. Cells are cut into blocks by a hash of
the key, so a cell that holds a large share of all rows (or many copies of one row) is spread over many tasks. A task
sees one block against one block as numpy matrices and keeps the k best per row; pairs are never emitted beyond that.
Products run tile by tile in single precision with an error bound: what they cannot rule out is measured in double
precision. A task holds two blocks and one tile, and hands on its results as it finds them.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import pair_with_small, salted_join
from lumenframe.functions.ordering import cut
from lumenframe.operators.aggregate import class_mean_vectors
from lumenframe.operators.linear import dot
from lumenframe.operators.order import top_k_per_group

BLOCK_BYTES = 16 << 20        # coordinates of one block
MAX_PIVOTS = 256
SLACK = 1e-9
TILE = (512, 2_048)           # rows and columns of one product
COPIES = 16_384               # rows handed on at a time


def as_double(vec) -> Column:
    return F.transform(F.col(vec) if isinstance(vec, str) else vec, lambda v: v.cast("double"))


def vector_distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    gap = F.zip_with(a, b, lambda x, y: x - y)
    return F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g))


def vector_angle(a: Column, b: Column) -> Column:
    """Angle in radians; the cosine is clamped to [-1, 1]."""
    cosine = F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def pairwise_distances(x: DataFrame, y: DataFrame, x_key: str, y_key: str, vec: str, limit: int = 10_000) -> DataFrame:
    """(i, j, distance) against a small table y, whose size is checked."""
    left = x.select(F.col(x_key).alias("i"), as_double(vec).alias("_a"))
    right = y.select(F.col(y_key).alias("j"), as_double(vec).alias("_b"))
    return pair_with_small(left, right, limit).select("i", "j", vector_distance(F.col("_a"), F.col("_b")).alias("distance"))


def class_distance_matrix(df: DataFrame, vec: str, label: str, limit: int = 10_000) -> DataFrame:
    """Distance and angle between the mean vectors of all classes."""
    means = class_mean_vectors(df, vec, label).groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda s: s["mean"]).alias("_m"))
    means = cut(means)
    other = means.select(F.col(label).alias("other"), F.col("_m").alias("_o"))
    return pair_with_small(means, other, limit).select(
        label, "other", vector_distance(F.col("_m"), F.col("_o")).alias("distance"),
        vector_angle(F.col("_m"), F.col("_o")).alias("angle"))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.zeros((0, 0))


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of a to all rows of b; near-equal rows are measured again without cancellation."""
    sa, sb = (a * a).sum(1), (b * b).sum(1)
    size = sa[:, None] + sb[None, :]
    sq = np.maximum(size - 2 * (a @ b.T), 0.0)
    i, j = np.nonzero(sq <= 1e-7 * size)
    for lo in range(0, len(i), 65_536):
        at = slice(lo, lo + 65_536)
        sq[i[at], j[at]] = ((a[i[at]] - b[j[at]]) ** 2).sum(1)
    return np.sqrt(sq)


def _block_rows(df: DataFrame) -> int:
    """Rows per block for the width of the vectors: fewer, larger blocks mean fewer copies of each row."""
    width = df.select(F.size("v")).first()
    return max(512, min(16_384, BLOCK_BYTES // (8 * max(1, width[0] if width else 1))))


def _exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the given pairs, rounded to nine digits as they are compared."""
    out = np.empty(len(i))
    for lo in range(0, len(i), 65_536):
        at = slice(lo, lo + 65_536)
        out[at] = ((a[i[at]] - b[j[at]]) ** 2).sum(1)
    return np.round(np.sqrt(out), 9)


def _best(points: np.ndarray, targets: np.ndarray, k: int, barred=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k targets closest to each point, ties to the earlier target: (points, targets, distances) a lot of points at a time.

    `barred(rows)` gives pairs that do not count, as numbers of rows and columns. Distances that are not finite never count.
    """
    sa, sb = (points * points).sum(1), (targets * targets).sum(1)
    sizes = np.concatenate((sa, sb))
    sizes = sizes[np.isfinite(sizes)]
    top = sizes.max() if len(sizes) else 0.0
    kind = np.float32 if 1e-24 < top < 1e30 else np.float64
    loss = (points.shape[1] + 16) * 2 * float(np.finfo(kind).eps)             # of a squared distance, as a share of both squared lengths
    least = np.float64(np.finfo(kind).tiny) * 4 * (points.shape[1] + 16)      # and what is too small to be told from zero
    left, right = (-2 * points).astype(kind), np.ascontiguousarray(targets.T.astype(kind))
    low_b = ((1 - loss) * sb - least).astype(kind)
    low_b = np.minimum(low_b, np.nextafter(low_b, kind(-np.inf)))
    for lo in range(0, len(points), TILE[0]):
        own = slice(lo, min(lo + TILE[0], len(points)))
        out = barred(own) if barred else None
        n = own.stop - lo
        held, limit = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(n, np.inf)
        fresh, waiting = [], 0
        for c in range(0, len(targets), TILE[1]):
            low = left[own] @ right[:, c:c + TILE[1]]
            low += low_b[c:c + TILE[1]]                                       # below the squared distance less that of the point
            if out is not None:
                here = (out[1] >= c) & (out[1] < c + TILE[1])
                low[out[0][here], out[1][here] - c] = np.inf
            if c == 0 and low.shape[1] > 8 * k:                               # a first bound from the k that look nearest
                some = low[:, :max(256, 8 * k)]
                near = np.argpartition(some, k - 1, axis=1)[:, :k]
                gaps = _exact(points[own], targets, np.repeat(np.arange(n), k), near.ravel()).reshape(n, k)
                gaps[~np.isfinite(np.take_along_axis(some, near, 1))] = np.inf
                limit = _bound(gaps.max(1), sa[own], loss, least)
            i, j = np.nonzero(low <= limit.astype(kind)[:, None])
            fresh.append((i, j + c))
            waiting += len(i)
            if waiting > 16 * k * n or c + TILE[1] >= len(targets):
                held, limit = _merged(points[own], targets, k, held, fresh, out, sa[own], loss, least)
                fresh, waiting = [], 0
        yield held[0] + lo, held[1], held[2]


def _bound(gaps: np.ndarray, sa: np.ndarray, loss: float, least: float) -> np.ndarray:
    """What a lower bound must not exceed for its pair to matter, when the k-th distance so far is `gaps`."""
    limit = (gaps + 4 * SLACK) ** 2 * (1 + 1e-12) - (1 - loss) * sa + least
    limit = np.where(np.isfinite(gaps) & np.isfinite(sa), limit + 2.4e-7 * (np.abs(limit) + sa), np.inf)
    return np.where(np.isnan(sa), -np.inf, limit)


def _merged(points: np.ndarray, targets: np.ndarray, k: int, held: tuple, fresh: list, out, sa: np.ndarray, loss: float, least: float) -> tuple:
    """The k best per point of those held and those found since, and the new bounds."""
    i, j = (np.concatenate([f[s] for f in fresh]) for s in (0, 1))
    if out is not None and len(out[0]):
        free = ~np.isin(i * len(targets) + j, out[0] * len(targets) + out[1])
        i, j = i[free], j[free]
    gaps = _exact(points, targets, i, j)
    fine = np.isfinite(gaps)
    i, j, gaps = (np.concatenate((h, f[fine])) for h, f in zip(held, (i, j, gaps), strict=True))
    order = np.lexsort((j, gaps, i))
    i, j, gaps = i[order], j[order], gaps[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    last = np.full(len(points), np.inf)
    last[i[place == k - 1]] = gaps[place == k - 1]
    kept, limit = place < k, _bound(last, sa, loss, least)
    limit[last == 0] = -np.inf                                                # a later target could only tie
    return (i[kept], j[kept], gaps[kept]), limit


def _pivots(df: DataFrame, key: str, vec: str, count: int) -> np.ndarray:
    rows = df.orderBy(F.xxhash64(key), key).limit(count).select(vec).collect()
    return np.unique(np.array([r[0] for r in rows], dtype=np.float64), axis=0)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as a matrix; missing components are not numbers."""
    lists = batch.column("v")
    widths = pc.unique(pc.list_value_length(lists)).to_pylist()
    if None in widths or len(widths) > 1:
        raise ValueError("vectors must be given and of one length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(batch.num_rows, widths[0] if widths else 0)


def _with_cell(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    key_type = dict(df.dtypes)["id"]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gaps = _gaps(_matrix(b["v"]), pivots)
            cell = gaps.argmin(1)
            yield pd.DataFrame({"id": b["id"], "v": b["v"], "cell": cell.astype("int32"), "gap": gaps[np.arange(len(b)), cell]})
    return df.mapInPandas(assign, f"id {key_type}, v array<double>, cell int, gap double")


def _reach(pivots: np.ndarray, radius: dict, near: dict, k: int) -> dict[int, float]:
    """Upper bound of the k-th neighbour distance for the rows of each cell."""
    between = _gaps(pivots, pivots)
    bounds = {}
    for cell, r in radius.items():
        options = sorted(r + between[cell, other] + g for other, gaps in near.items() for g in gaps)
        bounds[cell] = options[k - 1] if len(options) >= k else math.inf
    return bounds


def _block_join(left: DataFrame, right: DataFrame, pivots: np.ndarray, reach: dict[int, float], radius: dict[int, float],
                sizes: dict[int, int], match, schema: str, block: int) -> DataFrame:
    """Send right rows to every left cell they can matter to and run `match` per pair of blocks.

    The rows sent are counted per cell, and the left rows of a cell are copied once per block of those, so copies follow
    the candidates that pruning leaves, not the size of the right side.
    """
    key_type = dict(left.dtypes)["id"]
    left_parts = {c: max(1, math.ceil(n / block)) for c, n in sizes.items()}
    cells = np.array(sorted(radius), dtype="int64")
    limit = np.array([radius[c] + reach[c] for c in cells])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2_048):
                b = whole.slice(lo, 2_048)
                i, j = np.nonzero(_gaps(_vectors(b), pivots[cells]) <= limit * (1 + SLACK) + SLACK)
                for at in range(0, len(i), COPIES):
                    rows = b.take(pa.array(i[at:at + COPIES]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cells[j[at:at + COPIES]].astype("int32"))], names=["id", "v", "cell"])

    b = cut(right.select("id", "v").mapInArrow(send, f"id {key_type}, v array<double>, cell int"))
    sent = {r["cell"]: r["n"] for r in b.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}      # one row per cell
    right_parts = {c: max(1, math.ceil(sent.get(c, 0) / block)) for c in sizes}
    of_cell = lambda parts: F.element_at(F.create_map(*[F.lit(x) for c, n in parts.items() for x in (c, n)]), F.col("cell"))
    numbers = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), (of_cell(parts) - 1).cast("bigint")))
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    a = left.select("id", "v", "cell", F.pmod(own, of_cell(left_parts)).cast("bigint").alias("lb")).withColumn("rb", numbers(right_parts))
    b = b.withColumn("rb", F.pmod(own, of_cell(right_parts)).cast("bigint")).withColumn("lb", numbers(left_parts))
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both blocks are read, then pairs are handed on as they are found."""
        held = [x for x in batches if x.num_rows]
        sides = []
        for wanted in (True, False):
            rows = [x.filter(x.column("asks") if wanted else pc.invert(x.column("asks"))) for x in held]
            points = [_vectors(x) for x in rows if x.num_rows]
            sides.append((pa.concat_arrays([x.column("id") for x in rows]), np.concatenate(points) if points else np.zeros((0, 0))))
        del held, rows
        (ids, points), (others, targets) = sides
        if len(ids) and len(others):
            for i, j, value in match(ids, points, others, targets):
                for at in range(0, len(i), 1 << 18):
                    some = slice(at, at + (1 << 18))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(i[some])), others.take(pa.array(j[some])), pa.array(value[some])], names=names)

    both = a.select("cell", "lb", "rb", F.lit(True).alias("asks"), "id", "v").unionByName(b.select("cell", "lb", "rb", F.lit(False).alias("asks"), "id", "v"))
    return both.groupBy("cell", "lb", "rb").applyInArrow(run, schema)


def _keyed(df: DataFrame, key: str, vec: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), as_double(vec).alias("v"))


def _cell_stats(df: DataFrame) -> tuple[dict, dict]:
    rows = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("r")).collect()
    return {r["cell"]: r["n"] for r in rows}, {r["cell"]: r["r"] for r in rows}


def nearest(x: DataFrame, y: DataFrame, key: str, vec: str, k: int, exclude_self: bool = False,
            pivots: int | None = None, block: int | None = None) -> DataFrame:
    """The k rows of y closest to each row of x: (id, other, distance, rank). Exact; ties go to the smaller key."""
    left, right = _keyed(x, key, vec), _keyed(y, key, vec)
    n_right = right.count()
    block = block or _block_rows(right)
    if n_right == 0:
        raise ValueError("no rows to search in")
    centre = _pivots(right, "id", "v", pivots or min(MAX_PIVOTS, max(1, math.ceil(n_right / block))))
    left, right = cut(_with_cell(left, centre)), cut(_with_cell(right, centre))
    sizes, radius = _cell_stats(left)
    want = k + 1 if exclude_self else k
    near: dict[int, list[float]] = {}
    for r in top_k_per_group(right.select("cell", "gap"), ["cell"], ["gap"], want).collect():   # pivots x k rows
        near.setdefault(r["cell"], []).append(r["gap"])
    reach = _reach(centre, radius, near, want)
    key_type = dict(left.dtypes)["id"]

    def best(ids: pa.Array, points: np.ndarray, others: pa.Array, targets: np.ndarray) -> Iterator[tuple]:
        order = pc.sort_indices(others).to_numpy()
        targets = targets[order]     # by key, so that ties go to the smaller one
        barred = None
        if exclude_self:
            asked, listed = (x.to_pandas(integer_object_nulls=True) for x in (ids, others.take(pa.array(order))))
            known = (asked.isin(listed) & asked.notna()).to_numpy()

            def barred(own: slice) -> tuple[np.ndarray, np.ndarray]:
                rows = np.flatnonzero(known[own])
                i, j = np.nonzero(asked.to_numpy()[own][rows][:, None] == listed.to_numpy()[None, :])
                return rows[i], j
        for i, j, gaps in _best(points, targets, k, barred):
            yield i, order[j], gaps

    found = _block_join(left, right, centre, reach, radius, sizes, best,
                        f"id {key_type}, other {key_type}, distance double", block)
    return top_k_per_group(found, ["id"], ["distance", "other"], k)


def nearest_lsh(x: DataFrame, y: DataFrame, key: str, vec: str, radius: float, bucket: float, tables: int = 3,
                seed: int = 1) -> DataFrame:
    """Approximate neighbours within a radius by random projections, for tables where exact search costs too much."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    prep = lambda t: t.select(key, array_to_vector(as_double(vec)).alias("_x"))
    model = BucketedRandomProjectionLSH(inputCol="_x", outputCol="_h", bucketLength=bucket, numHashTables=tables,
                                        seed=seed).fit(prep(y))
    found = model.approxSimilarityJoin(prep(x), prep(y), radius, "distance")
    return found.select(F.col(f"datasetA.{key}").alias("id"), F.col(f"datasetB.{key}").alias("other"), "distance")


def knn_classify(train: DataFrame, test: DataFrame, key: str, vec: str, label: str, k: int, **options) -> DataFrame:
    """Majority label of the k nearest training rows; the smallest label on ties."""
    found = nearest(test, train, key, vec, k, **options).select("id", "other")
    votes = salted_join(found, train.select(F.col(key).alias("other"), F.col(label).alias("predicted")), "other", "inner")
    counted = votes.groupBy("id", "predicted").agg(F.count(F.lit(1)).alias("votes"))
    return top_k_per_group(counted, ["id"], ["-votes", "predicted"], 1).drop("rank")


def similar_pairs(x: DataFrame, key: str, vec: str, min_cosine: float, pivots: int | None = None,
                  block: int | None = None) -> DataFrame:
    """All unordered pairs with a cosine above the limit: (src, dst, cosine), src < dst. Zero vectors have no pairs."""
    rows = _keyed(x, key, vec)
    length = F.sqrt(dot(F.col("v"), F.col("v")))
    unit = rows.withColumn("_n", length).where("_n > 0").select("id", F.transform("v", lambda e: e / F.col("_n")).alias("v"))
    n = unit.count()
    block = block or _block_rows(unit)
    key_type = dict(unit.dtypes)["id"]
    schema = f"src {key_type}, dst {key_type}, cosine double"
    if n == 0:
        return x.sparkSession.createDataFrame([], schema)
    centre = _pivots(unit, "id", "v", pivots or min(MAX_PIVOTS, max(1, math.ceil(n / block))))
    cells = cut(_with_cell(unit, centre))
    sizes, radius = _cell_stats(cells)
    far = math.sqrt(max(0.0, 2 - 2 * min_cosine))

    def close(ids: pa.Array, points: np.ndarray, others: pa.Array, targets: np.ndarray) -> Iterator[tuple]:
        own, other = ids.to_numpy(zero_copy_only=False), others.to_numpy(zero_copy_only=False)
        for lo in range(0, len(own), TILE[0]):
            at = slice(lo, lo + TILE[0])
            for c in range(0, len(other), TILE[1]):
                cosine = points[at] @ targets[c:c + TILE[1]].T
                i, j = np.nonzero(cosine > min_cosine)
                first = own[at][i] < other[c + j]
                i, j = i[first], j[first]
                yield i + lo, j + c, cosine[i, j]

    return _block_join(cells, cells, centre, {c: far for c in radius}, radius, sizes, close, schema, block)
