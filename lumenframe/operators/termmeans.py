"""K-means over packed rows of terms: centres are sums of rows, so they never stand whole on the driver.

A round sends every row's share in its centre to the columns and gets back its products with all centres (operators.svd.spanned).
Distances, the lengths of the centres and how far they moved follow from these products.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import cut
from lumenframe.operators.svd import _Rows, _array, _tree, spanned
from lumenframe.operators.terms import TermRows, top_words


@dataclass
class TermMeans:
    """Fitted clusters: (block, y), the share of each row in each centre, the rows and the inertia after each round."""
    shares: DataFrame
    rows: TermRows
    k: int
    costs: list[float]

    def top_terms(self, n: int) -> DataFrame:
        """(cluster, term, weight): heaviest terms of each centre."""
        return top_words(self.rows, self.shares, self.k, n)


def _squares(rows: TermRows) -> DataFrame:
    """(block, s): squared lengths of the rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = _Rows(batch, i)
                s = np.bincount(np.repeat(np.arange(one.n), np.diff(one.starts)), weights=one.numbers ** 2, minlength=one.n)
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([s.astype("<f8").tobytes()], pa.binary())], names=["block", "s"])
    return cut(rows.blocks.mapInArrow(work, "block long, s binary"))


def _mapped(df: DataFrame, make, out: str = "y") -> DataFrame:
    """(block, out) with the array that make(batch, row) gives."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([make(batch, i).astype("<f8").tobytes()], pa.binary())], names=["block", out])
    return df.mapInArrow(work, f"block long, {out} binary")


def _drawn(df: DataFrame, seed: int, turn: int, weight) -> tuple[int, int] | None:
    """(block, row) of one row drawn with the given weights: the least of exponential times over weights."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, w = batch.column("block")[i].as_py(), weight(batch, i)
                with np.errstate(divide="ignore"):
                    time = np.where(w > 0, np.random.default_rng([seed, turn, block]).exponential(size=len(w)) / np.where(w > 0, w, 1.0), np.inf)
                at = int(time.argmin()) if len(time) else 0
                if len(time) and np.isfinite(time[at]):
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([at]), pa.array([float(time[at])])], names=["block", "at", "time"])
    first = df.mapInArrow(work, "block long, at long, time double").orderBy("time", "block").first()
    return first and (first["block"], first["at"])


def term_kmeans(rows: TermRows, k: int, max_iter: int = 100, seed: int = 1, tol: float = 1e-4) -> TermMeans:
    """k clusters, from k rows drawn far apart (k-means++); rounds end when no centre moves by more than tol."""
    squares = _squares(rows)
    get = lambda batch, i, name, width=None: _array(batch.column(name)[i], "<f8", width)

    near, chosen = squares.select("block", "s", F.lit(None).cast("binary").alias("d")), []
    for turn in range(k):
        at = _drawn(near, seed, turn, lambda batch, i: get(batch, i, "d") if batch.column("d")[i].is_valid else np.ones(len(get(batch, i, "s"))))
        if at is None:
            break                                   # fewer different rows than clusters
        chosen.append(at)
        if turn == k - 1:
            break
        one = _mapped(squares, lambda batch, i, at=at: (np.arange(len(get(batch, i, "s"))) == at[1]) * float(batch.column("block")[i].as_py() == at[0]))
        product = cut(spanned(rows.blocks, one, 1).join(near, "block"))
        length = float(_tree(product, lambda batch, i: np.array([[get(batch, i, "y") @ get(batch, i, "w")]]))[0, 0])

        def nearer(batch, i, length=length):
            s = get(batch, i, "s")
            gap = s + length - 2 * get(batch, i, "w")
            gap = np.where(gap > 1e-6 * (s + length), gap, 0.0)          # products travel in single precision
            return np.minimum(gap, get(batch, i, "d")) if batch.column("d")[i].is_valid else gap
        near = cut(squares.join(_mapped(product, nearer, "d"), "block"))
    if not chosen:
        raise ValueError("no rows")
    k = len(chosen)

    def first(batch, i):
        block, y = batch.column("block")[i].as_py(), np.zeros((len(get(batch, i, "s")), k))
        for j, (b, at) in enumerate(chosen):
            if b == block:
                y[at, j] = 1.0
        return y

    shares, costs, last = cut(_mapped(squares, first)), [], None
    for _ in range(max_iter):
        now = cut(spanned(rows.blocks, shares, k).join(squares, "block"))
        length = _tree(now, lambda batch, i: (get(batch, i, "y", k) * get(batch, i, "w", k)).sum(axis=0, keepdims=True))[0]
        # |new - old|^2 = |new|^2 - |old|^2 - 2 old (new - old); the products are good to about 1e-7
        if last is not None and (length - last <= np.maximum(tol ** 2, 1e-7 * length)).all():
            break

        def placed(batch, i, length=length):
            gaps = length - 2 * get(batch, i, "w", k)
            return gaps.argmin(axis=1), gaps.min(axis=1) + get(batch, i, "s")

        def counted(batch, i, placed=placed):
            at, gap = placed(batch, i)
            return np.vstack([np.bincount(at, minlength=k), np.full(k, gap.sum())])
        counts, total = _tree(now, counted)
        costs.append(float(total[0]))

        def moved(batch, i, placed=placed, counts=counts):
            at, old = placed(batch, i)[0], get(batch, i, "y", k)
            return np.where(counts > 0, (at[:, None] == np.arange(k)) / np.maximum(counts, 1), old)            # a centre without rows stays
        fresh = cut(_mapped(now, moved))
        both = now.select("block", F.col("y").alias("old"), "w").join(fresh, "block")
        cross = _tree(both, lambda batch, i: ((get(batch, i, "y", k) - get(batch, i, "old", k)) * get(batch, i, "w", k)).sum(axis=0, keepdims=True))[0]
        shares, last = fresh, length + 2 * cross
    return TermMeans(shares, rows, k, costs)
