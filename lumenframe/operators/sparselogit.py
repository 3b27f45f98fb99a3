"""Logistic regression over any number of terms, for one model or many at once.

Rows are packed in blocks (operators.terms). With an l2 penalty the weights are a sum of rows, so all work is done with
numbers per row: a round multiplies the gradient by A A^T, one exchange of columns (operators.svd.spanned) for all models
together, and the loss is then minimised over the span of all gradients so far by Newton steps, whose sums are small
matrices. Only these reach the driver; weights are made once, as a table of terms. Rounds end when the gradient is small
against the weights or the loss stops falling.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import hot_keys, salted_join
from lumenframe.functions.ordering import cut
from lumenframe.operators.svd import _array, _tree, column_sums, spanned
from lumenframe.operators.terms import TermRows, column_cells, term_rows

SETTLED = 1e-9                # part of the loss; a smaller fall ends the rounds
INNER = 4                     # Newton steps of a round


@dataclass
class SparseLogit:
    """Weights (term, weight), the intercept, and the loss after each round."""
    weights: DataFrame
    intercept: float
    losses: list[float]
    hot: list

    def predict(self, entries: DataFrame, keys: DataFrame) -> DataFrame:
        """(key, probability) for all keys; unknown terms count nothing."""
        sums = _row_sums(entries, self.weights.withColumnRenamed("weight", "step"), self.hot)
        return keys.select("key").join(sums, "key", "left").select("key", _chance(F.coalesce("sum", F.lit(0.0)) + self.intercept).alias("probability"))


def _chance(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def _row_sums(entries: DataFrame, step: DataFrame, hot: list) -> DataFrame:
    return salted_join(entries, step, "term", "inner", hot=hot).groupBy("key").agg(F.sum(F.col("value") * F.col("step")).alias("sum"))


class RowFit:
    """Fitted models: `width` of them, as sums of rows (state, factors) with intercepts; `losses` per round, for each model."""

    def __init__(self, state: DataFrame, factors: np.ndarray, intercepts: np.ndarray, losses: list[np.ndarray]) -> None:
        self.state, self.factors, self.intercepts, self.losses = state, factors, intercepts, losses
        self.width = len(intercepts)

    def margins(self) -> DataFrame:
        """(block, y): scores of all rows, in log odds."""
        return _combined(self.state, "kv", self.factors, self.intercepts)

    def weights(self, rows: TermRows) -> DataFrame:
        """(id, cluster, weight) per term and model."""
        return column_cells(column_sums(rows.blocks, _combined(self.state, "v", self.factors, np.zeros(self.width)), self.width), self.width)


def _stack(batch: pa.RecordBatch, i: int, name: str, m: int, t: int) -> np.ndarray:
    """The vectors so far: (t, rows, models)."""
    return _array(batch.column(name)[i], "<f4").reshape(t, -1, m) if t else np.zeros((0, batch.column("n")[i].as_py(), m), np.float32)


def _mixed(stack: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return np.einsum("tnm,mt->nm", stack, factors, optimize=True)


def _combined(state: DataFrame, name: str, factors: np.ndarray, plus: np.ndarray) -> DataFrame:
    m, t = factors.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y = _mixed(_stack(batch, i, name, m, t), factors) + plus
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([y.astype("<f8").tobytes()], pa.binary())], names=["block", "y"])
    return state.mapInArrow(work, "block long, y binary")


def _odds(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit_rows(blocks: DataFrame, marks: DataFrame, penalty: np.ndarray, tol: float, rounds: int, pick: np.ndarray | None = None) -> RowFit:
    """Minimise, per model, the sum of share * log loss and half the penalty times the squared weights; the intercept is free.

    marks: (block, n, label, share), label as doubles per row, share as doubles per row and model; a row with share 0 is only scored.
    """
    m = len(penalty)

    def marked(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        return _array(batch.column("label")[i], "<f8")[:, None], _array(batch.column("share")[i], "<f8", m)

    def balance(batch, i):
        y, share = marked(batch, i)
        return np.vstack([share.sum(axis=0), (share * y).sum(axis=0)])
    state = cut(marks.withColumn("v", F.lit(b"")).withColumn("kv", F.lit(b"")))
    whole, positives = _tree(state, balance) if not state.isEmpty() else np.zeros((2, m))
    if not ((0 < positives) & (positives < whole)).all():
        raise ValueError("both labels must occur")
    factors, b, losses, t = np.zeros((m, 0)), np.log(positives / (whole - positives)), [], 0

    def sums_at(state: DataFrame, c: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Loss, slope, curvature and penalty matrix of every model at the given factors and intercepts."""
        t = c.shape[1]

        def one(batch: pa.RecordBatch, i: int) -> np.ndarray:
            (y, share), v, kv = marked(batch, i), _stack(batch, i, "v", m, t), _stack(batch, i, "kv", m, t)
            z = _mixed(kv, c) + b
            p = _odds(z)
            loss = (share * (np.maximum(z, 0.0) - z * y + np.log1p(np.exp(-np.abs(z))))).sum(axis=0)
            left, curve = share * (p - y), share * p * (1 - p)
            out = []
            for j in range(m):
                k = np.vstack([kv[:, :, j].astype(float), np.ones((1, len(z)))])
                out.append(np.concatenate([[loss[j]], k @ left[:, j], ((k * curve[:, j]) @ k.T).ravel(), (v[:, :, j].astype(float) @ kv[:, :, j].T.astype(float)).ravel()]))
            return np.array(out)

        s = _tree(state, one)
        gram = s[:, 1 + t + 1 + (t + 1) ** 2:].reshape(m, t, t)
        gram = (gram + gram.transpose(0, 2, 1)) / 2
        slope, bend = s[:, 1:t + 2].copy(), s[:, t + 2:t + 2 + (t + 1) ** 2].reshape(m, t + 1, t + 1).copy()
        pull = np.einsum("mij,mj->mi", gram, c)
        slope[:, :t] += penalty[:, None] * pull
        bend[:, :t, :t] += penalty[:, None, None] * gram
        return s[:, 0] + 0.5 * penalty * (c * pull).sum(axis=1), slope, bend, gram

    def gradient(c: np.ndarray, b: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    (y, share), t = marked(batch, i), c.shape[1]
                    g = penalty * _mixed(_stack(batch, i, "v", m, t), c) + share * (_odds(_mixed(_stack(batch, i, "kv", m, t), c) + b) - y)
                    yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([g.astype("<f8").tobytes()], pa.binary())], names=["block", "y"])
        return work

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                more = {name: batch.column(name)[i].as_py() + _array(batch.column(last)[i], "<f8").astype("<f4").tobytes() for name, last in (("v", "y"), ("kv", "w"))}
                yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(i, 1) for x in ("block", "n", "label", "share")), *(pa.array([x], pa.binary()) for x in more.values())],
                                                 names=["block", "n", "label", "share", "v", "kv"])

    for _ in range(rounds):
        new = spanned(blocks, state.mapInArrow(gradient(factors, b), "block long, y binary"), m, pick)
        state = cut(state.join(new, "block").mapInArrow(single, "block long, n int, label binary, share binary, v binary, kv binary"))
        t += 1
        factors = np.hstack([factors, np.zeros((m, 1))])
        loss, slope, bend, gram = sums_at(state, factors, b)
        begun = loss
        losses += [loss] if not losses else []
        steep = np.sqrt(np.maximum(gram[:, -1, -1], 0.0) + slope[:, -1] ** 2)
        size = np.sqrt(np.maximum(np.einsum("mi,mij,mj->m", factors, gram, factors), 0.0) + b ** 2)
        if (steep <= tol * np.maximum(1.0, size)).all():
            break
        stride = np.ones(m)
        for _ in range(INNER):
            step = np.array([_newton(bend[j], slope[j]) for j in range(m)]) * stride[:, None]
            tried = (factors - step[:, :t], b - step[:, t])
            got = sums_at(state, *tried)
            good = got[0] < loss
            fall = np.where(good, loss - got[0], 0.0)
            factors, b = np.where(good[:, None], tried[0], factors), np.where(good, tried[1], b)
            loss, slope = np.where(good, got[0], loss), np.where(good[:, None], got[1], slope)
            bend, stride = np.where(good[:, None, None], got[2], bend), np.where(good, 1.0, stride / 4)
            if (fall <= SETTLED * np.abs(loss)).all() and good.any():
                break
        if not (loss < begun).any():
            break
        losses.append(loss)
        if (begun - loss <= SETTLED * np.abs(begun)).all():
            break
    return RowFit(state, factors, b, losses)


def _direction(dots: np.ndarray, m: int) -> np.ndarray:
    """Limited-memory BFGS for callers that keep a history, not used by fit_rows: factors of (s_1.., y_1.., g) in the descent direction, oldest pair first, from their inner products."""
    q, alpha = np.zeros(2 * m + 1), np.zeros(m)
    q[2 * m] = 1.0
    for i in reversed(range(m)):
        alpha[i] = (dots[i] @ q) / dots[i, m + i]
        q[m + i] -= alpha[i]
    if m:
        q *= dots[m - 1, 2 * m - 1] / dots[2 * m - 1, 2 * m - 1]
    for i in range(m):
        q[i] += alpha[i] - (dots[m + i] @ q) / dots[i, m + i]
    return -q


def _newton(bend: np.ndarray, slope: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(np.diag(bend), 1e-300))
    return np.linalg.lstsq(bend / np.outer(size, size), slope / size, rcond=1e-10)[0] / size


def marks_of(rows: TermRows, label: str, share) -> DataFrame:
    """(block, n, label, share) from the kept columns: share gets the kept structs and gives doubles per row and model."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kept = batch.column("kept")[i].values
                y = kept.field(label).cast(pa.float64()).to_numpy(zero_copy_only=False)
                parts = np.where(np.isnan(y)[:, None], 0.0, share(kept, y))             # rows without a label are only scored
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("n").slice(i, 1), *(pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in (np.nan_to_num(y), parts))],
                                                 names=["block", "n", "label", "share"])
    return rows.blocks.mapInArrow(work, "block long, n int, label binary, share binary")


def scored(rows: TermRows, margins: DataFrame, width: int) -> DataFrame:
    """The kept columns of all rows with `scores`, the log odds of every model."""
    kind = dict(rows.blocks.dtypes)["kept"].removeprefix("array<")[:-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                z = _array(batch.column("y")[i], "<f8", width)
                yield pa.RecordBatch.from_arrays([batch.column("kept")[i].values, pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, width), pa.int32()), pa.array(z.ravel()))], names=["k", "scores"])
    out = rows.blocks.select("block", "kept").join(margins, "block").select("kept", "y").mapInArrow(work, f"k {kind}, scores array<double>")
    return out.select(*[F.col("k")[c].alias(c) for c in rows.keep], "scores")


def sparse_logistic(entries: DataFrame, labels: DataFrame, c: float = 1.0, tol: float = 1e-4, rounds: int = 200) -> SparseLogit:
    """Fit labels (key, label in 0 and 1) on entries (key, term, value); half the squared weights plus c times the log loss.

    The intercept is free. Entries with a null value or term, and keys without a label, take no part; labelled keys
    without entries do. Repeated entries of a row add up.
    """
    rows = labels.where("key is not null and label is not null").select("key", F.col("label").cast("double").alias("label"))
    used = entries.where("key is not null and term is not null and value is not null and not isnan(value)").select("key", "term", F.col("value").cast("double").alias("value"))
    lists = used.groupBy("key").agg(F.collect_list(F.struct("term", "value")).alias("e"))
    parts = rows.join(lists, "key", "left").select("key", "label", *[F.coalesce(F.col(f"e.{n}"), F.array().cast(f"array<{k}>")).alias(n) for n, k in used.dtypes if n != "key"])
    packed = term_rows(parts, F.col("term"), ["label"], F.col("value"))
    fit = fit_rows(packed.blocks, marks_of(packed, "label", lambda kept, y: np.full((len(y), 1), float(c))), np.ones(1), tol, rounds)
    weights = cut(fit.weights(packed).join(packed.vocabulary, "id").select(F.col("word").alias("term"), "weight"))
    return SparseLogit(weights, float(fit.intercepts[0]), [float(x[0]) for x in fit.losses], hot_keys(entries, "term"))
