"""Truncated SVD of sparse rows by block Krylov iteration.

Rows are packed into blocks of bounded size, each a small sparse matrix with its own list of columns. A step multiplies
the current block of `b` left vectors by A A^T: every block sends A^T y for its columns, cut into ranges of columns; the
ranges are added up as they stream by and each block gets back only the columns it asked for. Columns that one block alone
has (`own`, known for packed terms) are multiplied where they are and do not travel. The new vectors are made
orthogonal to all earlier ones and among themselves (twice, from inner products that are summed in a tree), and the
singular values are those of the small matrix of all inner products so far. A step is a few jobs over all rows, and five
to eight steps do, where one vector at a time takes ten times as many as there are components.

Only matrices as wide as the number of basis vectors reach the driver; left vectors, right vectors and scores stay tables.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import cut, laid_out

ENTRIES = 1 << 18             # numbers of a block
ROWS = 1 << 13                # rows of a block
RANGE = 12                    # 2 ** RANGE columns are added up together
MORE = 8                      # vectors of a block beyond those that are wanted
STEPS = 12
TREE = 64                     # partial sums that reach the driver
GATHER = 1 << 20              # numbers multiplied at once
NOISE = 1e-6                  # products travel in single precision: values under 1/1000 of the largest are not told from zero
_CUT = "part int, block long, columns binary, data binary"


def _vector_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, column numbers, values) of ML vectors; a dense one counts as all of its columns."""
    column = column.storage if isinstance(column, pa.ExtensionArray) else column
    kinds = column.field("type").to_numpy(zero_copy_only=False)
    values, indices = column.field("values"), column.field("indices")
    n = values.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(n)])
    if (kinds == 0).all():
        return starts, indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False)
    listed = [np.asarray(i, np.int64) if kind == 0 else np.arange(k) for kind, i, k in zip(kinds.tolist(), indices.to_pylist(), n.tolist(), strict=True)]
    return starts, np.concatenate([np.zeros(0, np.int64), *listed]), values.flatten().to_numpy(zero_copy_only=False)


def packed_rows(df: DataFrame, vec: str, keep: list[str]) -> DataFrame:
    """Blocks of rows, with the kept columns of their rows as lists."""
    rows = df.where(F.col(vec).isNotNull()).select(F.struct(*keep, F.lit(0).alias("_")).alias("kept"), F.col(vec).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, count = [], 0, 0

        def block():
            kept = pa.concat_arrays([k for k, *_ in held])
            n = np.concatenate([np.diff(s) for _, s, _, _ in held])
            columns, places = np.unique(np.concatenate([c for _, _, c, _ in held]), return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(n)], pa.int32()), pa.array([np.concatenate([[0], np.cumsum(n)]).astype("<i8").tobytes()], pa.binary()),
                 pa.array([places.astype("<i4").tobytes()], pa.binary()), pa.array([np.concatenate([v for *_, v in held]).astype("<f8").tobytes()], pa.binary()),
                 pa.array([columns.astype("<i8").tobytes()], pa.binary()), pa.array([b""], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)],
                names=["n", "starts", "places", "numbers", "columns", "own", "kept"])

        for batch in batches:
            starts, columns, values = _vector_parts(batch.column(1))
            at = 0
            while at < batch.num_rows:
                end = int(np.searchsorted(starts, starts[at] + ENTRIES - size, side="right")) - 1
                end = min(max(end, at + (not held)), at + ROWS - count, batch.num_rows)
                if end > at:
                    a, b = starts[at], starts[end]
                    held.append((batch.column(0).slice(at, end - at), starts[at:end + 1] - a, columns[a:b], values[a:b]))
                    size, count = size + int(b - a), count + end - at
                if end < batch.num_rows:
                    yield block()
                    held, size, count = [], 0, 0
                at = end
        if held:
            yield block()

    kept = dict(rows.dtypes)["kept"]
    plain = rows.mapInArrow(pack, f"n int, starts binary, places binary, numbers binary, columns binary, own binary, kept array<{kept}>")
    return cut(plain.withColumn("block", F.monotonically_increasing_id()))


def _added(index: np.ndarray, weight: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Row r is the sum of weight * table[index] over starts[r] .. starts[r + 1], in the precision of the table."""
    out, at, most = np.zeros((len(starts) - 1, table.shape[1]), table.dtype), 0, max(1, GATHER // table.shape[1])
    weight = weight.astype(table.dtype)
    while at < len(out):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1)
        a, b = starts[at], starts[end]
        filled = at + np.flatnonzero(np.diff(starts[at:end + 1]))
        if len(filled):
            out[filled] = np.add.reduceat(table[index[a:b]] * weight[a:b, None], starts[filled] - a, axis=0)
        at = end
    return out


def _array(cell, kind: str, width: int | None = None) -> np.ndarray:
    flat = np.frombuffer(cell.as_buffer(), kind) if cell.is_valid else np.zeros(0, kind)
    return flat if width is None else flat.reshape(-1, width)


class _Rows:
    """A block as a matrix; its columns are those that other blocks may have too, then its own."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        get = lambda name: batch.column(name)[i]
        self.block, self.n = get("block").as_py(), get("n").as_py()
        self.starts, self.places, self.numbers, self.columns = _array(get("starts"), "<i8"), _array(get("places"), "<i4"), _array(get("numbers"), "<f8"), _array(get("columns"), "<i8")
        self.own = _array(get("own"), "<i8")

    def times(self, table: np.ndarray) -> np.ndarray:
        return _added(self.places, self.numbers, self.starts, table)

    def turned_times(self, y: np.ndarray) -> np.ndarray:
        order = np.argsort(self.places, kind="stable")
        row = np.repeat(np.arange(self.n), np.diff(self.starts))
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.places, minlength=len(self.columns) + len(self.own)))])
        return _added(row[order], self.numbers[order], starts, y)

    def everywhere(self) -> tuple[np.ndarray, np.ndarray]:
        """All column numbers, the block's own too, in ascending order, and their places in the block."""
        both = np.concatenate([self.columns, self.own])
        order = np.argsort(both, kind="stable")
        return both[order], order

    def cuts(self, data: np.ndarray | None, whole: bool = False, kind: str = "<f4") -> pa.RecordBatch:
        """The columns of the block by range, with their rows of data; `whole`: its own columns too."""
        columns, order = self.everywhere() if whole else (self.columns, None)
        data = data if data is None or order is None else data[order]
        part = columns >> RANGE
        names, first = np.unique(part, return_index=True)
        pieces = list(zip(first.tolist(), [*first[1:].tolist(), len(part)]))           # none without columns
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), pa.array([self.block] * len(names), pa.int64()), pa.array([columns[a:b].tobytes() for a, b in pieces], pa.binary()),
             pa.array([None if data is None else data[a:b].astype(kind).tobytes() for a, b in pieces], pa.binary())], names=["part", "block", "columns", "data"])


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, _Rows]]:
    for i in range(batch.num_rows):
        yield i, _Rows(batch, i)


def _exchange(width: int, whole: bool, kind: str):
    """Sums per range of columns from rows sorted by range: the columns each block asked for, or the whole range."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, seen, asked = None, None, None, []

        def results():
            if whole:
                some = np.flatnonzero(seen)
                out = [(now, -1, (some + (now << RANGE)).astype("<i8").tobytes(), total[some].tobytes())]
            else:
                out = ((now, block, None, total[at].tobytes()) for block, at in asked)
            for row in out:
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                                 names=["part", "block", "columns", "data"])

        for batch in batches:
            for i, (part, block) in enumerate(zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), strict=True)):
                if part != now:
                    if now is not None:
                        yield from results()
                    now, total, seen, asked = part, np.zeros((1 << RANGE, width), kind), np.zeros(1 << RANGE, bool), []
                at = _array(batch.column("columns")[i], "<i8") - (part << RANGE)
                if batch.column("data")[i].is_valid:
                    total[at] += _array(batch.column("data")[i], kind, width)
                    seen[at] = True
                if block >= 0:
                    asked.append((block, at))
        if now is not None:
            yield from results()
    return work


def _exchanged(cuts: DataFrame, width: int, whole: bool = False, kind: str = "<f4") -> DataFrame:
    return cuts.repartition("part").sortWithinPartitions("part").mapInArrow(_exchange(width, whole, kind), _CUT)


def _with_columns(blocks: DataFrame, cuts: DataFrame, width: int, make: Callable[[pa.RecordBatch, int, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """make(batch, row, table) for every block, where table holds the sums of `cuts` for the columns of the block."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("part").to_numpy()) if right.num_rows else []
        parts = [_array(right.column("data")[int(i)], "<f4", width) for i in order]
        table = np.concatenate([np.zeros((0, width), np.float32), *parts])
        return pa.Table.from_batches([make(batch, i, table) for batch in left.to_batches() for i in range(batch.num_rows)])

    return blocks.groupBy("block").cogroup(_exchanged(cuts, width).groupBy("block")).applyInArrow(both, schema)


def _tree(df: DataFrame, make: Callable[[pa.RecordBatch, int], np.ndarray]) -> np.ndarray:
    """Sum of one array per row; at most TREE partial sums reach the driver."""
    def add(batches, read):
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                one = read(batch, i)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary()), pa.array([total.shape[1]], pa.int32())], names=["sum", "width"])

    read = lambda batch, i: _array(batch.column("sum")[i], "<f8", batch.column("width")[i].as_py())
    first = df.mapInArrow(lambda b: add(b, make), "sum binary, width int")
    rows = first.coalesce(TREE).mapInArrow(lambda b: add(b, read), "sum binary, width int").collect()
    return sum(np.frombuffer(r["sum"], "<f8").reshape(-1, r["width"]) for r in rows)


def spanned(blocks: DataFrame, rows: DataFrame, width: int, pick: np.ndarray | None = None) -> DataFrame:
    """(block, y, w) with w = A A^T y of (block, y), `width` numbers a row; blocks are laid out by block.

    With `pick` the matrix of vector j is A scaled by row and by column, by the places pick[j] of `rscale` and `cscale`.
    """
    latest = blocks.join(rows.select("block", "y"), "block")

    def scale(batch: pa.RecordBatch, i: int, name: str, kind: str):
        return 1.0 if pick is None else _array(batch.column(name)[i], kind).reshape(-1, int(pick.max()) + 1)[:, pick]

    def back(rows: _Rows, batch: pa.RecordBatch, i: int) -> np.ndarray:
        return rows.turned_times((_array(batch.column("y")[i], "<f8", width) * scale(batch, i, "rscale", "<f8")).astype(np.float32))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows in _each(batch):
                yield rows.cuts(back(rows, batch, i))

    def multiplied(batch: pa.RecordBatch, i: int, table: np.ndarray) -> pa.RecordBatch:
        rows = _Rows(batch, i)
        if len(rows.own):
            table = np.concatenate([table, back(rows, batch, i)[len(rows.columns):]])
        if pick is not None:
            table = table * scale(batch, i, "cscale", "<f4") ** 2
        w = rows.times(table).astype(float) * scale(batch, i, "rscale", "<f8")
        return pa.RecordBatch.from_arrays([pa.array([rows.block]), batch.column("y").slice(i, 1), pa.array([w.tobytes()], pa.binary())], names=["block", "y", "w"])

    return _with_columns(latest, latest.mapInArrow(send, _CUT), width, multiplied, "block long, y binary, w binary")


def column_sums(blocks: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """A^T y of (block, y) as ranges of columns (part, block, columns, data), `width` double-precision numbers a column."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, one in _each(batch):
                yield one.cuts(one.turned_times(_array(batch.column("y")[i], "<f8", width)), whole=True, kind="<f8")
    return _exchanged(blocks.join(rows.select("block", "y"), "block").mapInArrow(send, _CUT), width, whole=True, kind="<f8")


class SvdModel:
    """Singular values, and the right vectors as a table of column ranges."""

    def __init__(self, values: np.ndarray, vectors: DataFrame) -> None:
        self.values, self.vectors = values, vectors

    def transform(self, df: DataFrame, vec: str, keep: list[str], out: str = "reduced") -> DataFrame:
        """The kept columns and the products of each row with the right vectors; columns unknown to the fit count nothing."""
        return self.transform_blocks(packed_rows(df, vec, keep), keep, out)

    def transform_blocks(self, blocks: DataFrame, keep: list[str], out: str = "reduced") -> DataFrame:
        """The same for rows that are packed already."""
        k = len(self.values)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, rows in _each(batch):
                    yield rows.cuts(None, whole=True)

        def score(batch: pa.RecordBatch, i: int, table: np.ndarray) -> pa.RecordBatch:
            rows = _Rows(batch, i)
            placed = np.zeros((len(table), k))
            placed[rows.everywhere()[1]] = table
            found = rows.times(placed) if len(placed) else np.zeros((rows.n, k))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, k), pa.int32()), pa.array(found.ravel()))
            return pa.RecordBatch.from_arrays([batch.column("kept")[i].values, listed], names=["kept", "found"])

        asked = blocks.drop("kept").mapInArrow(ask, _CUT).unionByName(self.vectors)
        kind = dict(blocks.dtypes)["kept"].removeprefix("array<")[:-1]
        scored = _with_columns(blocks, asked, k, score, f"kept {kind}, found array<double>").where("kept is not null")
        return scored.select(*[F.col("kept")[c].alias(c) for c in keep], F.col("found").alias(out))

    def components(self, width: int) -> np.ndarray:
        """The right vectors as one array (k x width), for narrow data."""
        out = np.zeros((len(self.values), width))
        for row in self.vectors.collect():
            out[:, np.frombuffer(row["columns"], "<i8")] = np.frombuffer(row["data"], "<f4").reshape(-1, len(self.values)).T
        return out


def svd_model(df: DataFrame, vec: str, k: int, tol: float = 1e-3, steps: int = STEPS, seed: int = 0) -> SvdModel:
    """The k largest singular values and right vectors of a column of ML vectors.

    Steps go on until no wanted value is expected to grow by more than `tol` of itself, or the rows are spanned. Fewer than k values
    come back if fewer are above a thousandth of the largest. The largest entry of every right vector is positive.
    """
    return svd_of_blocks(packed_rows(df, vec, []), k, tol, steps, seed)


def svd_of_blocks(packed: DataFrame, k: int, tol: float = 1e-3, steps: int = STEPS, seed: int = 0) -> SvdModel:
    """The same for rows that are packed already."""
    blocks = laid_out(packed.drop("kept"), "block")
    n = blocks.agg(F.sum("n")).first()[0] or 0
    width = min(k + MORE, n)
    if not n:
        raise ValueError("no rows")

    def drawn(batches):
        for batch in batches:
            for _, rows in _each(batch):
                y = np.random.default_rng([seed, rows.block]).standard_normal((rows.n, width))
                yield pa.RecordBatch.from_arrays([pa.array([rows.block]), pa.array([y.tobytes()], pa.binary())], names=["block", "w"])

    def joined(batch, i, widths):
        return np.hstack([_array(batch.column(f"y{j}")[i], "<f8", b) for j, b in enumerate(widths)]) if widths else None

    basis, widths, small, history = None, [], np.zeros((0, 0)), []
    new, b = blocks.mapInArrow(drawn, "block long, w binary"), width
    while True:
        # two rounds against the earlier vectors, then among themselves
        both = cut(new) if basis is None else cut(basis.join(new, "block"))
        if basis is None:
            first = np.zeros((0, b))
            gram = _tree(both, lambda batch, i: (lambda w: w.T @ w)(_array(batch.column("w")[i], "<f8", b)))
            rest = first
        else:
            first = _tree(both, lambda batch, i: joined(batch, i, widths).T @ _array(batch.column("w")[i], "<f8", b))
            known, small = small, np.zeros((len(first), len(first)))
            small[:len(known), :len(known)] = known
            small[:, len(known):], small[len(known):, :] = first, first.T

            def twice(batch, i):
                y = joined(batch, i, widths)
                w = _array(batch.column("w")[i], "<f8", b) - y @ first
                return np.vstack([y.T @ w, w.T @ w])
            sums = _tree(both, twice)
            rest, gram = sums[:len(first)], sums[len(first):] - sums[:len(first)].T @ sums[:len(first)]
            history.append(np.sqrt(np.maximum(np.linalg.eigvalsh(small)[::-1][:k], 0.0)))
            if _left_to_grow(history) <= tol:
                break
            if len(widths) >= steps or sum(widths) >= n:
                break
        size, turn = np.linalg.eigh((gram + gram.T) / 2)
        good = size > max(size[-1], 0.0) * 1e-12
        scale = np.abs(small).max(initial=0.0) ** 2
        good &= size > 1e-24 * scale
        if not good.any():
            break
        fix = turn[:, good] / np.sqrt(size[good])
        back = first + rest

        def step(batches, fix=fix, back=back, at=len(widths), known=tuple(widths), wide=b):
            for batch in batches:
                for i in range(batch.num_rows):
                    w = _array(batch.column("w")[i], "<f8", wide)
                    w = (w - joined(batch, i, known) @ back if known else w) @ fix
                    old = [batch.column(f"y{j}").slice(i, 1) for j in range(at)]
                    yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *old, pa.array([w.tobytes()], pa.binary())], names=["block", *(f"y{j}" for j in range(at + 1))])

        order = ["block", *(f"y{j}" for j in range(len(widths)))]
        schema = ", ".join(["block long", *(f"y{j} binary" for j in range(len(widths) + 1))])
        basis = cut(both.select(*order, "w").mapInArrow(step, schema))
        b = int(good.sum())
        widths.append(b)
        new = spanned(blocks, basis.select("block", F.col(f"y{len(widths) - 1}").alias("y")), b).select("block", "w")

    squares, turn = np.linalg.eigh(small)
    best = np.argsort(squares)[::-1][:k]
    best = best[squares[best] > max(squares.max(initial=0.0), 0.0) * NOISE]
    values, pick = np.sqrt(squares[best]), turn[:, best]

    def right(batches, known=tuple(widths[:_blocks_in(small, widths)])):
        for batch in batches:
            for i, rows in _each(batch):
                yield rows.cuts(rows.turned_times(joined(batch, i, known) @ (pick / values)), whole=True)

    if not len(values):
        raise ValueError("all rows are zero")
    vectors = cut(_exchanged(blocks.join(basis, "block").mapInArrow(right, _CUT), len(values), whole=True))
    tops = vectors.mapInPandas(_largest(len(values)), "component int, entry double")
    signs = {r["component"]: r["s"] for r in tops.groupBy("component").agg(F.signum(F.max_by("entry", F.abs("entry"))).alias("s")).collect()}
    turned = np.array([signs.get(j) or 1.0 for j in range(len(values))], np.float32)

    def signed(batches):
        for batch in batches:
            data = [(_array(x, "<f4", len(turned)) * turned).tobytes() for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary())], names=batch.schema.names)
    return SvdModel(values, cut(vectors.mapInArrow(signed, _CUT)))


def _left_to_grow(history: list[np.ndarray]) -> float:
    """How much a wanted value may still grow, as a part of it: steps shrink by about the ratio of the last two."""
    if len(history) < 3 or not len(history[-1]) == len(history[-2]) == len(history[-3]):
        return np.inf
    last, once, twice = history[-1], history[-2], history[-3]
    now, then = (last - once) / np.maximum(last, 1e-300), (once - twice) / np.maximum(last, 1e-300)
    now, then = max(float(now.max()), 0.0), max(float(then.max()), 1e-300)
    ratio = min(now / then, 0.9)
    return now * ratio / (1 - ratio)


def _blocks_in(small: np.ndarray, widths: list[int]) -> int:
    """How many blocks of the basis the small matrix covers."""
    total, count = 0, 0
    for b in widths:
        if total + b > len(small):
            break
        total, count = total + b, count + 1
    return count


def _largest(k: int):
    def work(frames):
        for frame in frames:
            for data in frame["data"]:
                x = np.frombuffer(data, "<f4").reshape(-1, k)
                yield pd.DataFrame({"component": np.arange(k, dtype=np.int32), "entry": x[np.abs(x).argmax(axis=0), np.arange(k)].astype(float)})
    return work
