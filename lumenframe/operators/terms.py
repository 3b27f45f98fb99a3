"""Tokenized rows as packed sparse blocks, for models whose vocabulary fits no single machine.

A block holds some rows with its own list of words. Only the distinct words of a block leave it: they are counted into a
vocabulary table (word, id, df), and the ids travel back to the blocks. Words that one block alone has are told apart, since
their products need no exchange (see operators.svd). Neither words nor anything as wide as the vocabulary is on the driver.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import spread
from lumenframe.functions.ordering import cut, laid_out
from lumenframe.operators.order import top_k_per_group
from lumenframe.operators.svd import _CUT, _Rows, _array, _each, _with_columns, column_sums

TOKENS = 1 << 20              # tokens of a block
ROWS = 1 << 13                # rows of a block


@dataclass
class TermRows:
    """Blocks (block, n, starts, places, numbers, columns, own, dfs, kept), laid out by block; vocabulary (word, id, df); number of rows."""
    blocks: DataFrame
    vocabulary: DataFrame
    n: int
    keep: list[str]

    def part(self, flag: str, value: bool) -> TermRows:
        """The rows whose kept column `flag` has the given value, with the words and numbers that they have here."""
        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    kept = batch.column("kept")[i].values
                    rows = np.flatnonzero(pc.fill_null(pc.equal(kept.field(flag), value), False).to_numpy(zero_copy_only=False))
                    if not len(rows):
                        continue
                    starts, get = _array(batch.column("starts")[i], "<i8"), lambda name, kind, i=i: _array(batch.column(name)[i], kind)
                    length = np.diff(starts)[rows]
                    cells = np.repeat(starts[rows] - np.cumsum(length) + length, length) + np.arange(length.sum())
                    chosen_starts = np.concatenate([[0], np.cumsum(length)]).astype("<i8")
                    kept = kept.take(pa.array(rows))
                    out = {"block": batch.column("block").slice(i, 1), "n": pa.array([len(rows)], pa.int32()), "starts": pa.array([chosen_starts.tobytes()], pa.binary()),
                           "places": pa.array([get("places", "<i4")[cells].tobytes()], pa.binary()), "numbers": pa.array([get("numbers", "<f8")[cells].tobytes()], pa.binary()),
                           **{c: batch.column(c).slice(i, 1) for c in ("columns", "own", "dfs")}, "kept": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), kept)}
                    yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

        blocks = laid_out(self.blocks.mapInArrow(chosen, self.blocks.schema), "block")
        return TermRows(blocks, self.vocabulary, blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], self.keep)

    def rows(self) -> DataFrame:
        """(block, place, the kept columns)."""
        return self.blocks.select("block", F.posexplode("kept").alias("place", "k")).select("block", "place", *[F.col("k")[c].alias(c) for c in self.keep])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, count = [], 0, 0

    def block() -> pa.RecordBatch:
        kept, words = pa.concat_arrays([k for k, *_ in held]), pa.concat_arrays([w for _, _, w, _ in held])
        length, numbers = np.concatenate([x for _, x, _, _ in held]), np.concatenate([v for *_, v in held])
        coded, row = words.dictionary_encode(), np.repeat(np.arange(len(length)), length)
        some = coded.indices.is_valid().to_numpy(zero_copy_only=False)
        code, row, numbers = coded.indices.drop_null().to_numpy().astype(np.int64), row[some], numbers[some]
        wide = max(1, len(coded.dictionary))
        cells, back = np.unique(row * wide + code, return_inverse=True)            # repeated words of a row add up
        places = cells % wide
        starts = np.concatenate([[0], np.cumsum(np.bincount(cells // wide, minlength=len(length)))])
        dfs = np.bincount(places, minlength=len(coded.dictionary))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(length)], pa.int32()), pa.array([starts.astype("<i8").tobytes()], pa.binary()), pa.array([places.astype("<i4").tobytes()], pa.binary()),
             pa.array([np.bincount(back, weights=numbers, minlength=len(cells)).astype("<f8").tobytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary),
             pa.ListArray.from_arrays(pa.array([0, len(dfs)], pa.int32()), pa.array(dfs, pa.int64())),
             pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)],
            names=["n", "starts", "places", "numbers", "words", "dfs", "kept"])

    for batch in batches:
        kept, words, values = batch.columns
        length = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, at = np.concatenate([[0], np.cumsum(length)]), 0
        while at < batch.num_rows:
            end = int(np.searchsorted(starts, starts[at] + TOKENS - size, side="right")) - 1
            end = min(max(end, at + (not held)), at + ROWS - count, batch.num_rows)
            if end > at:
                flat = words.slice(at, end - at).flatten()
                held.append((kept.slice(at, end - at), length[at:end], flat, values.slice(at, end - at).flatten().to_numpy(zero_copy_only=False) if values.null_count == 0 else np.ones(len(flat))))
                size, count = size + len(flat), count + end - at
            if end < batch.num_rows:
                yield block()
                held, size, count = [], 0, 0
            at = end
    if held:
        yield block()


def _numbered(finish: Callable[..., np.ndarray]):
    """Blocks with the list of their words' ids: columns of other blocks first, in ascending order, then the block's own."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                listed = batch.column("l")[i].values
                ids, dfs, held = (listed.field(c).to_numpy(zero_copy_only=False) if listed is not None else np.zeros(0, np.int64) for c in ("id", "df", "held"))
                order = np.lexsort((ids, held < 2))
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                starts, shared = _array(batch.column("starts")[i], "<i8"), int((held > 1).sum())
                places = rank[_array(batch.column("places")[i], "<i4")]
                numbers = finish(starts, places, _array(batch.column("numbers")[i], "<f8"), dfs[order])
                packed = [places.astype("<i4"), numbers.astype("<f8"), ids[order][:shared].astype("<i8"), ids[order][shared:].astype("<i8"), dfs[order].astype("<i8")]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in ("block", "n", "starts")), *(pa.array([x.tobytes()], pa.binary()) for x in packed), batch.column("kept").slice(i, 1)],
                                                 names=["block", "n", "starts", "places", "numbers", "columns", "own", "dfs", "kept"])
    return work


def unit_rows(starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Numbers scaled to unit length per row; rows of zeros stay."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    length = np.sqrt(np.bincount(row, weights=numbers * numbers, minlength=len(starts) - 1))
    return numbers / np.where(length > 0, length, 1.0)[row]


def term_rows(df: DataFrame, words: Column, keep: list[str], values: Column | None = None, tfidf: bool = False, min_df: int = 1) -> TermRows:
    """Rows of a list of words, each counted as often as it stands there or with the sum of its values.

    With tfidf the numbers are tf * (ln((1 + n) / (1 + df)) + 1), scaled to unit length per row. Words in fewer than
    min_df rows count nothing. Rows without words stay as rows of zeros.
    """
    base = spread(df).select(F.struct(*keep, F.lit(0).alias("_")).alias("kept"), words.alias("w"),
                             (values if values is not None else F.lit(None).cast("array<double>")).alias("v"))
    kinds = dict(base.dtypes)
    plain = base.mapInArrow(_pack, f"n int, starts binary, places binary, numbers binary, words {kinds['w']}, dfs array<long>, kept array<{kinds['kept']}>")
    blocks = cut(plain.withColumn("block", F.monotonically_increasing_id()))
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "dfs")).alias("place", "w")).select("block", "place", F.col("w")["words"].alias("word"), F.col("w")["dfs"].alias("df"))
    counted = cut(listed.groupBy("word").agg(F.sum("df").alias("df"), F.count(F.lit(1)).alias("held")).withColumn("_at", F.monotonically_increasing_id()))
    # numbers that interleave the partitions: words stand there by hash, so ranges of numbers are alike
    number = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) * max(1, counted.rdd.getNumPartitions()) + F.shiftright("_at", 33)
    vocabulary = counted.select("word", number.alias("id"), "df", "held")
    known = listed.select("block", "place", "word").join(vocabulary, "word").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "df", "held"))).alias("l"))
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def finish(starts, places, numbers, dfs):
        numbers = numbers * (dfs >= min_df)[places]
        return unit_rows(starts, numbers * (np.log((1 + n) / (1 + dfs)) + 1)[places]) if tfidf else numbers

    whole = blocks.drop("words", "dfs").join(known, "block", "left")
    out = whole.mapInArrow(_numbered(finish), f"block long, n int, starts binary, places binary, numbers binary, columns binary, own binary, dfs binary, kept array<{kinds['kept']}>")
    return TermRows(laid_out(out, "block"), vocabulary.where(F.col("df") >= min_df).select("word", "id", "df"), n, keep)


def fold_scales(blocks: DataFrame, fold: DataFrame, folds: int, sizes: np.ndarray) -> DataFrame:
    """Blocks of counts with the scales of tf-idf learned outside each fold: `cscale` per column and `rscale` per row.

    fold: (block, fold) as doubles per row, below 0 for rows in no fold; sizes: rows outside each fold. Places 0 .. folds - 1 are
    with inverse document frequency, the others without; words that a fold's training rows lack count nothing there.
    """
    def counted(rows: _Rows, batch: pa.RecordBatch, i: int) -> np.ndarray:
        lot = np.repeat(_array(batch.column("fold")[i], "<f8"), np.diff(rows.starts)).astype(np.int64)
        some = (lot >= 0) & (rows.numbers > 0)
        wide = len(rows.columns) + len(rows.own)
        return np.bincount(rows.places[some].astype(np.int64) * folds + lot[some], minlength=wide * folds).reshape(wide, folds)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows in _each(batch):
                yield rows.cuts(counted(rows, batch, i))

    def scaled(batch: pa.RecordBatch, i: int, table: np.ndarray) -> pa.RecordBatch:
        rows = _Rows(batch, i)
        counts = np.concatenate([table.astype(float), counted(rows, batch, i)[len(rows.columns):]])
        df = counts.sum(axis=1, keepdims=True) - counts
        columns = np.hstack([np.where(df > 0, np.log((1 + sizes) / (1 + df)) + 1, 0.0), df > 0]).astype("<f4")
        row, lengths = np.repeat(np.arange(rows.n), np.diff(rows.starts)), []
        for j in range(2 * folds):
            length = np.sqrt(np.bincount(row, weights=(rows.numbers * columns[rows.places, j]) ** 2, minlength=rows.n))
            lengths.append(np.where(length > 0, 1 / np.where(length > 0, length, 1.0), 0.0))
        more = [pa.array([columns.tobytes()], pa.binary()), pa.array([np.stack(lengths, axis=1).astype("<f8").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in names), *more], names=[*names, "cscale", "rscale"])

    names = ["block", "n", "starts", "places", "numbers", "columns", "own"]
    both = blocks.select(names).join(fold, "block")
    out = _with_columns(both, both.mapInArrow(send, _CUT), folds, scaled,
                        "block long, n int, starts binary, places binary, numbers binary, columns binary, own binary, cscale binary, rscale binary")
    return laid_out(out, "block")


def column_cells(sums: DataFrame, width: int, top: int | None = None) -> DataFrame:
    """(id, cluster, weight) of column_sums; with `top` only positive weights that may be among the `top` largest of their place."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for columns, data in zip(frame["columns"], frame["data"], strict=True):
                ids, x = np.frombuffer(columns, "<i8"), np.frombuffer(data, "<f8").reshape(-1, width)
                for j in range(width):
                    at = np.arange(len(ids))
                    if top is not None:
                        at = np.flatnonzero(x[:, j] > 0)
                        if len(at) > top:
                            at = at[x[at, j] >= np.partition(x[at, j], -top)[-top]]      # ties at the edge are settled by name
                    yield pd.DataFrame({"id": ids[at], "cluster": np.int32(j), "weight": x[at, j]})
    return sums.mapInPandas(work, "id long, cluster int, weight double")


def top_words(rows: TermRows, shares: DataFrame, width: int, n: int) -> DataFrame:
    """(cluster, term, weight): the n words with the largest sums of numbers * share, for shares (block, y) of `width` clusters a row."""
    cells = column_cells(column_sums(rows.blocks, shares, width), width, n)
    named = cells.join(rows.vocabulary, "id").select("cluster", F.col("word").alias("term"), "weight")
    return top_k_per_group(named, ["cluster"], ["-weight", "term"], n).select("cluster", "term", "weight")
