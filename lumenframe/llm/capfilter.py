"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; it takes every vector whose cosine with it reaches a fixed bound. Two vectors are compared if
some filter takes both. The directions form a product code: every vector is turned at random and cut into blocks, each
block has its own list of random directions, and a filter is one choice per block, so there are (directions ** blocks)
filters. A vector's filters are list-decoded: block by block, only choices whose sum can still reach the bound are
followed. Turned vectors and directions are rounded to integers, so products are exact and a vector has the same filters
wherever they are worked out.

Bound and number of filters follow the number of vectors: a filter is expected to take SHARE vectors of a table without
structure, and COMMON filters to take both vectors of a pair at the bound, at any size. They belong to CODES independent
codes, each with a turn of its own, as the filters of one code depend on how a vector spreads over its blocks. Pairs that
are found are verified in double precision, so no link is wrong; of pairs at the bound about one in a thousand is missed
at a million vectors (tests measure it). A filter with many more vectors (a large group of near copies) is cut into parts
of PART vectors, and a task compares two parts. A pair counts only in its first common filter, so links leave a task as
counts per vector and as stars, never as pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are
components of their own. Every row counts as a vector: rows with equal vectors link with each other (they are one vector
with a weight inside). Only vectors of one length are compared. Sizes from 1e-300 to 1e300 are scaled before products.
A row with a null id links as any other; its id names a component only if all ids of it are null. Extra columns are ignored. Empty tables give an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.llm.common import landed
from lumenframe.llm.search import usable
from lumenframe.operators.graph import build_graph, connected_components

SHARE = 64                    # vectors expected in a filter
LEAST_SHARE = 1 / 64          # a filter takes no larger part of the sphere than this
COMMON = 16                   # filters expected to take both vectors of a pair at the bound
CODES = 16                    # independent product codes that share the filters
PART = 1_024                  # vectors of a filter that a task compares with as many others
TWO_BLOCKS = 1 << 24          # a code with more filters than that has three blocks
ROUNDING = 1 << 12
DECODED = 1 << 22             # products held at once
COLUMNS = 4_096               # filters looked at together when a pair's first one is sought
SEED = 12


def padded(width: int) -> int:
    return max(8, 1 << (width - 1).bit_length())


def cap(width: int, steps: int = 200_001) -> tuple[np.ndarray, np.ndarray]:
    """(angles, share of the sphere within that angle of a fixed direction)."""
    angle = np.linspace(0.0, math.pi, steps)
    area = np.cumsum(np.sin(angle) ** (width - 2))
    return angle, area / area[-1]


def plan(width: int, n: int, cosine: float) -> tuple[float, float]:
    """(bound of a filter, number of filters) for n vectors: SHARE vectors a filter, COMMON filters for a pair at `cosine`."""
    angle, within = cap(width)
    part = min(LEAST_SHARE, SHARE / max(n, 1))
    bound = math.cos(np.interp(part, within, angle))
    # a vector at angle a of the direction; its partner's part across it has one dimension less
    a = np.linspace(0.0, math.acos(bound), 2_001)[1:]
    across, less = cap(width - 1)
    need = (bound - cosine * np.cos(a)) / (math.sqrt(1 - cosine * cosine) * np.sin(a))
    both = np.interp(np.arccos(np.clip(need, -1.0, 1.0)), across, less)
    density = np.sin(a) ** (width - 2)
    return bound, COMMON / (part * float((both * density).sum() / density.sum()))


class Filters:
    """The filters for n vectors of one width, by independent product codes."""

    def __init__(self, width: int, n: int, cosine: float, seed: int = SEED) -> None:
        self.width, self.wide = width, padded(width)
        bound, wanted = plan(self.wide, n, min(max(cosine, 0.0), 0.999))
        self.blocks = 2 if wanted <= TWO_BLOCKS * CODES else 3
        self.each = math.ceil((wanted / CODES) ** (1 / self.blocks))
        self.bound = bound * math.sqrt(self.blocks) * ROUNDING * ROUNDING
        self.codes = [Code(self, np.random.default_rng([seed, width, self.each, i])) for i in range(CODES)]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter that takes a row."""
        parts = [code.decode(unit) for code in self.codes]
        size = self.each ** self.blocks
        return np.concatenate([r for r, _ in parts]), np.concatenate([f + i * size for i, (_, f) in enumerate(parts)])


class Code:
    """One product code: a random turn, and a list of directions for each block."""

    def __init__(self, of: Filters, rng: np.random.Generator) -> None:
        self.width, self.wide, self.blocks, self.each, self.bound = of.width, of.wide, of.blocks, of.each, of.bound
        self.signs = rng.choice([-1.0, 1.0], (3, self.wide))
        self.cuts = np.linspace(0, self.wide, self.blocks + 1).astype(int)
        self.directions = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            g = rng.standard_normal((self.each, b - a))
            self.directions.append(np.rint(g / np.linalg.norm(g, axis=1, keepdims=True) * ROUNDING))

    def turned(self, unit: np.ndarray) -> np.ndarray:
        """Random signs and a Hadamard transform, three times, then rounded; sums are made in a fixed order."""
        x = np.zeros((len(unit), self.wide))
        x[:, :self.width] = unit
        for signs in self.signs:
            x *= signs
            half = 1
            while half < self.wide:
                v = x.reshape(len(x), -1, 2, half)
                low, high = v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]
                v[:, :, 0], v[:, :, 1] = low, high
                half *= 2
            x /= math.sqrt(self.wide)
        return np.rint(x * ROUNDING)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter that takes a row; a row that none takes goes to the one nearest to it."""
        at_once, rows, found = max(1, DECODED // (self.each * self.blocks)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first in range(0, len(unit), at_once):
            x = self.turned(unit[first:first + at_once])
            products = [x[:, a:b] @ d.T for (a, b), d in zip(zip(self.cuts, self.cuts[1:]), self.directions)]
            best = [p.max(axis=1) for p in products]
            bound = np.minimum(self.bound, sum(best))
            row, code, total, rest = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x)), sum(best)
            for p, top in zip(products, best):
                rest = rest - top
                # directions that can still reach the bound beside the best of all other blocks
                who, which = np.nonzero(p >= (bound - sum(best) + top)[:, None])
                value, n = p[who, which], np.bincount(who, minlength=len(x))
                start = (np.cumsum(n) - n)[row]
                many = n[row]
                pick = np.repeat(start, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                row, code, total = np.repeat(row, many), np.repeat(code, many) * self.each + which[pick], np.repeat(total, many) + value[pick]
                open_ = total + rest[row] >= bound[row]
                row, code, total = row[open_], code[open_], total[open_]
            rows.append(row + first)
            found.append(code)
        return np.concatenate(rows), np.concatenate(found)


@lru_cache(maxsize=8)
def filters_for(width: int, n: int, cosine: float) -> Filters:
    return Filters(width, n, cosine)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _decoded(sizes: dict[int, int], cosine: float):
    """(width, filter, no) for the vectors of (no, vector)."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            widths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, starts = lists.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                for i in range(0, len(at), max(1, DECODED // width)):
                    some = at[i:i + max(1, DECODED // width)]
                    row, code = filters_for(width, sizes[width], cosine).decode(unit_rows(flat[starts[some][:, None] + np.arange(width)]))
                    yield pa.RecordBatch.from_pydict({"width": pa.array(np.full(len(row), width), pa.int32()), "filter": code, "no": no[some][row]})
    return decode


def _stars(link: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first member, other members) of each connected part with a link; link is symmetric."""
    left = link.any(axis=1)
    while left.any():
        centre = int(left.argmax())
        seen = np.zeros(len(link), bool)
        front = seen.copy()
        front[centre] = True
        while front.any():
            seen |= front
            front = link[front].any(axis=0) & ~seen
        left &= ~seen
        seen[centre] = False
        yield centre, np.flatnonzero(seen)


def first_links(link: np.ndarray, code: int, held: list[np.ndarray]) -> np.ndarray:
    """The links of a filter whose vectors share no earlier filter; held lists the filters of each vector."""
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    found = np.concatenate(held)
    row, found = row[found < code], found[found < code]
    _, column, count = np.unique(found, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1                        # a filter of one vector only rules out nothing
    row, column = row[count[column] > 1], number[column[count[column] > 1]]
    shared = int((count > 1).sum())
    for at in range(0, shared, COLUMNS):
        some = (column >= at) & (column < at + COLUMNS)
        earlier = np.zeros((len(held), min(COLUMNS, shared - at)), np.float32)
        earlier[row[some], column[some] - at] = 1
        link = link & (earlier @ earlier.T == 0)
    return link


def compare_cells(width: int, n: int, cosine: float, cells: list[tuple[int, bool, slice]], part: np.ndarray, no: np.ndarray,
                  weight: np.ndarray, unit: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(no, number of links, star members, star centres) of every cell (filter, one part or two, rows) with a link."""
    open_ = []
    for code, one_part, at in cells:
        link = unit[at] @ unit[at].T >= cosine
        link &= ~np.eye(len(link), dtype=bool) if one_part else part[at][:, None] != part[at][None, :]
        linked = np.flatnonzero(link.any(axis=1))
        if len(linked):
            rows = linked + at.start
            order = np.argsort(no[rows])
            open_.append((code, rows[order], link[np.ix_(linked[order], linked[order])]))
    if not open_:
        return
    # the filters of all linked vectors are worked out at once
    used, at = np.unique(no[np.concatenate([rows for _, rows, _ in open_])], return_index=True)
    where = np.concatenate([rows for _, rows, _ in open_])[at]
    row, found = filters_for(width, n, cosine).decode(unit[where])
    order = np.argsort(row, kind="stable")
    filters = np.split(found[order], np.cumsum(np.bincount(row, minlength=len(used)))[:-1])
    for code, rows, link in open_:
        link = first_links(link, code, [filters[i] for i in np.searchsorted(used, no[rows])])
        stars = [(no[rows[m]], np.repeat(no[rows[c]], len(m))) for c, m in _stars(link)]
        none = np.zeros(0, np.int64)
        yield no[rows], link @ weight[rows], np.concatenate([none, *(m for m, _ in stars)]), np.concatenate([none, *(c for _, c in stars)])


def _compare(sizes: dict[int, int], cosine: float):
    """Counts and stars of links, from rows sorted by (width, filter, i, j)."""
    names = ("width", "filter", "i", "j")

    def results(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [table.column(c).to_numpy() for c in names]
        part, no, weight = (table.column(c).to_numpy() for c in ("part", "no", "weight"))
        edges = np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1, [len(no)]])
        flat = pa.concat_arrays([c.flatten() for c in table.column("vector").chunks]).to_numpy(zero_copy_only=False)
        begins = np.cumsum(keys[0].astype(np.int64)) - keys[0]
        for width in np.unique(keys[0]).tolist():
            first, last = np.searchsorted(keys[0], [width, width + 1])
            unit = unit_rows(flat[begins[first]:begins[first] + width * (last - first)].reshape(-1, width).astype(float))
            cells = [(int(keys[1][a]), bool(keys[2][a] == keys[3][a]), slice(a - first, b - first))
                     for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) if b - a > 1 and first <= a < last]
            for who, n, member, centre in compare_cells(width, sizes[width], cosine, cells, part[first:last], no[first:last], weight[first:last], unit):
                yield pa.RecordBatch.from_pydict({"no": np.concatenate([who, member]), "n": np.concatenate([n, np.zeros(len(member), np.int64)]),
                                                  "first": pa.concat_arrays([pa.nulls(len(who), pa.int64()), pa.array(centre, pa.int64())])})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = [batch.column(c)[-1].as_py() for c in names]
            same = np.all([table.column(c).to_numpy() == v for c, v in zip(names, last, strict=True)], axis=0)
            whole = int(same.argmax())                  # rows are sorted: the last cell may go on in the next batch
            if whole:
                yield from results(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield from results(pa.Table.from_batches(held))
    return compare


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id: one row for every row."""
    plain = landed(rows.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable(F.col(vector_col)), F.col(vector_col)).alias("vector")), "cap-rows")
    vectors = (plain.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("head"), F.count(F.lit(1)).alias("weight"))
               .withColumn("no", F.monotonically_increasing_id()))
    vectors = landed(vectors, "cap-vectors")
    sizes = {r.width: r.n for r in vectors.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()}   # one row a width
    taken = landed(vectors.select("no", "vector").mapInArrow(_decoded(sizes, cosine), "width int, filter long, no long"), "cap-filters")
    counts = taken.groupBy("width", "filter").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = counts.select("width", "filter", F.ceil(F.col("_n") / PART).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("no", "filter"), F.col("parts")).cast("int")
    cells = (taken.join(parts, ["width", "filter"]).withColumn("part", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("width", "filter", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "no"))
    wide = cells.join(vectors.select("no", "weight", "vector"), "no").select("width", "filter", "i", "j", "part", "no", "weight", "vector")
    key = ["width", "filter", "i", "j"]
    found = landed(wide.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare(sizes, cosine), "no long, n long, first long"), "cap-links")
    stars = found.where("first is not null").select(F.col("first").alias("src"), F.col("no").alias("dst")).distinct()
    links = found.groupBy("no").agg(F.sum("n").alias("n"))
    whole = vectors.select("no", "head", "weight", F.xxhash64("vector").alias("hash"), F.col("vector").alias("_v")).join(links, "no", "left")
    if not stars.isEmpty():
        component = connected_components(build_graph(stars)).withColumnRenamed("id", "no")
        whole = whole.join(component, "no", "left").withColumn("component", F.coalesce("component", "no"))
    else:
        whole = whole.withColumn("component", F.col("no"))
    whole = landed(whole, "cap-parts")
    heads = whole.groupBy("component").agg(F.min("head").alias("component_id"))
    named = whole.join(heads, "component").select("hash", "_v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    hot = [r.hash for r in whole.where("weight > 1000000").select("hash").limit(1000).collect()]
    linked = salted_join(plain.where("vector is not null").withColumn("hash", F.xxhash64("vector")), named, "hash", "inner", hot=hot).where("vector = _v")
    alone = plain.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone)
