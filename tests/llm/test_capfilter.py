"""Near-duplicate vectors against all pairs in numpy."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import capfilter
from lumenframe.llm.queries import BOOK

FOLDER = "/root/testdata/sf0.001"


def brute(rows, cosine=0.9):
    """(id, links, component) of each row; every row is a vector."""
    def fit(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [fit(v) for _, v in rows]
    unit = [np.array(v) / max(abs(x) for x in v) if g else None for (_, v), g in zip(rows, good, strict=True)]
    near = [[j for j in range(len(rows)) if i != j and good[i] and good[j] and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] / math.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= cosine] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near[f] if j not in seen]
            seen |= set(front)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids, default=None)))
    return sorted(out, key=str)


def pairs_at(cosine: float, width: int, n: int, seed: int = 0):
    rng = np.random.default_rng(seed)
    a, g = capfilter.unit_rows(rng.standard_normal((n, width))), rng.standard_normal((n, width))
    g = capfilter.unit_rows(g - (g * a).sum(axis=1, keepdims=True) * a)
    return a, cosine * a + math.sqrt(1 - cosine * cosine) * g


@pytest.mark.parametrize("width,n", [(64, 500), (64, 50_000), (64, 1_000_000), (3, 1000), (200, 10_000)])
def test_pairs_at_the_bound_share_a_filter(width, n):
    a, b = pairs_at(0.9, width, 1500)
    filters = capfilter.Filters(width, n, 0.9)
    one, two = (set(zip(*(x.tolist() for x in filters.decode(v)), strict=True)) for v in (a, b))
    assert len({r for r, _ in one & two}) >= 0.995 * len(a)
    assert len(one) < 120 * len(a)                                       # the work follows the number of vectors


@pytest.mark.parametrize("blocks", [2, 3])
def test_list_decoding_finds_every_filter_that_takes_a_vector(blocks, monkeypatch):
    monkeypatch.setattr(capfilter, "TWO_BLOCKS", 1 << 24 if blocks == 2 else 0)
    filters = capfilter.Filters(24, 3000, 0.9)
    code, x = filters.codes[0], pairs_at(0.5, 24, 60)[1]
    assert filters.blocks == blocks
    t = code.turned(x)
    total = np.zeros((60, 1))
    for a, b, d in zip(code.cuts, code.cuts[1:], code.directions):
        total = (total[:, :, None] + (t[:, a:b] @ d.T)[:, None, :]).reshape(60, -1)
    want = set(zip(*(v.tolist() for v in np.nonzero(total >= np.minimum(filters.bound, total.max(axis=1))[:, None])), strict=True))
    row, found = code.decode(x)
    assert set(zip(row.tolist(), found.tolist(), strict=True)) == want and len(row) == len(want)
    alone = [code.decode(x[i:i + 1])[1].tolist() for i in range(60)]      # the same filters in any company
    assert sorted((i, f) for i, fs in enumerate(alone) for f in fs) == sorted(want)


def test_groups_copies_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(150)]
    for k in range(12):                                                   # near copies, some of them in chains
        base = rng.standard_normal(24)
        rows += [(1000 + 20 * k + j, (base + (0.05 + 0.04 * k) * rng.standard_normal(24)).tolist()) for j in range(12)]
    rows += [(2000 + i, rows[160][1]) for i in range(6)] + [(5, rows[160][1]), (None, rows[170][1]), (None, [5.0, 7.0])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [math.nan] * 24), (3004, [None] + [1.0] * 23), (3005, [math.inf] + [1.0] * 23)]
    rows += [(3010, [1e200, 2e200]), (3011, [1e-200, 2e-200]), (3012, [1.0, 2.0]), (3013, [3.0]), (3014, [7.0]), (3015, [-1.0])]
    want = brute(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"no": F.lit(1), "weight": F.lit("x"), "hash": F.lit(0)}).repartition(4)
    for part in (capfilter.PART, 3):                                      # parts of 3: every group is compared part by part
        monkeypatch.setattr(capfilter, "PART", part)
        got = capfilter.near_vectors(table)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(n for _, n, _ in want) > 800


def test_a_dense_group_is_counted_once(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.02 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    got = capfilter.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert {(r.n_links, r.component_id) for r in got.collect()} == {(1499, 0)}


def test_empty_table_and_query_columns(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert capfilter.near_vectors(empty).count() == 0
    got = BOOK.entries["op12_near_vectors"].run(spark, FOLDER)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
