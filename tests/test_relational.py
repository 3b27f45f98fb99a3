import datetime

import pytest
from pyspark.sql import functions as F

from lumenframe.functions import joins, ordering
from lumenframe.operators import aggregate, clean, order, profile, relate, split


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rank_and_running_with_one_hot_group(spark):
    """A group with most of the rows spans several blocks and still counts through."""
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
                                  "id", (F.col("id") * 7919 % 1000).alias("o"))
    got = ordering.running(df.withColumn("one", F.lit(1)), ["g"], ["o", "id"], {"rn": ("sum", "one"), "best": ("max", "id")})
    by_group = {}
    for r in got.collect():
        by_group.setdefault(r["g"], []).append((r["o"], r["id"], r["rn"], r["best"]))
    assert sum(len(v) for v in by_group.values()) == 1000
    for items in by_group.values():
        items.sort()
        assert [i[2] for i in items] == list(range(1, len(items) + 1))
        top = -1
        for i in items:
            top = max(top, i[1])
            assert i[3] == top
    blocks = ordering.ordered_blocks(df, ["g", "o", "id"]).where("g = 'hot'").select("_blk").distinct().count()
    assert blocks > 1


def test_ranked_is_complete_and_ordered(spark):
    df = spark.range(500).select("id", (F.col("id") % 13).alias("v"))
    got = ordering.ranked(df, ["-v", "id"]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501))
    assert [(r["v"], r["id"]) for r in got] == sorted(((i % 13, i) for i in range(500)), key=lambda t: (-t[0], t[1]))


def test_salted_join_equals_plain_join(spark):
    big = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert joins.hot_keys(big, "k", 1000) == [1]
        assert rows(joins.salted_join(big, small, "k", how, hot=[1])) == rows(big.join(small, "k", how)) if how != "left" else \
            joins.salted_join(big, small, "k", how, hot=[1]).exceptAll(big.join(small, "k", how)).isEmpty()


def test_salted_join_with_equal_rows_and_nulls(spark):
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 4 == 1, 2).cast("int").alias("k")
    big = spark.range(0, 4000, 1, 8).select(key)
    small = spark.createDataFrame([(1, "a")], "k int, v string")
    for how, n in (("inner", 2000), ("left", 4000), ("left_semi", 2000), ("left_anti", 2000)):
        out = joins.salted_join(big, small, "k", how, hot=[1])
        assert out.count() == n
        assert out.groupBy(*out.columns).count().exceptAll(big.join(small, "k", how).groupBy(*out.columns).count()).isEmpty()

def test_small_side_is_checked(spark):
    with pytest.raises(Exception, match="more than 5 rows"):
        joins.pair_with_small(spark.range(3), spark.range(6).withColumnRenamed("id", "j"), 5).collect()
    assert relate.all_pairs(spark.range(3), spark.range(4).withColumnRenamed("id", "j")).count() == 12


def test_exact_quantiles_and_sketch(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (10.0,), (None,)], "x double")
    r = profile.summary_stats(df, ["x"]).first()
    assert (r["min"], r["q1"], r["median"], r["mean"], r["q3"], r["max"]) == (1.0, 1.75, 2.0, 3.75, 4.0, 10.0)
    assert profile.summary_stats(df, ["x"], accuracy=100).first()["median"] == 2.0


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, None), (4, 1), (5, 3)], "id int, v int")
    assert rows(clean.fill_mode(df, ["v"])) == [(1, 3), (2, 1), (3, 1), (4, 1), (5, 3)]


def test_top_values_skip_first_rank(spark):
    df = spark.createDataFrame([(v,) for v in "aaaabbbccd"], "v string")
    assert [(r["v"], r["rank"]) for r in profile.top_values(df, "v", 2, skip=1).orderBy("rank").collect()] == [("b", 2), ("c", 3)]


def test_century_rule_and_currency(spark):
    df = spark.createDataFrame([("28-Feb-97", "$60,000.00"), ("13-Mar-10", "$1.50"), ("7-Feb-06", "n/a"), ("bad", None)], "d string, p string")
    got = clean.parse_currency(clean.date_to_year(df, "d"), ["p"]).collect()
    assert [r["year"] for r in got] == [1997, 2010, 2006, None]
    assert [r["p"] for r in got] == [60000.0, 1.5, None, None]


def test_growth(spark):
    df = spark.createDataFrame([(1000.0, 1100.0)], "a double, t double")
    assert clean.compound_growth(df, "a", 2, 1).first()["amount"] == 1000.0
    r = clean.compound_growth(df, "a", 2, 6, "t").first()
    assert r["first_day"] == 6 and r["amount"] >= 1100 > 1000 * 1.02 ** 4


def test_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "i int, v string")
    assert rows(clean.encode_first_seen(df, "v", "i", 1).where("v is not null").select("i", "code")) == [(1, 1), (2, 2), (3, 1)]
    assert rows(clean.encode_sorted(df, "v").where("v is not null").select("i", "code")) == [(1, 1), (2, 0), (3, 1)]
    assert clean.encode_sorted(df, "v").count() == 4


def test_transform_kinds(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert [round(r["y"], 6) for r in clean.transform_column(df, "x", "standardize", "y").collect()] == [-0.707107, 0.707107]
    assert [round(r["y"], 6) for r in clean.transform_column(df, "x", "exp", "y").collect()] == [2.718282, 20.085537]
    assert clean.transform_column(df, "x", "inverse_log", "y").first()["y"] is None


def test_dedupe_only_where(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", 0), (4, "a", 0)], "id int, t string, rt int")
    assert rows(relate.dedupe_where(df, F.col("rt") > 0, ["t"], ["id"]).select("id")) == [(1,), (3,), (4,)]


def test_hand_computed_moments(spark):
    df = spark.createDataFrame([([0.0, 3.0], 0.0, 3.0), ([1.0, 4.0], 1.0, 4.0), ([2.0, 5.0], 2.0, 5.0)], "v array<double>, a double, b double")
    assert rows(aggregate.mean_vector(df, "v")) == [(0, 1.0), (1, 4.0)]
    assert {round(r["covariance"], 9) for r in aggregate.covariance_matrix(df, ["a", "b"]).collect()} == {round(2 / 3, 9)}


def test_sliding_and_concat(spark):
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(5)] + [(2, 0, "x")], "g int, o int, t string")
    got = order.sliding_groups(df, ["g"], ["o"], "t", 3)
    assert sorted(r["items"] for r in got.collect()) == [["t0", "t1", "t2"], ["t1", "t2", "t3"], ["t2", "t3", "t4"]]
    assert aggregate.concat_top(df, "g", ["o"], "t", 2).where("g = 1").first()["names"] == "t0 , t1"


def test_splits_are_disjoint_and_complete(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    for got in (split.split_random(df, "id", {"a": 0.6, "b": 0.4}), split.split_ordered(df, ["id"], n=250),
                split.split_stratified(df, "id", "y", 0.7), split.assign_folds(df, "id", "y", 10).withColumnRenamed("fold", "part")):
        assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert split.split_ordered(df, ["id"], n=250).where("part = 'first'").agg(F.max("id")).first()[0] == 249
    sizes = {(r["y"], r["part"]): r["n"] for r in split.split_stratified(df, "id", "y", 0.7).groupBy("y", "part").agg(F.count("*").alias("n")).collect()}
    assert sizes[(0, "train")] == 525 and sizes[(1, "train")] == 175
    folds = split.assign_folds(df, "id", "y", 10).groupBy("y", "fold").count().collect()
    assert len(folds) == 20 and {r["count"] for r in folds} == {75, 25}


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, datetime.date(2020, 1, 1))], "id int, d date")
    b = spark.createDataFrame([(2, "x")], "id int, s string")
    assert relate.union_aligned(a, b).columns == ["id", "d", "s"]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    assert {r["bin"]: r["n"] for r in profile.histogram(df, "x", 5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
