"""Distance, neighbour, PCA and projection queries over embeddings and lineitem."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.numbers import r6
from lumenframe.functions import words as W
from lumenframe.operators import linear, neighbours, svd
from lumenframe.operators.aggregate import class_mean_vectors
from lumenframe.operators.models import tfidf_vectors
from lumenframe.plans.book import Book, table

BOOK = Book()


def vecs(s, d):
    return table(s, d, "embeddings")


V = """v as (select vec_id, "label", embedding::double[] as e from embeddings)"""
MEANS = """x as (select "label", unnest(embedding)::double as v, generate_subscripts(embedding, 1) as j from embeddings),
  y as (select "label", j, avg(v) as v from x group by 1, 2), m as (select "label", list(v order by j) as e from y group by 1)"""


def neighbours_in_order(s, d):
    a = vecs(s, d).select("vec_id", neighbours.as_double("embedding").alias("a"))
    b = vecs(s, d).select((F.col("vec_id") - 1).alias("vec_id"), neighbours.as_double("embedding").alias("b"))
    return a.join(b, "vec_id")


@BOOK.add("vector_distance", "L01", f"""with {V} select a.vec_id, round(list_distance(a.e, b.e), 6) as distance
  from v a join v b on b.vec_id = a.vec_id + 1""")
def _(s, d):
    return neighbours_in_order(s, d).select("vec_id", r6(neighbours.vector_distance(F.col("a"), F.col("b"))).alias("distance"))


@BOOK.add("vector_angle", "L02", f"""with {V} select a.vec_id, round(acos(greatest(-1, least(1, list_cosine_similarity(a.e, b.e)))), 6) as angle
  from v a join v b on b.vec_id = a.vec_id + 1""")
def _(s, d):
    return neighbours_in_order(s, d).select("vec_id", r6(neighbours.vector_angle(F.col("a"), F.col("b"))).alias("angle"))


@BOOK.add("pairwise_distances", "L03", f"""with {V}, {MEANS} select vec_id as i, m."label" as j, round(list_distance(v.e, m.e), 6) as distance
  from v, m""")
def _(s, d):
    means = class_mean_vectors(vecs(s, d), "embedding", "label").groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda x: x["mean"]).alias("embedding"))
    return neighbours.pairwise_distances(vecs(s, d), means, "vec_id", "label", "embedding").withColumn("distance", r6("distance"))


@BOOK.add("nearest", "L04", f"""with {V} select id, other, round(distance, 6) as distance, rn as "rank" from (select a.vec_id as id, b.vec_id as other,
  list_distance(a.e, b.e) as distance, row_number() over (partition by a.vec_id order by round(list_distance(a.e, b.e), 9), b.vec_id)::int as rn
  from v a join v b on a.vec_id <> b.vec_id) where rn <= 5""")
def _(s, d):
    out = neighbours.nearest(vecs(s, d), vecs(s, d), "vec_id", "embedding", 5, exclude_self=True)
    return out.withColumn("distance", r6("distance"))


@BOOK.add("knn_classify", "L05", f"""with {V}, n as (select a.vec_id as id, b."label" as predicted, row_number() over (partition by a.vec_id
    order by round(list_distance(a.e, b.e), 9), b.vec_id) as rn from v a join v b on a.vec_id % 5 = 0 and b.vec_id % 5 <> 0),
  c as (select id, predicted, count(*) as votes from n where rn <= 10 group by 1, 2)
  select id, predicted, votes from (select *, row_number() over (partition by id order by votes desc, predicted) as rn from c) where rn = 1""")
def _(s, d):
    rows = vecs(s, d)
    return neighbours.knn_classify(rows.where("vec_id % 5 <> 0"), rows.where("vec_id % 5 = 0"), "vec_id", "embedding", "label", 10)


@BOOK.add("class_distance_matrix", "L06", f"""with {MEANS} select a."label", b."label" as other, round(list_distance(a.e, b.e), 6) as distance,
  round(acos(greatest(-1, least(1, list_cosine_similarity(a.e, b.e)))), 5) as angle from m a, m b""")
def _(s, d):
    out = neighbours.class_distance_matrix(vecs(s, d), "embedding", "label")
    return out.select("label", "other", r6("distance").alias("distance"), r6("angle", 5).alias("angle"))


STD = ["l_quantity", "l_extendedprice", "l_discount"]


@BOOK.add("standardize", "L07", "select l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (select avg({c}) from lineitem)) / (select stddev_pop({c}) from lineitem), 6) + 0.0 as {c}_std" for c in STD) + " from lineitem")
def _(s, d):
    out = linear.standardize(table(s, d, "lineitem"), STD)
    return out.select("l_orderkey", "l_linenumber", *[r6(f"{c}_std").alias(f"{c}_std") for c in STD])


@BOOK.add("pca", "L08")
def _(s, d):
    model = linear.pca(vecs(s, d), "embedding", 5)
    scores = model.scores(vecs(s, d), "embedding").select("vec_id", F.posexplode("scores").alias("component", "score"))
    return scores.join(model.table(s), "component").withColumn("score", r6("score"))


@BOOK.add("pca_reconstruct", "L09")
def _(s, d):
    model = linear.pca(vecs(s, d), "embedding", 10)
    out = model.reconstruct(model.scores(vecs(s, d), "embedding"), "scores")
    gap = neighbours.vector_distance(neighbours.as_double("embedding"), F.col("rebuilt"))
    return out.select("vec_id", r6(gap * gap).alias("squared_error"))


@BOOK.add("pca_error_curve", "L10")
def _(s, d):
    return linear.pca_error_curve(vecs(s, d), "embedding", list(range(1, 21)), 0.5)[0].withColumn("error", r6("error"))


@BOOK.add("pca_wide", "L11")
def _(s, d):
    means = class_mean_vectors(vecs(s, d), "embedding", "label").groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda x: x["mean"]).alias("mean"))
    return linear.pca_wide(means, "label", "mean", 4).table(s)


def document_vectors(s, d):
    """Every document as a unit tf-idf row, with a mark on every fourth one."""
    docs = table(s, d, "documents").select("doc_id", "text", (F.col("doc_id") % 4 == 0).alias("held_out"))
    return tfidf_vectors(docs, W.word_tokens("text", W.WORD2), keep=["doc_id", "held_out"])


@BOOK.add("truncated_svd", "L12")
def _(s, d):
    """Every document in 120 components."""
    rows = document_vectors(s, d)
    return components_of(svd.svd_of_blocks(rows.blocks, 120).transform_blocks(rows.blocks, ["doc_id"]))


def components_of(reduced):
    return reduced.select("doc_id", F.posexplode("reduced").alias("component", "value")).withColumn("value", r6("value"))


@BOOK.add("truncated_svd_held_out", "L12")
def _(s, d):
    """A quarter of the documents in the 120 components that the others have."""
    rows = document_vectors(s, d)
    model = svd.svd_of_blocks(rows.part("held_out", False).blocks, 120)
    return components_of(model.transform_blocks(rows.part("held_out", True).blocks, ["doc_id"]))


BASIS = [float(j % 3 + 1) for j in range(64)]


@BOOK.add("project", "L13", f"""with {V}, p as (select vec_id, list_dot_product(e, {BASIS}::double[]) / list_dot_product({BASIS}::double[],
  {BASIS}::double[]) as c from v) select vec_id, (j - 1)::int as dim, round(c * ({BASIS}::double[])[j], 6) + 0.0 as "value"
  from p, unnest(range(1, 65)) as u(j)""")
def _(s, d):
    out = linear.project(vecs(s, d), "embedding", BASIS).select("vec_id", F.posexplode("projected").alias("dim", "value"))
    return out.withColumn("value", r6("value"))


@BOOK.add("project_plane", "L13", """with x as (select vec_id, unnest(embedding)::double as v, generate_subscripts(embedding, 1) - 1 as j from embeddings),
  f as (select vec_id, regr_intercept(v, j) as a, regr_slope(v, j) as b from x group by 1)
  select vec_id, j::int as dim, round(a + b * j, 6) + 0.0 as "value" from f, unnest(range(64)) as u(j)""")
def _(s, d):
    basis = [[1.0, float(j)] for j in range(64)]
    out = linear.project(vecs(s, d), "embedding", basis)
    return out.select("vec_id", F.posexplode("projected").alias("dim", "value")).withColumn("value", r6("value"))


FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@BOOK.add("select_features", "L14", " union all ".join(f"""select '{c}' as feature, round(var_pop({c}), 6) as variance,
  round(corr({c}, l_extendedprice), 6) + 0.0 as corr, var_pop({c}) >= 0.001 and abs(corr({c}, l_extendedprice)) >= 0.002 as kept from lineitem"""
                                                     for c in FEATURES))
def _(s, d):
    out = linear.select_features(table(s, d, "lineitem"), FEATURES, "l_extendedprice", 0.001, 0.002)
    return out.select("feature", r6("variance").alias("variance"), r6("corr").alias("corr"), "kept")

