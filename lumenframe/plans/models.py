"""Model queries over lineitem, orders, documents with labels, and embeddings."""
from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.functions.numbers import r6
from lumenframe.functions.ordering import cut
from lumenframe.operators import models
from lumenframe.operators.aggregate import class_mean_vectors
from lumenframe.operators.sparselogit import sparse_logistic
from lumenframe.operators.terms import term_rows
from lumenframe.operators.textvec import tfidf
from lumenframe.plans.book import Book, table

BOOK = Book()
TEXT_FEATURES = ["n_chars", "n_words", "n_digits", "n_upper"]


def labelled(s, d):
    return table(s, d, "labels").join(table(s, d, "documents"), "doc_id")


def text_features(s, d):
    count = lambda p: F.length(F.regexp_replace("text", p, ""))
    return labelled(s, d).select("doc_id", F.col("quality").cast("double").alias("quality"), F.col("n_chars").cast("double").alias("n_chars"),
                                 F.size(W.tokenize_space("text")).cast("double").alias("n_words"), count("[^0-9]").cast("double").alias("n_digits"),
                                 count("[^A-Z]").cast("double").alias("n_upper"))


def coefficients(s, model, names):
    rows = [("(Intercept)", model.intercept), *zip(names, model.coefficients)]
    return s.createDataFrame([(n, float(v)) for n, v in rows], "term string, coefficient double")


@BOOK.add("linear_regression", "M01", """select unnest(['(Intercept)', 'l_quantity']) as term, unnest([round(regr_intercept(l_extendedprice, l_quantity), 4),
  round(regr_slope(l_extendedprice, l_quantity), 4)]) as coefficient from lineitem""")
def _(s, d):
    model, _ = models.linear_regression(table(s, d, "lineitem"), ["l_quantity"], "l_extendedprice")
    return coefficients(s, model, ["l_quantity"]).withColumn("coefficient", r6("coefficient", 4))


NORMAL = """q as (select l_orderkey, l_linenumber, l_quantity::double as x1, l_discount::double as x2, l_tax::double as x3, l_extendedprice::double as y from lineitem),
  s as (select avg(x1) as m1, avg(x2) as m2, avg(x3) as m3, avg(y) as my, var_pop(x1) as a, covar_pop(x1, x2) as b, covar_pop(x1, x3) as c, var_pop(x2) as d,
    covar_pop(x2, x3) as e, var_pop(x3) as f, covar_pop(x1, y) as p, covar_pop(x2, y) as q, covar_pop(x3, y) as r from q),
  t as (select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det from s),
  w as (select *, (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det as b1, (a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - q * c)) / det as b2,
    (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - d * c)) / det as b3 from t)"""


@BOOK.add("linear_regression_predictions", "M01", f"""with {NORMAL} select l_orderkey, l_linenumber,
  round(my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3), 2) as prediction from q, w""")
def _(s, d):
    _, out = models.linear_regression(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", r6("prediction", 2).alias("prediction"))


@BOOK.add("regression_standardized", "M04", """with f as (select avg(l_quantity) as m, stddev_pop(l_quantity) as sd, regr_slope(l_extendedprice, l_quantity) as b,
    regr_intercept(l_extendedprice, l_quantity) as a from lineitem where l_orderkey % 4 <> 0)
  select l_orderkey, l_linenumber, round((l_quantity - m) / sd, 6) + 0.0 as scaled, round(a + b * l_quantity, 3) as prediction from lineitem, f where l_orderkey % 4 = 0""")
def _(s, d):
    rows = table(s, d, "lineitem")
    _, out = models.regression_standardized(rows.where("l_orderkey % 4 <> 0"), rows.where("l_orderkey % 4 = 0"), ["l_quantity"], "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", r6("l_quantity_std").alias("scaled"), r6("prediction", 3).alias("prediction"))


@BOOK.add("logistic_regression", "M05")
def _(s, d):
    rows = models.tfidf_vectors(labelled(s, d).select("doc_id", "quality", "text"), W.word_tokens("text", W.WORD2), keep=["doc_id", "quality"])
    model = models.logistic_regression(rows, "quality", "l2", 10.0)
    return model.scores().select("doc_id", "quality", r6("probability", 3).alias("score"))


def sparse_fit(s, d):
    """(labelled rows, probabilities) of the model with its weights in a table, at inverse penalty 10."""
    rows = cut(labelled(s, d).select(F.col("doc_id").alias("key"), F.col("quality").alias("label"), "text"))
    entries = cut(tfidf(rows, "key", W.word_tokens("text", W.WORD2)).select("key", F.col("token").alias("term"), F.col("weight").alias("value")))
    return rows, sparse_logistic(entries, rows, 10.0).predict(entries, rows)


@BOOK.add("sparse_logistic_total", "M05", """select count(*) as n, sum(quality)::double as positives, sum(quality)::double as expected
  from labels join documents using (doc_id)""")
def _(s, d):
    """At the optimum with a free intercept the probabilities add up to the positives, at a weak penalty too."""
    rows, scored = sparse_fit(s, d)
    return rows.join(scored, "key").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("double").alias("positives"), r6(F.sum("probability"), 0).alias("expected"))


@BOOK.add("odds_ratios", "M06")
def _(s, d):
    scaled = text_features(s, d).select("quality", (F.col("n_chars") / 1000).alias("n_chars"), (F.col("n_digits") / 10).alias("n_digits"))
    return models.odds_ratios(scaled, ["n_chars", "n_digits"], "quality").withColumn("odds_ratio", r6("odds_ratio", 4))


def scored_rows(model, rows):
    return model.transform(rows).select("doc_id", "quality", "prediction")


@BOOK.add("decision_tree", "M07")
def _(s, d):
    return scored_rows(*models.decision_tree(text_features(s, d), TEXT_FEATURES, "quality", folds=10, key="doc_id"))


def held_out_scores(fit):
    """Accuracy of a classifier on the fifth of the rows that it was not fitted on, and on the rest."""
    def query(s, d):
        rows = text_features(s, d).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
        model, _ = fit(rows.where("not held_out"), TEXT_FEATURES, "quality")
        label = F.col("quality").cast("double")           # classes 0 and 1: the index of a class is its value
        scored = model.transform(models.assemble(rows, TEXT_FEATURES))
        return scored.groupBy("held_out").agg(F.count(F.lit(1)).alias("n"), r6(F.avg((F.col("prediction") == label).cast("double")), 4).alias("accuracy"))
    return query


BOOK.add("decision_tree_held_out", "M07")(held_out_scores(models.decision_tree))
BOOK.add("boosted_trees_held_out", "M08")(held_out_scores(models.boosted_trees))
BOOK.add("random_forest_held_out", "M09")(held_out_scores(models.random_forest))


@BOOK.add("boosted_trees", "M08")
def _(s, d):
    return scored_rows(*models.boosted_trees(text_features(s, d), TEXT_FEATURES, "quality"))


@BOOK.add("random_forest", "M09")
def _(s, d):
    return scored_rows(*models.random_forest(text_features(s, d), TEXT_FEATURES, "quality"))


@BOOK.add("importance_by_target", "M10")
def _(s, d):
    rows = table(s, d, "orders").withColumn("month", F.month("o_orderdate").cast("double"))
    out = models.importance_by_target(rows, ["o_totalprice", "o_custkey", "month"], ["o_orderstatus", "o_orderpriority"])
    return out.withColumn("importance", r6("importance", 4))


@BOOK.add("grid_search", "M11")
def _(s, d):
    """One set of vectors for all folds: quick, but vocabulary and weights have seen the held-out folds."""
    rows = models.tfidf_vectors(labelled(s, d).select("doc_id", "quality", "text"), W.word_tokens("text", W.WORD2), keep=["doc_id", "quality"])
    grid = [{"reg_param": r} for r in (0.001, 0.01)]
    found = models.text_grid_search(rows, "doc_id", "quality", grid, folds=10, max_iter=20)
    return s.createDataFrame([(p["reg_param"], a) for p, a in zip(grid, found)], "reg_param double, accuracy double")


@BOOK.add("grid_search_pipeline", "M11")
def _(s, d):
    """Term weights on and off against the penalty over ten folds; vocabulary and weights are learned inside each fold."""
    rows = term_rows(labelled(s, d).select("doc_id", "quality", "text"), W.word_tokens("text", W.WORD2), ["doc_id", "quality"])
    grid = [{"use_idf": u, "reg_param": r} for u in (True, False) for r in (0.001, 0.01)]
    found = models.text_grid_search(rows, "doc_id", "quality", grid, folds=10, max_iter=20)
    return s.createDataFrame([(p["use_idf"], p["reg_param"], a) for p, a in zip(grid, found)], "use_idf boolean, reg_param double, accuracy double")


def points(s, d):
    return models.point_vectors(table(s, d, "embeddings"), "embedding")


@BOOK.add("kmeans", "M12")
def _(s, d):
    rows = points(s, d)
    return models.kmeans(rows, 8).transform(rows).select("vec_id", F.col("prediction").alias("cluster"))


@BOOK.add("kmeans_elbow", "M13")
def _(s, d):
    return models.kmeans_elbow(points(s, d), list(range(1, 12))).withColumn("inertia", r6("inertia", 3))


@BOOK.add("cluster_top_terms", "M14")
def _(s, d):
    stop = StopWordsRemover.loadDefaultStopWords("english")
    tokens = F.filter(W.word_tokens("text", W.WORD2), lambda t: ~t.isin(stop))
    rows = models.tfidf_vectors(table(s, d, "documents").select("doc_id", "text"), tokens, keep=["doc_id"])
    return models.cluster_top_terms(models.kmeans(rows, 8, 100), 20)


def class_centres(s, d):
    """Mean vector of each label, as model data on the driver (labels x width numbers)."""
    means = class_mean_vectors(table(s, d, "embeddings"), "embedding", "label").withColumn("mean", F.round("mean", 6))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("m")).orderBy("label").collect()
    return [[e["mean"] for e in r["m"]] for r in rows]


CENTRES = """x as (select vec_id, "label", unnest(embedding)::double as v, generate_subscripts(embedding, 1) as j from embeddings),
  y as (select "label", j, round(avg(v), 6) as v from x group by 1, 2), m as (select row_number() over (order by "label") - 1 as c, list(v order by j) as e from y group by "label"),
  g as (select vec_id, c, embedding::double[] as e, list_sum(list_transform(list_zip(embedding::double[], m.e), lambda p: pow(p[1] - p[2], 2))) as d from embeddings, m)"""


@BOOK.add("assign_nearest", "M15", f"""with {CENTRES} select vec_id, arg_min(c, (round(d, 12), c))::int as cluster from g group by 1""")
def _(s, d):
    placed, _ = models.assign_nearest(table(s, d, "embeddings"), "vec_id", "embedding", class_centres(s, d))
    return placed.select("vec_id", "cluster")


@BOOK.add("assign_nearest_means", "M15", f"""with {CENTRES}, a as (select vec_id, arg_min(c, (round(d, 12), c))::int as cluster from g group by 1)
  select cluster, (j - 1)::int as dim, round(avg(v), 6) + 0.0 as mean from a join x using (vec_id) group by 1, 2""")
def _(s, d):
    _, means = models.assign_nearest(table(s, d, "embeddings"), "vec_id", "embedding", class_centres(s, d))
    return means.withColumn("mean", r6("mean"))


@BOOK.add("soft_kmeans_step", "M16", f"""with {CENTRES}, w as (select vec_id, c, exp(-d) / sum(exp(-d)) over (partition by vec_id) as r from g)
  select c::int as cluster, (j - 1)::int as dim, round(sum(r * v) / sum(r), 6) + 0.0 as mean from w join x using (vec_id) group by 1, 2""")
def _(s, d):
    return models.soft_kmeans_step(table(s, d, "embeddings"), "embedding", class_centres(s, d)).withColumn("mean", r6("mean"))


@BOOK.add("soft_kmeans", "M16")
def _(s, d):
    centres, _ = models.soft_kmeans(table(s, d, "embeddings"), "embedding", class_centres(s, d))
    return s.createDataFrame([(i, j, float(v)) for i, c in enumerate(centres) for j, v in enumerate(c)], "cluster int, dim int, mean double")
