"""Fitted models and random walks where SQL can state the result.

The full settings are registered in the other modules. Here the same operators run where theory fixes the answer: a
stump is an arg-min of impurity, all components together hold the whole variance, walks only use edges.
"""
from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.functions.numbers import r6
from lumenframe.operators import graph, linear, models, svd, textvec
from lumenframe.operators.aggregate import class_mean_vectors
from lumenframe.plans.book import Book, table
from lumenframe.plans.graphs import CLOSE, close
from lumenframe.plans.models import CENTRES, class_centres, labelled, points, text_features
from lumenframe.plans.textvec import ROWS, ROWS2, TFIDF
from lumenframe.plans.vectors import MEANS, document_vectors, vecs

BOOK = Book()

COORDS = """x as (select unnest(embedding)::double as v, generate_subscripts(embedding, 1) as j from embeddings),
  w as (select count(distinct j)::int as width, count(*) as n from x), s as (select sum(vp) as total from (select var_pop(v) as vp from x group by j))"""


def width_of(s, d):
    return vecs(s, d).agg(F.max(F.size("embedding"))).first()[0]


@BOOK.add("pca_total_variance", "L08", f"with {COORDS} select width as components, round(total, 6) as variance, 1.0::double as share from w, s")
def _(s, d):
    """All components together hold the whole variance."""
    found = linear.pca(vecs(s, d), "embedding", width_of(s, d)).table(s)
    return found.agg(F.count(F.lit(1)).cast("int").alias("components"), r6(F.sum("variance")).alias("variance"), r6(F.sum("share")).alias("share"))


@BOOK.add("pca_reconstruct_full", "L09", "select vec_id, 0.0::double as squared_error from embeddings")
def _(s, d):
    """With as many components as coordinates every row is rebuilt."""
    model = linear.pca(vecs(s, d), "embedding", width_of(s, d))
    out = model.reconstruct(model.scores(vecs(s, d), "embedding"), "scores")
    gap = F.zip_with("embedding", "rebuilt", lambda a, b: a - b)
    return out.select("vec_id", r6(F.aggregate(gap, F.lit(0.0), lambda acc, g: acc + g * g)).alias("squared_error"))


@BOOK.add("pca_error_ends", "L10", f"with {COORDS} select 0 as k, round(total, 6) as error from s union all select width, 0.0 from w")
def _(s, d):
    """No component leaves the whole variance as error, all of them leave none."""
    return linear.pca_error_curve(vecs(s, d), "embedding", [0, width_of(s, d)])[0].withColumn("error", F.abs(r6("error")))


@BOOK.add("pca_wide_total", "L11", f"""with {MEANS}, s as (select sum(vp) as total from (select var_pop(v) as vp from y group by j))
  select i::int as component, round(total, 6) as total from s, range(4) as u(i)""")
def _(s, d):
    """The variance of a component over its share is the total variance."""
    means = class_mean_vectors(vecs(s, d), "embedding", "label").groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean"))), lambda x: x["mean"]).alias("mean"))
    return linear.pca_wide(means, "label", "mean", 4).table(s).select("component", r6(F.col("variance") / F.col("share")).alias("total"))


@BOOK.add("truncated_svd_pairs", "L12", """select i::int as component, (select count(*) from documents) as n, 0.0::double as gap from range(120) as u(i)""")
def _(s, d):
    """Rows in the coordinates of the right vectors have the singular values as column lengths."""
    rows = document_vectors(s, d)
    model = svd.svd_of_blocks(rows.blocks, 120)
    cells = model.transform_blocks(rows.blocks, ["doc_id"]).select(F.posexplode("reduced").alias("component", "value"))
    length = F.sqrt(F.sum(F.col("value") * F.col("value")))
    want = F.get(linear.literal_vector(model.values), F.col("component"))
    return (cells.groupBy("component").agg(F.count(F.lit(1)).alias("n"), length.alias("length"))
            .select("component", "n", F.abs(r6(F.col("length") - want, 4)).alias("gap")))


@BOOK.add("word2vec_words", "V08", f"with {ROWS} select token as word, 100 as width from rows_ group by 1 having count(*) >= 5")
def _(s, d):
    """One vector for each word that occurs five times or more."""
    texts = table(s, d, "documents").select("text")
    model = textvec.word2vec(texts, W.word_tokens("text"), partitions=s.sparkContext.defaultParallelism)
    return model.getVectors().select("word", F.size(vector_to_array("vector")).alias("width"))


@BOOK.add("logistic_regression_total", "M05", """select count(*) as n, sum(quality)::double as positives, sum(quality)::double as expected
  from labels join documents using (doc_id)""")
def _(s, d):
    """At the optimum with a free intercept the probabilities add up to the positives; a strong penalty makes the fit get there."""
    rows = models.tfidf_vectors(labelled(s, d).select("doc_id", "quality", "text"), W.word_tokens("text", W.WORD2), keep=["doc_id", "quality"])
    scored = models.logistic_regression(rows, "quality", "l2", 0.01, tol=1e-9).scores()
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").cast("double").alias("positives"),
                      r6(F.sum("probability"), 0).alias("expected"))


@BOOK.add("odds_ratios_binary", "M06", """with q as (select quality, len(regexp_replace("text", '[^0-9]', '', 'g')) % 2 as x from labels join documents using (doc_id)),
  c as (select x, sum(quality) / sum(1 - quality)::double as odds from q group by 1)
  select '(Intercept)' as term, round(odds, 3) as odds_ratio from c where x = 0
  union all select 'odd_digits', round(a.odds / b.odds, 3) from c a, c b where a.x = 1 and b.x = 0""")
def _(s, d):
    """One feature of 0 and 1: the odds ratio is that of the two by two table."""
    rows = text_features(s, d).select("quality", (F.col("n_digits") % 2).alias("odd_digits"))
    return models.odds_ratios(rows, ["odd_digits"], "quality").withColumn("odds_ratio", r6("odds_ratio", 3))


SIZED = """q as (select l_orderkey * 8 + l_linenumber as id, floor(l_quantity / 10)::double as tens, (l_quantity + 2 * l_linenumber > 30)::int as bulky from lineitem)"""
STUMP = f"""with {SIZED}, c as (select tens, count(*) as n, sum(bulky) as d from q group by 1),
  t as (select a.tens as edge, sum(b.n) filter (b.tens <= a.tens) as nl, sum(b.d) filter (b.tens <= a.tens) as dl, sum(b.n) filter (b.tens > a.tens) as nr,
    sum(b.d) filter (b.tens > a.tens) as dr from c a, c b group by 1),
  best as (select * from t where nr > 0 order by dl * (nl - dl) / nl::double + dr * (nr - dr) / nr::double, edge limit 1)
  select tens, n, (case when tens <= edge then 2 * dl > nl else 2 * dr > nr end)::double as prediction from c, best"""


def sized(s, d):
    return table(s, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                                          F.floor(F.col("l_quantity") / 10).cast("double").alias("tens"),
                                          (F.col("l_quantity") + 2 * F.col("l_linenumber") > 30).cast("int").alias("bulky"))


def stump(fit):
    """One split of a feature with few values: the arg-min of the Gini impurity, then the majority of each side."""
    def query(s, d):
        rows = sized(s, d)
        model, fitted_rows = fit(rows)
        return model.transform(fitted_rows).groupBy("tens", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return query


BOOK.add("decision_stump", "M07", STUMP)(stump(lambda rows: models.decision_tree(rows, ["tens"], "bulky", depth=1)))
BOOK.add("boosted_stump", "M08", STUMP)(stump(lambda rows: models.boosted_trees(rows, ["tens"], "bulky", n=1)))
BOOK.add("forest_of_stumps", "M09", STUMP)(stump(lambda rows: models.random_forest(rows, ["tens"], "bulky", trees=20, depth=1)))


@BOOK.add("importance_of_one", "M10", """select 'bulky' as target, 1 as "rank", 'tens' as feature, 1.0::double as importance union all select 'bulky', 2, 'same', 0.0""")
def _(s, d):
    """A feature without variance explains nothing."""
    return models.importance_by_target(sized(s, d).withColumn("same", F.lit(1.0)), ["tens", "same"], ["bulky"]).withColumn("importance", r6("importance"))


@BOOK.add("grid_search_stumps", "M11", f"""with {SIZED}, r as (select *, (row_number() over (partition by bulky order by id) - 1) % 10 as fold from q),
  c as (select f.k, tens, count(*) filter (fold <> k) as n, sum(bulky) filter (fold <> k) as d, count(*) filter (fold = k) as hn,
    coalesce(sum(bulky) filter (fold = k), 0) as hd from r, range(10) as f(k) group by 1, 2),
  t as (select a.k, a.tens as edge, sum(b.n) filter (b.tens <= a.tens) as nl, sum(b.d) filter (b.tens <= a.tens) as dl, sum(b.n) filter (b.tens > a.tens) as nr,
    sum(b.d) filter (b.tens > a.tens) as dr from c a join c b on a.k = b.k group by 1, 2),
  best as (select * from t where nr > 0 qualify row_number() over (partition by k order by dl * (nl - dl) / nl::double + dr * (nr - dr) / nr::double, edge) = 1),
  s as (select k, sum(case when (case when tens <= edge then 2 * dl > nl else 2 * dr > nr end) then hd else hn - hd end) / sum(hn)::double as accuracy
    from c join best using (k) group by 1) select 1 as depth, round(avg(accuracy), 6) as accuracy from s""")
def _(s, d):
    """Ten folds of stumps; every fold is fitted on the other nine and judged on its own rows."""
    rows = models.assemble(sized(s, d), ["tens"]).select("id", "features", F.col("bulky").cast("double").alias("bulky"))
    tree = DecisionTreeClassifier(labelCol="bulky", seed=1)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1]).build()
    found = models.grid_search(rows, "id", "bulky", tree, grid, folds=10)
    return s.createDataFrame([(p[tree.maxDepth], round(float(a), 6)) for p, a in zip(grid, found.avgMetrics)], "depth int, accuracy double")


@BOOK.add("kmeans_nearest", "M12", "select count(*) as n, 0::bigint as misplaced from embeddings")
def _(s, d):
    """Every row belongs to its nearest centre."""
    rows = points(s, d)
    model = models.kmeans(rows, 8)
    placed, _ = models.assign_nearest(model.transform(rows), "vec_id", "embedding", [c.tolist() for c in model.clusterCenters()])
    return placed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cluster") != F.col("prediction")).alias("misplaced"))


@BOOK.add("kmeans_one_cluster", "M13", f"with {COORDS} select 1 as k, round(sum(g), 3) as inertia from (select var_pop(v) * count(*) as g from x group by j)")
def _(s, d):
    """One cluster: the sum of squares around the mean."""
    return models.kmeans_elbow(points(s, d), [1]).withColumn("inertia", r6("inertia", 3))


@BOOK.add("cluster_top_weights", "M14", f"""with {TFIDF}, n2 as (select source, count(*) as n from documents group by 1),
  m as (select dense_rank() over (order by source)::int - 1 as cluster, sum(weight) / any_value(n2.n) as weight from t join documents using (doc_id) join n2 using (source) group by source, token)
  select cluster, round(weight, 6) as weight from m qualify row_number() over (partition by cluster order by weight desc) <= 20""")
def _(s, d):
    """Heaviest weights of given centres: the mean vectors of the sources."""
    rows = models.tfidf_vectors(table(s, d, "documents").select("source", "text"), W.word_tokens("text", W.WORD2), keep=["source"])
    return models.group_top_terms(rows, "source", 20).select("cluster", r6("weight").alias("weight"))


@BOOK.add("soft_kmeans_two_rounds", "M16", f"""with {CENTRES}, w as (select vec_id, c, exp(-d) / sum(exp(-d)) over (partition by vec_id) as r from g),
  m2 as (select c, list(mean order by j) as e from (select c, j, sum(r * v) / sum(r) as mean from w join x using (vec_id) group by 1, 2) group by 1),
  g2 as (select vec_id, c, list_sum(list_transform(list_zip(embedding::double[], m2.e), lambda p: pow(p[1] - p[2], 2))) as d from embeddings, m2),
  w2 as (select vec_id, c, exp(-d) / sum(exp(-d)) over (partition by vec_id) as r from g2)
  select c::int as cluster, (j - 1)::int as dim, round(sum(r * v) / sum(r), 6) + 0.0 as mean from w2 join x using (vec_id) group by 1, 2""")
def _(s, d):
    centres, _ = models.soft_kmeans(table(s, d, "embeddings"), "embedding", class_centres(s, d), max_iter=2, tol=0.0)
    return s.createDataFrame([(i, j, float(v)) for i, c in enumerate(centres) for j, v in enumerate(c)],
                             "cluster int, dim int, mean double").withColumn("mean", r6("mean"))


@BOOK.add("random_walk_counts", "G14", f"with {CLOSE} select src as id, 20::bigint as n_walks, 200::bigint as n_steps, 0::bigint as off_edges from e group by 1")
def _(s, d):
    """Walks and nodes per start, and steps along no edge."""
    g = close(s, d)
    paths = graph.random_walks(g, length=10, walks=20).groupBy("walk").agg(F.array_sort(F.collect_list(F.struct("step", "id"))).alias("p"))
    starts = F.get("p", F.lit(0))["id"]
    counts = paths.groupBy(starts.alias("id")).agg(F.count(F.lit(1)).alias("n_walks"), F.sum(F.size("p")).alias("n_steps"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.struct(F.get("p", i - 1)["id"].alias("src"), F.get("p", i)["id"].alias("dst")))
    off = graph.off_edges(g, paths.select(starts.alias("id"), F.inline(pairs)))
    lost = off.groupBy("id").agg(F.count(F.lit(1)).alias("off_edges"))
    return counts.join(lost, "id", "left").select("id", "n_walks", "n_steps", F.coalesce("off_edges", F.lit(0)).cast("long").alias("off_edges"))


@BOOK.add("node_embedding_words", "G15", f"with {CLOSE} select src::varchar as word, 2 as width from e group by 1")
def _(s, d):
    """One vector per node with an edge."""
    found = graph.node_embeddings(graph.random_walks(close(s, d), length=10, walks=5), dim=2, partitions=s.sparkContext.defaultParallelism)
    return found.select("word", F.size(vector_to_array("vector")).alias("width"))
