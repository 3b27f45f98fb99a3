"""Graph queries over two graphs made from the driver tables.

The trade graph links suppliers with the parts they ship (part keys are offset). The vector graph links embeddings
whose cosine is above 0.3.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.numbers import r6
from lumenframe.operators import graph
from lumenframe.operators.neighbours import similar_pairs
from lumenframe.plans.book import Book, table

BOOK = Book()
OFFSET = 1_000_000_000_000


def trade(s, d):
    edges = table(s, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + OFFSET).alias("dst"),
                                           F.col("l_quantity").alias("weight"))
    nodes = table(s, d, "supplier").select(F.col("s_suppkey").alias("id")).union(
        table(s, d, "part").select((F.col("p_partkey") + OFFSET).alias("id")))
    return graph.build_graph(edges, nodes)


def close(s, d):
    rows = table(s, d, "embeddings")
    return graph.build_graph(similar_pairs(rows, "vec_id", "embedding", 0.3).select("src", "dst"), rows.select(F.col("vec_id").alias("id")), dense=True)


TRADE = f"""p as (select l_suppkey as a, l_partkey + {OFFSET} as b, sum(l_quantity) as weight from lineitem group by 1, 2),
  e as materialized (select a as src, b as dst, weight from p union all select b, a, weight from p),
  v as materialized (select s_suppkey as id from supplier union select p_partkey + {OFFSET} from part)"""
CLOSE = """m as materialized (select vec_id as id, embedding::double[] as x from embeddings),
  p as materialized (select a.id as a, b.id as b from m a join m b on a.id < b.id and list_cosine_similarity(a.x, b.x) > 0.3),
  e as materialized (select a as src, b as dst from p union all select b, a from p), v as (select id from m)"""
PATHS = """r(s, v, d, sigma) using key (s, v) as (select id, id, 0, 1.0::double from v union select r.s, e.dst, r.d + 1, sum(r.sigma)
    from r join e on r.v = e.src where not exists (select 1 from recurring.r q where q.s = r.s and q.v = e.dst) group by all)"""


@BOOK.add("build_graph", "G01", f"with {TRADE} select (select count(*) from v) as n_nodes, (select count(*) from p) as n_edges")
def _(s, d):
    return graph.graph_size(trade(s, d))


@BOOK.add("connected_components", "G02", f"""with recursive {CLOSE}, c(id, root) as (select id, id from v union select e.dst, c.root from c join e on e.src = c.id)
  select id, min(root) as component from c group by 1""")
def _(s, d):
    return graph.connected_components(close(s, d))


@BOOK.add("component_sizes", "G02", f"""with recursive {CLOSE}, c(id, root) as (select id, id from v union select e.dst, c.root from c join e on e.src = c.id)
  select component, count(*) as size from (select id, min(root) as component from c group by 1) group by 1""")
def _(s, d):
    return graph.component_sizes(graph.connected_components(close(s, d)))


@BOOK.add("degree_centrality", "G03", f"""with {TRADE} select id, round(count(src) / ((select count(*) from v) - 1), 6) as dc from v left join e on src = id group by 1""")
def _(s, d):
    return graph.degree_centrality(trade(s, d)).withColumn("dc", r6("dc"))


@BOOK.add("shortest_levels", "G04", f"""with recursive {CLOSE}, f as (select min(vec_id) as id from embeddings group by "label"),
  {PATHS.replace('from v union', 'from f union')} select s as source, v as id, d as distance from r""")
def _(s, d):
    firsts = table(s, d, "embeddings").groupBy("label").agg(F.min("vec_id").alias("id"))
    return graph.shortest_levels(close(s, d), firsts)


@BOOK.add("closeness", "G05", f"""with recursive {CLOSE}, {PATHS}, t as (select s as id, (count(*) - 1)::double as k, sum(d)::double as far from r group by 1)
  select id, round(case when far > 0 then k / far * k / ((select count(*) from v) - 1) else 0 end, 6) as cc from t""")
def _(s, d):
    return graph.closeness(close(s, d)).withColumn("cc", r6("cc"))


@BOOK.add("harmonic", "G06", f"""with recursive {CLOSE}, {PATHS} select s as id, round(coalesce(sum(1.0::double / d) filter (d > 0), 0), 6) as hc from r group by 1""")
def _(s, d):
    return graph.harmonic(close(s, d)).withColumn("hc", r6("hc"))


@BOOK.add("betweenness", "G07", f"""with recursive {CLOSE}, {PATHS}, n as (select count(*)::double as n from v),
  b as (select x.v as id, sum(x.sigma * y.sigma / z.sigma) as raw from r x join r y on x.v = y.s join r z on z.s = x.s and z.v = y.v
    where x.d + y.d = z.d and x.s <> x.v and y.v <> x.v group by 1)
  select v.id, round(coalesce(raw, 0) / ((n - 1) * (n - 2)), 6) as bc from v left join b using (id), n""")
def _(s, d):
    return graph.betweenness(close(s, d)).withColumn("bc", r6("bc"))


@BOOK.add("betweenness_sources", "G07", f"""with recursive {CLOSE}, {PATHS}, f as (select min(vec_id) as id from embeddings group by "label"),
  n as (select (select count(*) from v)::double as n, (select count(*) from f)::double as k),
  b as (select x.v as id, sum(x.sigma * y.sigma / z.sigma) as raw from r x join r y on x.v = y.s join r z on z.s = x.s and z.v = y.v
    where x.s in (select id from f) and x.d + y.d = z.d and x.s <> x.v and y.v <> x.v group by 1)
  select v.id, round(coalesce(raw, 0) * n / k / ((n - 1) * (n - 2)), 6) as bc from v left join b using (id), n""")
def _(s, d):
    """Only paths from one vector of each label."""
    firsts = table(s, d, "embeddings").groupBy("label").agg(F.min("vec_id").alias("id"))
    return graph.betweenness(close(s, d), sources=firsts).withColumn("bc", r6("bc"))


@BOOK.add("betweenness_pivots", "G07")
def _(s, d):
    """An estimate from 64 drawn sources, with its standard error."""
    g = close(s, d)
    return graph.betweenness(g, sources=graph.pivots(g, 64), spread=True).select("id", r6("bc").alias("bc"), r6("bc_error").alias("bc_error"))


@BOOK.add("closeness_estimate", "G05", f"with {CLOSE} select id, true as near_exact from v")
def _(s, d):
    """Whether the estimate from sketches is within 8 % (five standard errors) of the exact value."""
    return near_exact(s, d, graph.closeness, "cc")


@BOOK.add("harmonic_estimate", "G06", f"with {CLOSE} select id, true as near_exact from v")
def _(s, d):
    """Whether the estimate from sketches is within 8 % (five standard errors) of the exact value."""
    return near_exact(s, d, graph.harmonic, "hc")


def near_exact(s, d, measure, name):
    g = close(s, d)
    about = measure(g, graph.distance_sketch(g)).withColumnRenamed(name, "about")
    return measure(g).join(about, "id").select("id", (F.abs(F.col("about") - F.col(name)) <= 0.08 * F.col(name)).alias("near_exact"))


ROUNDS = 8


def eigen_sql():
    steps = ["x0 as materialized (select id, 1.0::double as x from v)"]
    for i in range(1, ROUNDS + 1):
        steps.append(f"""x{i} as materialized (select id, sum(x) / 1000 as x from (select dst as id, x from e join x{i - 1} on src = id
          union all select id, x from x{i - 1}) group by 1)""")
    return f"with {TRADE}, {', '.join(steps)} select id, round(x / sqrt((select sum(x * x) from x{ROUNDS})), 6) as ec from x{ROUNDS}"


@BOOK.add("eigenvector_centrality", "G08", eigen_sql())
def _(s, d):
    return graph.eigenvector_centrality(trade(s, d), ROUNDS, None).withColumn("ec", r6("ec"))


@BOOK.add("eigenvector_centrality_converged", "G08")
def _(s, d):
    """The same to convergence: 100 rounds or a change below 1e-6."""
    return graph.eigenvector_centrality(trade(s, d)).withColumn("ec", r6("ec"))


@BOOK.add("clustering", "G09", f"""with {CLOSE}, t as (select x.src as id, count(*)::double as t from e x join e y on x.src = y.src and x.dst < y.dst
    join e z on z.src = x.dst and z.dst = y.dst group by 1), g as (select id, count(src) as k from v left join e on src = id group by 1)
  select id, round(case when k > 1 then 2 * coalesce(t, 0) / (k * (k - 1)) else 0 end, 6) as coeff from g left join t using (id)""")
def _(s, d):
    return graph.clustering(close(s, d)).withColumn("coeff", r6("coeff"))


def pagerank_sql():
    steps = ["n as (select count(*)::double as n from v)", "w as materialized (select src, dst, weight / sum(weight) over (partition by src) as w from e)",
             "x0 as materialized (select id, 1 / n as x from v, n)"]
    for i in range(1, ROUNDS + 1):
        steps.append(f"""x{i} as materialized (select v.id, 0.85 * (coalesce(any_value(q.x), 0) + any_value(l.x) / any_value(n)) + 0.15 / any_value(n) as x
          from v left join (select dst as id, sum(x * w) as x from w join x{i - 1} on src = id group by 1) q using (id), n,
          (select coalesce(sum(x) filter (id not in (select src from e)), 0) as x from x{i - 1}) l group by 1)""")
    return f"with {TRADE}, {', '.join(steps)} select id, round(x * 1000, 6) as pr_thousandths from x{ROUNDS}"


@BOOK.add("pagerank", "G10", pagerank_sql())
def _(s, d):
    return graph.pagerank(trade(s, d), 0.85, ROUNDS, None).select("id", r6(F.col("pr") * 1000).alias("pr_thousandths"))


@BOOK.add("pagerank_converged", "G10")
def _(s, d):
    """The same to convergence: 100 rounds or a change below 1e-6."""
    return graph.pagerank(trade(s, d)).select("id", r6(F.col("pr") * 1000).alias("pr_thousandths"))


@BOOK.add("measures_table", "G11")
def _(s, d):
    out = graph.measures_table(close(s, d))
    return out.select("id", *[r6(c).alias(c) for c in ("dc", "cc", "bc", "hc", "ec", "coeff", "pr")])


@BOOK.add("power_law_fit", "G12", f"""with {TRADE}, g as (select src, count(*)::double as x from e group by 1), c as materialized (select x, count(*)::double as n from g group by 1),
  f as (select a.x as xmin, sum(b.n) as tail, 1 + sum(b.n) / sum(b.n * ln(b.x / a.x)) as alpha from c a join c b on b.x >= a.x
    where a.x < (select max(x) from c) group by 1),
  b as (select xmin, alpha, tail, b.x, (sum(b.n) over (partition by xmin order by b.x) - b.n) / tail as below from f join c b on b.x >= xmin),
  k as (select xmin, alpha, tail::bigint as n_tail, max(abs(1 - pow(x / xmin, 1 - alpha) - below)) as distance from b group by 1, 2, 3)
  select xmin, round(alpha, 6) as alpha, round(distance, 6) as distance, n_tail from k order by round(distance, 9), xmin limit 1""")
def _(s, d):
    deg = graph.degrees(trade(s, d)).select("degree")
    return graph.power_law_fit(deg, "degree").select("xmin", r6("alpha").alias("alpha"), r6("distance").alias("distance"), "n_tail")


@BOOK.add("pdf_ccdf", "G13", f"""with {TRADE}, g as (select id, count(src) as degree from v left join e on src = id group by 1), c as (select degree, count(*) as n from g group by 1)
  select degree, round(n / sum(n) over ()::double, 6) as pdf, round(sum(n) over (order by degree desc) / sum(n) over ()::double, 6) as ccdf from c""")
def _(s, d):
    out = graph.pdf_ccdf(graph.degrees(trade(s, d)), "degree")
    return out.select("degree", r6("pdf").alias("pdf"), r6("ccdf").alias("ccdf"))


@BOOK.add("random_walks", "G14")
def _(s, d):
    """One row per walk with its nodes in order."""
    walks = graph.random_walks(close(s, d), length=30, walks=200)
    steps = F.array_sort(F.collect_list(F.struct("step", "id")))
    return walks.groupBy("walk").agg(F.transform(steps, lambda x: x["id"]).alias("nodes"))


@BOOK.add("node_embeddings", "G15")
def _(s, d):
    out = graph.node_embeddings(graph.random_walks(close(s, d), length=30, walks=200), dim=2, partitions=s.sparkContext.defaultParallelism)
    from pyspark.ml.functions import vector_to_array
    return out.select("word", vector_to_array("vector").alias("v")).select("word", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))


@BOOK.add("euler_check", "G16", f"""with recursive {CLOSE}, g as (select src, count(*) as k from e group by 1),
  c(id, root) as (select src, src from g union select e.dst, c.root from c join e on e.src = c.id),
  t as (select (select count(*) from g where k % 2 = 1) as odd_nodes, (select count(distinct root) from (select min(root) as root from c group by id)) <= 1 as connected)
  select odd_nodes, connected, case when not connected then 'none' when odd_nodes = 0 then 'tour' when odd_nodes = 2 then 'path' else 'none' end as euler from t""")
def _(s, d):
    return graph.euler_check(close(s, d))
