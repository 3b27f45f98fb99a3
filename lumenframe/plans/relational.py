"""Profiling, cleaning, relational, aggregate, ordering and split queries over the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.numbers import r6
from lumenframe.operators import aggregate, clean, order, profile, relate, split
from lumenframe.plans.book import Book, table
from lumenframe.plans.statistics import sql_quantile

BOOK = Book()
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders(s, d):
    return table(s, d, "orders").select(*ORDERS)


def orders_with_nulls(s, d):
    """Nulls by key modulus, so that both engines inject the same ones."""
    gap = lambda c, m: F.when(F.col("o_orderkey") % m != 0, F.col(c)).alias(c)
    return table(s, d, "orders").select("o_orderkey", gap("o_totalprice", 7), gap("o_orderpriority", 5), gap("o_orderstatus", 11))


NULLED = """(select o_orderkey, case when o_orderkey % 7 <> 0 then o_totalprice end as o_totalprice,
  case when o_orderkey % 5 <> 0 then o_orderpriority end as o_orderpriority,
  case when o_orderkey % 11 <> 0 then o_orderstatus end as o_orderstatus from orders)"""
COLS = ", ".join(ORDERS)

# ---- profiling -------------------------------------------------------------------------------------------------


@BOOK.add("preview", "P01", f"select {COLS} from orders order by o_totalprice desc, o_orderkey limit 20")
def _(s, d):
    return profile.preview(orders(s, d), 20, ["-o_totalprice", "o_orderkey"])


@BOOK.add("shape", "P02", f"select count(*) as n_rows, 5::bigint as n_cols from (select {COLS} from orders)")
def _(s, d):
    return profile.shape(orders(s, d))


@BOOK.add("null_counts", "P03", f"""with x as {NULLED} select unnest(['o_orderkey', 'o_totalprice', 'o_orderpriority',
  'o_orderstatus']) as "column", unnest([count(*) - count(o_orderkey), count(*) - count(o_totalprice),
  count(*) - count(o_orderpriority), count(*) - count(o_orderstatus)]) as n_null from x""")
def _(s, d):
    return profile.null_counts(orders_with_nulls(s, d))


def stats_sql(c):
    return f"""select '{c}' as "column", min({c})::double as "min", quantile_cont({c}, 0.25) as q1,
  quantile_cont({c}, 0.5) as median, round(avg({c}), 6) as mean, quantile_cont({c}, 0.75) as q3, max({c})::double as "max"
  from lineitem"""


@BOOK.add("summary_stats", "P04", f"""select "column", "min", round(q1, 6) as q1, round(median, 6) as median, mean,
  round(q3, 6) as q3, "max" from ({stats_sql('l_quantity')} union all {stats_sql('l_extendedprice')}
  union all {stats_sql('l_discount')})""")
def _(s, d):
    out = profile.summary_stats(table(s, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column", "min", *[r6(c).alias(c) for c in ("q1", "median", "mean", "q3")], "max")


@BOOK.add("column_types", "P05", """select column_name as "column", case column_type when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' else lower(column_type) end as "type"
  from (describe orders)""")
def _(s, d):
    return profile.column_types(table(s, d, "orders"))


@BOOK.add("category_counts", "P06", "select o_orderpriority, count(*) as n from orders group by 1")
def _(s, d):
    return profile.category_counts(table(s, d, "orders"), "o_orderpriority")


@BOOK.add("top_values", "P07", """select p_type, n, "rank" from (select p_type, count(*) as n,
  row_number() over (order by count(*) desc, p_type) as "rank" from part group by 1) where "rank" between 2 and 5""")
def _(s, d):
    return profile.top_values(table(s, d, "part"), "p_type", 4, skip=1)


@BOOK.add("category_shares", "P08", """select o_orderstatus, count(*) as n,
  round(100.0 * count(*) / sum(count(*)) over (), 6)::double as percent from orders group by 1""")
def _(s, d):
    return profile.category_shares(table(s, d, "orders"), "o_orderstatus").withColumn("percent", r6("percent"))


@BOOK.add("crosstab", "P09", "select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2")
def _(s, d):
    return profile.crosstab(table(s, d, "orders"), "o_orderpriority", "o_orderstatus")


@BOOK.add("crosstab_wide", "P09", """select o_orderpriority, count(*) filter (o_orderstatus = 'F') as "F",
  count(*) filter (o_orderstatus = 'O') as "O", count(*) filter (o_orderstatus = 'P') as "P" from orders group by 1""")
def _(s, d):
    return profile.crosstab(table(s, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@BOOK.add("histogram", "P10", """with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)
  select bin, round(lo + bin * ((hi - lo) / 20), 6) as left_edge, n from (select least(floor((l_extendedprice - lo) /
  ((hi - lo) / 20)), 19)::bigint as bin, lo, hi, count(*) as n from lineitem, e group by all)""")
def _(s, d):
    return profile.histogram(table(s, d, "lineitem"), "l_extendedprice", 20).withColumn("left_edge", r6("left_edge"))


@BOOK.add("density", "P11", """with e as (select min(o_totalprice) as lo, max(o_totalprice) as hi,
    0.9 * least(stddev_samp(o_totalprice), (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) / 1.34) * pow(count(*), -0.2) as h,
    count(*) as n from orders),
  g as (select i as grid_id, lo - 3 * h + i * ((hi - lo + 6 * h) / 31) as point, h, n from e, unnest(range(32)) as u(i))
  select grid_id, round(point, 4) as point, round(1e6 * sum(exp(-((o_totalprice - point) / h) * ((o_totalprice - point) / h) / 2)
    / (h * sqrt(2 * pi()))) / any_value(n), 6) as density_e6 from orders, g group by grid_id, point""")
def _(s, d):
    out = profile.density(table(s, d, "orders"), "o_totalprice", 32)
    return out.select(F.col("grid_id").cast("long").alias("grid_id"), r6("point", 4).alias("point"), r6(F.col("density") * 1e6).alias("density_e6"))


@BOOK.add("qq_points", "P12", f"""select row_id, sample, "rank", round({sql_quantile('(("rank" - 0.5::double) / n)')}, 6) + 0.0 as theoretical from (
  select l_orderkey * 10 + l_linenumber as row_id, l_extendedprice as sample, count(*) over () as n,
  row_number() over (order by l_extendedprice, l_orderkey * 10 + l_linenumber) as "rank" from lineitem)""")
def _(s, d):
    line = table(s, d, "lineitem").withColumn("row_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return profile.qq_points(line, "l_extendedprice", "row_id").select("row_id", "sample", "rank", r6("theoretical").alias("theoretical"))


# ---- projections, filters, cleaning ----------------------------------------------------------------------------


@BOOK.add("keep_columns", "C01", """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount from lineitem""")
def _(s, d):
    return clean.drop_columns(clean.keep_columns(table(s, d, "lineitem"), kind="numeric"), ["l_tax"])


@BOOK.add("rename_columns", "C02", "select o_orderkey as id, o_totalprice as amount, o_orderstatus as status from orders")
def _(s, d):
    kept = clean.keep_columns(table(s, d, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"])
    return clean.rename_columns(kept, {"o_orderkey": "id", "o_totalprice": "amount", "o_orderstatus": "status"})


@BOOK.add("add_label", "C03", "select o_orderkey, 1 as accepted from orders")
def _(s, d):
    return clean.add_label(table(s, d, "orders").select("o_orderkey"), "accepted", 1)


@BOOK.add("filter_rows", "C04", f"select {COLS} from orders where o_orderstatus = 'F' and o_totalprice > 1000")
def _(s, d):
    return clean.filter_rows(orders(s, d), (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000))


@BOOK.add("drop_missing", "C05", f"""select * from {NULLED} where o_totalprice is not null and o_orderpriority is not null""")
def _(s, d):
    return clean.drop_missing(orders_with_nulls(s, d), ["o_totalprice", "o_orderpriority"])


@BOOK.add("fill_missing", "C06", f"""select o_orderkey, coalesce(o_totalprice, 0.0) as o_totalprice,
  coalesce(o_orderpriority, 'None') as o_orderpriority, coalesce(o_orderstatus, 'None') as o_orderstatus from {NULLED}""")
def _(s, d):
    return clean.fill_missing(orders_with_nulls(s, d))


@BOOK.add("fill_mode", "C07", f"""with x as {NULLED}, m as (select o_orderpriority as p from x where o_orderpriority is not null
    group by 1 order by count(*) desc, 1 limit 1),
  m2 as (select o_orderstatus as p from x where o_orderstatus is not null group by 1 order by count(*) desc, 1 limit 1)
  select o_orderkey, o_totalprice, coalesce(o_orderpriority, (select p from m)) as o_orderpriority,
  coalesce(o_orderstatus, (select p from m2)) as o_orderstatus from x""")
def _(s, d):
    return clean.fill_mode(orders_with_nulls(s, d), ["o_orderpriority", "o_orderstatus"])


@BOOK.add("map_values", "C08", """select o_orderkey, case o_orderstatus when 'F' then 1 when 'O' then 0 end as flag,
  case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 9 end as urgency from orders""")
def _(s, d):
    out = clean.map_values(table(s, d, "orders"), "o_orderstatus", {"F": 1, "O": 0}, out="flag")
    out = clean.map_values(out, "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2}, 9, "urgency")
    return out.select("o_orderkey", "flag", "urgency")


@BOOK.add("encode_first_seen", "C09", """select o.o_orderkey, o.o_custkey, c.code from orders o join (select o_custkey,
  row_number() over (order by min(o_orderkey), o_custkey) as code from orders group by 1) c using (o_custkey)""")
def _(s, d):
    out = clean.encode_first_seen(table(s, d, "orders"), "o_custkey", "o_orderkey", start=1)
    return out.select("o_orderkey", "o_custkey", "code")


@BOOK.add("encode_sorted", "C10", """select o_orderkey, o_orderpriority, dense_rank() over (order by o_orderpriority) - 1 as code
  from orders""")
def _(s, d):
    return clean.encode_sorted(table(s, d, "orders"), "o_orderpriority").select("o_orderkey", "o_orderpriority", "code")


@BOOK.add("coerce_numeric", "C11", """select p_partkey, p_name, try_cast(piece as double) as piece from (select p_partkey, p_name,
  case when p_partkey % 3 = 0 then p_name else cast(p_size as varchar) || '.5' end as piece from part)
  where try_cast(piece as double) is not null""")
def _(s, d):
    mixed = table(s, d, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 3 == 0, F.col("p_name"))
                                       .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5"))).alias("piece"))
    return clean.coerce_numeric(mixed, ["piece"])


@BOOK.add("parse_currency", "C12", """select o_orderkey, try_cast(regexp_replace('$' || format('{:,.2f}', o_totalprice), '[$,]', '', 'g')
  as double) as price from orders""")
def _(s, d):
    text = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("price"))
    return clean.parse_currency(text, ["price"])


@BOOK.add("date_to_year", "C13", """select o_orderkey, strftime(o_orderdate, '%-d-%b-%y') as day, year(o_orderdate)::int as "year"
  from orders""")
def _(s, d):
    text = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "d-MMM-yy").alias("day"))
    return clean.date_to_year(text, "day")


@BOOK.add("transform_column", "C14", """with m as (select avg(l_quantity) as m, stddev_samp(l_quantity) as sd from lineitem)
  select l_orderkey, l_linenumber, round(ln(l_quantity), 6) as log_q,
  round(case when ln(l_quantity) <> 0 then 1 / ln(l_quantity) end, 6) as inv_q, round(exp(l_discount), 6) as exp_d,
  round(exp(-ln(l_quantity) * ln(l_quantity) / 2) / (l_quantity * sqrt(2 * pi())), 6) as dln_q,
  round((l_quantity - m) / sd, 6) + 0.0 as std_q from lineitem, m""")
def _(s, d):
    out = table(s, d, "lineitem")
    for kind, col, name in (("log", "l_quantity", "log_q"), ("inverse_log", "l_quantity", "inv_q"), ("exp", "l_discount", "exp_d"),
                            ("lognormal_density", "l_quantity", "dln_q"), ("standardize", "l_quantity", "std_q")):
        out = clean.transform_column(out, col, kind, name)
    return out.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in ("log_q", "inv_q", "exp_d", "dln_q", "std_q")])


@BOOK.add("assert_unique_key", "C15", "select o_custkey, count(*) as n from orders group by 1 having count(*) > 1")
def _(s, d):
    return clean.assert_unique_key(table(s, d, "orders"), "o_custkey")


@BOOK.add("compound_growth", "C16", """select c_custkey, round(c_acctbal * pow(1.02, 9), 4) + 0.0 as amount,
  case when 20000 <= c_acctbal then 1 when c_acctbal > 0 then (ceil(ln(20000 / c_acctbal) / ln(1.02)) + 1)::bigint end as first_day
  from customer""")
def _(s, d):
    rich = table(s, d, "customer").select("c_custkey", "c_acctbal", F.lit(20000.0).alias("goal"))
    safe = rich.withColumn("goal", F.when(F.col("c_acctbal") > 0, F.col("goal")))
    return clean.compound_growth(safe, "c_acctbal", 2, 10, "goal").select("c_custkey", r6("amount", 4).alias("amount"), "first_day")


# ---- set operations and joins ----------------------------------------------------------------------------------


@BOOK.add("union_aligned", "J01", """select o_custkey as custkey, o_totalprice as price, null as segment from orders
  union all select c_custkey, null, c_mktsegment from customer""")
def _(s, d):
    a = table(s, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price"))
    b = table(s, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    return relate.union_aligned(a, b)


@BOOK.add("join_by_row_id", "J02", """select doc_id, n_chars, lang, quality, toxic from documents join labels using (doc_id)""")
def _(s, d):
    return relate.join_by_row_id(table(s, d, "documents").select("doc_id", "n_chars", "lang"), table(s, d, "labels"), "doc_id")


@BOOK.add("distinct_values", "J06", "select distinct user_id, event_type from events")
def _(s, d):
    return relate.distinct_values(table(s, d, "events"), ["user_id", "event_type"])


@BOOK.add("difference", "J07", """select o_custkey, o_orderstatus from orders except all
  select o_custkey, o_orderstatus from orders where o_totalprice > 100000""")
def _(s, d):
    both = table(s, d, "orders").select("o_custkey", "o_orderstatus")
    return relate.difference(both, table(s, d, "orders").where("o_totalprice > 100000").select("o_custkey", "o_orderstatus"))


@BOOK.add("all_pairs", "J08", """with m as (select "label", avg(list_aggregate(embedding, 'avg')) as level from embeddings group by 1)
  select a.vec_id, m."label" as other_label, round(list_aggregate(a.embedding, 'avg') - m.level, 6) + 0.0 as gap
  from embeddings a, m""")
def _(s, d):
    avg = F.aggregate("embedding", F.lit(0.0), lambda t, v: t + v.cast("double")) / F.size("embedding")
    rows = table(s, d, "embeddings").select("vec_id", "label", avg.alias("own"))
    level = rows.groupBy(F.col("label").alias("other_label")).agg(F.avg("own").alias("level"))
    return relate.all_pairs(rows, level).select("vec_id", "other_label", r6(F.col("own") - F.col("level")).alias("gap"))


@BOOK.add("dedupe_where", "J09", """select event_id, user_id, event_type from events where event_type <> 'click' union all
  select min(event_id), user_id, event_type from events where event_type = 'click' group by 2, 3""")
def _(s, d):
    rows = table(s, d, "events").select("event_id", "user_id", "event_type")
    return relate.dedupe_where(rows, F.col("event_type") == "click", ["user_id", "event_type"], ["event_id"])


# ---- aggregations ----------------------------------------------------------------------------------------------


@BOOK.add("group_sum", "A01", """select year(l_shipdate)::int as ship_year, sum(l_extendedprice::decimal(18,2))::double as total
  from lineitem group by 1""")
def _(s, d):
    rows = table(s, d, "lineitem").select(F.year("l_shipdate").alias("ship_year"), F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    return aggregate.group_sum(rows, ["ship_year"], "p").withColumn("total", F.col("total").cast("double"))


@BOOK.add("group_mean_ci", "A02", """select event_type, count("value") as n, round(avg("value"), 6) as mean,
  round(avg("value") - 1.96 * stddev_samp("value") / sqrt(count("value")), 6) as low,
  round(avg("value") + 1.96 * stddev_samp("value") / sqrt(count("value")), 6) as high from events group by 1""")
def _(s, d):
    out = aggregate.group_mean_ci(table(s, d, "events"), ["event_type"], "value")
    return out.select("event_type", "n", *[r6(c).alias(c) for c in ("mean", "low", "high")])


@BOOK.add("series_pivot", "A03", """select day, round(sum("value") filter (event_type = 'click'), 6) as click,
  round(sum("value") filter (event_type = 'view'), 6) as "view", round(sum("value") filter (event_type = 'purchase'), 6) as purchase
  from (select *, day(ts)::int as day from events) group by 1""")
def _(s, d):
    kinds = ["click", "view", "purchase"]
    rows = table(s, d, "events").select(F.dayofmonth("ts").alias("day"), "event_type", "value")
    return aggregate.series_pivot(rows, "day", "event_type", "value", kinds).select("day", *[r6(k).alias(k) for k in kinds])


@BOOK.add("concat_top", "A04", """select p_brand, string_agg(p_name, ' , ' order by rn) as names from (select p_brand, p_name,
  row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as rn from part) where rn <= 10 group by 1""")
def _(s, d):
    return aggregate.concat_top(table(s, d, "part"), "p_brand", ["-p_retailprice", "p_partkey"], "p_name", 10)


@BOOK.add("max_of", "A05", "select max(try_cast(o_orderkey::varchar as bigint)) as max_value from orders")
def _(s, d):
    return aggregate.max_of(table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("k")), "k")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def pair_sql(fn, name, digits):
    return " union all ".join(f"""select '{a}' as "row", '{b}' as "col", round({fn}({a}, {b}), {digits}) + 0.0 as {name} from lineitem"""
                              for a in NUMERIC for b in NUMERIC)


@BOOK.add("mean_vector", "A06", """select dim::int as dim, round(avg(v::double), 6) + 0.0 as mean from
  (select unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as dim from embeddings) group by 1""")
def _(s, d):
    return aggregate.mean_vector(table(s, d, "embeddings"), "embedding").withColumn("mean", r6("mean"))


@BOOK.add("class_mean_vectors", "A07", """select "label", dim::int as dim, round(avg(v::double), 6) + 0.0 as mean from
  (select "label", unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as dim from embeddings) group by 1, 2""")
def _(s, d):
    return aggregate.class_mean_vectors(table(s, d, "embeddings"), "embedding", "label").withColumn("mean", r6("mean"))


@BOOK.add("covariance_matrix", "A08", pair_sql("covar_pop", "covariance", 3))
def _(s, d):
    return aggregate.covariance_matrix(table(s, d, "lineitem"), NUMERIC).withColumn("covariance", r6("covariance", 3))


MATRIX_SQL = """m as (select i, j, (case when i = j then 1.5 when j = i + 1 then -0.5 else 0.0 end)::double as a
    from unnest(range(8)) as u(i), unnest(range(64)) as w(j)), o as (select i, (i / 4.0)::double as b from unnest(range(8)) as u(i))"""


def band_matrix(s):
    """An 8 x 64 band matrix and an offset, by rule."""
    cells = s.range(8 * 64).select((F.col("id") / 64).cast("int").alias("i"), (F.col("id") % 64).cast("int").alias("j"))
    a = cells.withColumn("a", F.when(F.col("i") == F.col("j"), 1.5).when(F.col("j") == F.col("i") + 1, -0.5).otherwise(0.0))
    return a, s.range(8).select(F.col("id").cast("int").alias("i"), (F.col("id") / 4.0).alias("b"))


@BOOK.add("affine_map", "A09", f"""with {MATRIX_SQL}, x as (select vec_id, unnest(embedding)::double as v,
    generate_subscripts(embedding, 1) - 1 as j from embeddings)
  select vec_id, i::int as i, round(sum(a * v) + any_value(b), 6) + 0.0 as y from x join m using (j) join o using (i) group by 1, 2""")
def _(s, d):
    out = aggregate.affine_map(table(s, d, "embeddings"), "vec_id", "embedding", *band_matrix(s))
    return out.withColumn("y", r6("y"))


@BOOK.add("affine_moments", "A10", f"""with {MATRIX_SQL}, x as (select vec_id, unnest(embedding)::double as v,
    generate_subscripts(embedding, 1) - 1 as j from embeddings), y as (select vec_id, i, sum(a * v) + any_value(b) as y
    from x join m using (j) join o using (i) group by 1, 2)
  select p.i::int as "row", q.i::int as "col", round(covar_pop(p.y, q.y), 6) + 0.0 as covariance from y p join y q using (vec_id)
  group by 1, 2""")
def _(s, d):
    from lumenframe.operators.linear import vector_covariance
    vecs = table(s, d, "embeddings")
    a, b = band_matrix(s)
    mean = aggregate.mean_vector(vecs, "embedding").withColumnRenamed("dim", "i")
    _, cov = aggregate.affine_moments(mean, vector_covariance(vecs, "embedding"), a, b)
    return cov.withColumn("covariance", r6("covariance"))


@BOOK.add("correlation_matrix", "A11", pair_sql("corr", "correlation", 6))
def _(s, d):
    return aggregate.correlation_matrix(table(s, d, "lineitem"), NUMERIC).withColumn("correlation", r6("correlation"))


# ---- ordering and windows --------------------------------------------------------------------------------------


@BOOK.add("sort_rows", "W01", """select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as "rank"
  from orders""")
def _(s, d):
    return order.sort_rows(table(s, d, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"])


@BOOK.add("top_k", "W02", f"select {COLS} from orders order by o_totalprice, o_orderkey limit 10")
def _(s, d):
    return order.top_k(orders(s, d), ["o_totalprice", "o_orderkey"], 10)


@BOOK.add("top_k_per_group", "W03", """select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rn as "rank" from (select *,
  row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber)::int as rn from lineitem) where rn <= 3""")
def _(s, d):
    rows = table(s, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return order.top_k_per_group(rows, ["l_suppkey"], ["-l_extendedprice", "l_orderkey", "l_linenumber"], 3)


@BOOK.add("running_sum", "W04", """select event_id, user_id, round(sum("value") over (partition by user_id order by ts, event_id
  rows unbounded preceding), 4) + 0.0 as running_sum from events""")
def _(s, d):
    rows = table(s, d, "events").select("event_id", "user_id", "ts", "value")
    out = order.running_sum(rows, ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", "user_id", r6("running_sum", 4).alias("running_sum"))


@BOOK.add("running_best", "W05", """select event_id, user_id, max("value") over (partition by user_id order by ts, event_id
  rows unbounded preceding) as running_best from events""")
def _(s, d):
    rows = table(s, d, "events").select("event_id", "user_id", "ts", "value")
    return order.running_best(rows, ["user_id"], ["ts", "event_id"], "value").select("event_id", "user_id", "running_best")


@BOOK.add("sliding_groups", "W06", """select conv_id, rn as start, a || ' | ' || b || ' | ' || c as items from (select conv_id,
  row_number() over w as rn, "text" as a, lead("text", 1) over w as b, lead("text", 2) over w as c from conversations
  window w as (partition by conv_id order by turn, role, "text")) where c is not null""")
def _(s, d):
    out = order.sliding_groups(table(s, d, "conversations"), ["conv_id"], ["turn", "role", "text"], "text", 3)
    return out.withColumn("items", F.array_join("items", " | "))


@BOOK.add("shuffle_rows", "W07", "select o_orderkey, o_totalprice from orders")
def _(s, d):
    return order.shuffle_rows(table(s, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 42)


# ---- splits ----------------------------------------------------------------------------------------------------


@BOOK.add("split_random", "X01", """select o_orderkey, case when b < 45875 then 'train' when b < 55706 then 'valid' else 'test' end
  as part from (select o_orderkey, ((o_orderkey % 65536) * 40503 + 7) % 65536 as b from orders)""")
def _(s, d):
    rows = table(s, d, "orders").select("o_orderkey")
    return split.split_random(rows, "o_orderkey", {"train": 0.7, "valid": 0.15, "test": 0.15}, seed=7, portable=True)


@BOOK.add("split_ordered", "X02", """select o_orderkey, case when row_number() over (order by o_orderdate, o_orderkey) <=
  floor((select count(*) from orders) * 0.7) then 'first' else 'rest' end as part from orders""")
def _(s, d):
    rows = table(s, d, "orders").select("o_orderkey", "o_orderdate")
    return split.split_ordered(rows, ["o_orderdate", "o_orderkey"], fraction=0.7).select("o_orderkey", "part")


@BOOK.add("split_stratified", "X03", """select doc_id, quality, case when rn <= ceil(n * 0.7) then 'train' else 'test' end as part
  from (select doc_id, quality, count(*) over (partition by quality) as n, row_number() over (partition by quality order by
  ((doc_id % 65536) * 40503 + 3) % 65536, doc_id) as rn from labels)""")
def _(s, d):
    return split.split_stratified(table(s, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.7, 3, portable=True)


@BOOK.add("assign_folds", "X04", """select doc_id, quality, (row_number() over (partition by quality order by doc_id) - 1) % 10 as fold
  from labels""")
def _(s, d):
    return split.assign_folds(table(s, d, "labels").select("doc_id", "quality"), "doc_id", "quality", 10)
