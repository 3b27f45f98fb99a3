"""Evaluation, hypothesis tests and candidate scoring over the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import numbers
from lumenframe.functions.numbers import r6
from lumenframe.operators import evaluate, models, scoring, stats
from lumenframe.operators.order import top_k
from lumenframe.plans.book import Book, table

BOOK = Book()


def scored(s, d):
    """Labels with a made score from n_chars; many scores tie."""
    both = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return both.select("doc_id", F.col("quality").alias("label"), ((F.col("n_chars") * 37) % 101 / 101.0).alias("score"))


SCORED = """s as (select doc_id, quality as "label", ((n_chars * 37) % 101) / 101.0::double as score from labels join documents using (doc_id))"""
STEPS = f"""{SCORED}, g as (select score, sum("label") as pos, sum(1 - "label") as neg from s group by 1),
  t as (select score, pos, neg, sum(pos) over (order by score desc) as cp, sum(neg) over (order by score desc) as cn from g),
  n as (select sum(pos)::double as p, sum(neg)::double as q from g)"""
CAP = f"""{SCORED}, r as (select row_number() over w as x, sum("label") over (order by score desc, "label" desc, doc_id rows unbounded preceding)::bigint as y
  from s window w as (order by score desc, "label" desc, doc_id)), c as (select x, y from r union all select 0, 0)"""


@BOOK.add("accuracy", "E01", f"""with {SCORED} select round(avg(((score >= 0.5) = ("label" = 1))::int), 6) as accuracy from s""")
def _(s, d):
    return evaluate.accuracy(scored(s, d), "label", "score").select(r6("accuracy").alias("accuracy"))


@BOOK.add("log_loss", "E02", f"""with {SCORED}, c as (select "label", greatest(1e-15, least(1 - 1e-15, score)) as p from s)
  select round(avg(-("label" * ln(p) + (1 - "label") * ln(1 - p))), 6) as log_loss from c""")
def _(s, d):
    return evaluate.log_loss(scored(s, d), "label", "score").select(r6("log_loss").alias("log_loss"))


@BOOK.add("confusion", "E03", f"""with {SCORED}, c as (select count(*) filter (score >= 0.5 and "label" = 1) as tp,
    count(*) filter (score >= 0.5 and "label" = 0) as fp, count(*) filter (score < 0.5 and "label" = 1) as fn,
    count(*) filter (score < 0.5 and "label" = 0) as tn, count(*)::double as n from s),
  e as (select *, (tp + tn) / n as po, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) as pe from c)
  select tp, fp, fn, tn, round(po, 6) as accuracy, round(tp / (tp + fn), 6) as sensitivity, round(tn / (tn + fp), 6) as specificity,
  round((po - pe) / (1 - pe), 6) + 0.0 as kappa from e""")
def _(s, d):
    out = evaluate.confusion(scored(s, d), "label", "score")
    return out.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("accuracy", "sensitivity", "specificity", "kappa")])


def predicted(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_extendedprice", (F.col("l_quantity") * 1000 + 10000).alias("guess"))


PRED = "p as (select l_orderkey, l_extendedprice as y, l_quantity * 1000 + 10000 as g from lineitem)"


@BOOK.add("regression_metrics", "E04", f"""with {PRED} select round(avg((y - g) * (y - g)) / 1e6, 6) as mse_millions,
  round(1 - avg((y - g) * (y - g)) / var_pop(y), 6) + 0.0 as r2 from p""")
def _(s, d):
    out = evaluate.regression_metrics(predicted(s, d), "l_extendedprice", "guess")
    return out.select(r6(F.col("mse") / 1e6).alias("mse_millions"), r6("r2").alias("r2"))


@BOOK.add("roc_curve", "E05", f"""with {STEPS} select round(score, 6) as threshold, round(cn / q, 6) as fpr, round(cp / p, 6) as tpr from t, n
  union all select null, 0, 0""")
def _(s, d):
    return evaluate.roc_curve(scored(s, d), "label", "score").select(*[r6(c).alias(c) for c in ("threshold", "fpr", "tpr")])


@BOOK.add("auc", "E06", f"""with {STEPS}, l as (select cn / q as fpr, cp / p as tpr, coalesce(lag(cn / q) over (order by score desc), 0) as f0,
  coalesce(lag(cp / p) over (order by score desc), 0) as t0 from t, n) select round(sum((fpr - f0) * (tpr + t0) / 2), 6) as auc from l""")
def _(s, d):
    return evaluate.auc(scored(s, d), "label", "score").select(r6("auc").alias("auc"))


@BOOK.add("cap_curve", "E07", f"with {CAP} select x, y from c")
def _(s, d):
    return evaluate.cap_curve(scored(s, d), "label", "score", "doc_id")


@BOOK.add("cap_ratio", "E08", f"""with {CAP}, a as (select sum(case when x > 0 then (y + y0) / 2.0 end)::double as m, max(x)::double as n, max(y)::double as p
    from (select x, y, lag(y) over (order by x) as y0 from c))
  select round((m - n * p / 2) / (p * p / 2 + p * (n - p) - n * p / 2), 6) + 0.0 as cap_ratio from a""")
def _(s, d):
    return evaluate.cap_ratio(scored(s, d), "label", "score").select(r6("cap_ratio").alias("cap_ratio"))


@BOOK.add("cap_at_half", "E09", f"""with {CAP}, h as (select 100.0::double * (select y from c where x = (select max(x) // 2 from c)) / max(y) as v from c)
  select round(v, 6) as percent, case when v < 60 then 'Rubbish' when v < 70 then 'Poor' when v < 80 then 'Good'
  when v <= 90 then 'Very Good' else 'Too Good to be True' end as rating from h""")
def _(s, d):
    return evaluate.cap_at_half(scored(s, d), "label", "score").select(r6("percent").alias("percent"), "rating")


@BOOK.add("overfit_gap", "E10", f"""with {PRED}, m as (select l_orderkey % 4 = 0 as test, 1 - avg((y - g) * (y - g)) / var_pop(y) as r2 from p group by 1)
  select round(a.r2, 6) + 0.0 as train_r2, round(b.r2, 6) + 0.0 as test_r2, round(a.r2 - b.r2, 6) + 0.0 as gap from m a, m b where not a.test and b.test""")
def _(s, d):
    rows = predicted(s, d)
    out = evaluate.overfit_gap(rows.where("l_orderkey % 4 <> 0"), rows.where("l_orderkey % 4 = 0"), "l_extendedprice", "guess")
    return out.select(*[r6(c).alias(c) for c in ("train_r2", "test_r2", "gap")])


# ---- tests -----------------------------------------------------------------------------------------------------

QTY, PRICE = "l_quantity", "l_extendedprice"


def line(s, d):
    return table(s, d, "lineitem")


@BOOK.add("covariance", "H01", f"select round(covar_samp({QTY}, {PRICE}), 3) + 0.0 as covariance from lineitem")
def _(s, d):
    return stats.covariance(line(s, d), QTY, PRICE).select(r6("covariance", 3).alias("covariance"))


def sql_poly(x, coefficients):
    out = repr(float(coefficients[0])) + "::double"
    for c in coefficients[1:]:
        out = f"(({out}) * ({x}) + ({float(c)!r}))"
    return out


def sql_log_cdf(z):
    x = f"(abs({z}) / sqrt(2.0::double))"
    t = f"(1 / (1 + {x} / 2))"
    tail = f"(ln({t}) - {x} * {x} + {sql_poly(t, numbers._ERFC)} - ln(2.0::double))"
    return f"(case when {z} < 0 then {tail} else ln(1 - exp({tail})) end)"


def sql_two_sided(z):
    """Normal tails of both sides, for samples so large that Student's law has the same four decimals."""
    return f"round(2 * exp({sql_log_cdf(f'(-abs({z}) - 1e-12)')}), 4) + 0.0"


def p4():
    return r6("p_value", 4).alias("p_value")


@BOOK.add("pearson_test", "H02", f"""select round(r, 6) + 0.0 as r, round(t, 6) + 0.0 as t, df, {sql_two_sided('t')} as p_value from
  (select r, df, r * sqrt(df / (1 - r * r)) as t from (select corr({QTY}, {PRICE}) as r, count(*) - 2 as df from lineitem))""")
def _(s, d):
    return stats.pearson_test(line(s, d), QTY, PRICE).select(r6("r").alias("r"), r6("t").alias("t"), "df", p4())


@BOOK.add("spearman_test", "H03", f"""with r as (select rank() over (order by {QTY}) + (count(*) over (partition by {QTY}) - 1) / 2.0 as a,
  rank() over (order by {PRICE}) + (count(*) over (partition by {PRICE}) - 1) / 2.0 as b from lineitem)
  select round(rho, 6) + 0.0 as rho, n, {sql_two_sided('(rho * sqrt((n - 2) / (1 - rho * rho)))')} as p_value from
  (select corr(a::double, b::double) as rho, count(*) as n from r)""")
def _(s, d):
    return stats.spearman_test(line(s, d), QTY, PRICE).select(r6("rho").alias("rho"), "n", p4())


@BOOK.add("kendall_test", "H04", f"""with x as (select p_partkey as k, p_size as a, p_retailprice as b from part),
  p as (select sign(x.a - y.a) * sign(x.b - y.b) as z, x.a = y.a as ta, x.b = y.b as tb from x join x y on x.k < y.k),
  c as (select count(*) filter (z > 0) as cc, count(*) filter (z < 0) as dd, count(*) filter (not ta) as na, count(*) filter (not tb) as nb from p),
  t as (select (cc - dd) / sqrt(na::double * nb) as tau, cc, dd, (select count(*) from part)::double as n from c)
  select round(tau, 6) + 0.0 as tau, cc::double as concordant, dd::double as discordant,
  {sql_two_sided('(3 * tau * sqrt(n * (n - 1)) / sqrt(2 * (2 * n + 5)))')} as p_value from t""")
def _(s, d):
    return stats.kendall_test(table(s, d, "part"), "p_size", "p_retailprice").select(r6("tau").alias("tau"), "concordant", "discordant", p4())


@BOOK.add("chi_square", "H05", """with c as (select o_orderstatus as a, o_orderpriority as b, count(*)::double as o from orders group by 1, 2),
  e as (select o, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as x from c)
  select round(q, 6) as statistic, df, round(exp(-q / 2) * list_sum(list_transform(range(df // 2), lambda k: pow(q / 2, k) / gamma(k + 1))), 6) + 0.0 as p_value from
  (select sum((o - x) * (o - x) / x) as q, (select (count(distinct a) - 1) * (count(distinct b) - 1) from c) as df from e)""")
def _(s, d):
    """Eight degrees of freedom: an even number, for which the tail is a finite sum."""
    return stats.chi_square(table(s, d, "orders"), "o_orderstatus", "o_orderpriority").select(r6("statistic").alias("statistic"), "df", r6("p_value").alias("p_value"))


@BOOK.add("chi_square_2x2", "H05", f"""with c as (select o_orderstatus = 'F' as a, o_orderpriority = '1-URGENT' as b, count(*)::double as o from orders group by 1, 2),
  e as (select o, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as x from c)
  select round(q, 6) as statistic, 1 as df, {sql_two_sided('sqrt(q)')} as p_value from (select sum(pow(abs(o - x) - least(0.5, abs(o - x)), 2) / x) as q from e)""")
def _(s, d):
    rows = table(s, d, "orders").select((F.col("o_orderstatus") == "F").alias("done"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return stats.chi_square(rows, "done", "urgent", correct=True).select(r6("statistic").alias("statistic"), F.col("df").cast("int").alias("df"), p4())


def sql_quantile(p):
    q, low, high = f"({p} - 0.5)", f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    r = f"({q} * {q})"
    return (f"(case when {p} < 0.02425 then {sql_poly(low, numbers._TAIL_TOP)} / {sql_poly(low, numbers._TAIL_LOW)} "
            f"when {p} > 1 - 0.02425 then -{sql_poly(high, numbers._TAIL_TOP)} / {sql_poly(high, numbers._TAIL_LOW)} "
            f"else {sql_poly(r, numbers._CENTRE_TOP)} * {q} / {sql_poly(r, numbers._CENTRE_LOW)} end)")


@BOOK.add("anderson_darling", "H06", f"""with m as (select avg({PRICE}) as m, stddev_samp({PRICE}) as sd, count(*)::double as n from lineitem),
  z as (select row_number() over (order by {PRICE}) as i, ({PRICE} - m) / sd as z, n from lineitem, m),
  a as (select -any_value(n) - sum((2 * i - 1) * {sql_log_cdf('z')} + (2 * (n - i) + 1) * {sql_log_cdf('(-z)')}) / any_value(n) as a2, count(*) as n from z),
  b as (select *, a2 * (1 + 0.75 / n + 2.25 / (n * n)) as x from a)
  select round(a2, 4) as a2, n, round(case when x < 0.2 then 1 - exp(-13.436 + 101.14 * x - 223.73 * x * x) when x < 0.34 then 1 - exp(-8.318 + 42.796 * x - 59.938 * x * x)
    when x < 0.6 then exp(0.9177 - 4.279 * x - 1.38 * x * x) when x < 10 then exp(1.2937 - 5.709 * x + 0.0186 * x * x) else 0 end, 4) + 0.0 as p_value from b""")
def _(s, d):
    return stats.anderson_darling(line(s, d), PRICE).select(r6("a2", 4).alias("a2"), "n", p4())


@BOOK.add("shapiro_francia", "H07", f"""with z as (select {PRICE} as x, (row_number() over (order by {PRICE}) - 0.375::double) / (count(*) over () + 0.25::double) as p
    from lineitem), q as (select x, {sql_quantile('p')} as m from z)
  select round(w, 6) as w, n, round(exp({sql_log_cdf("(-((ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n)))))")}), 4) + 0.0 as p_value
  from (select corr(x, m) * corr(x, m) as w, count(*)::double as n from q)""")
def _(s, d):
    rows = line(s, d).withColumn("row_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return stats.shapiro_francia(rows, PRICE, "row_id").select(r6("w").alias("w"), F.col("n").cast("double").alias("n"), p4())


@BOOK.add("ks_two_sample", "H08", """with v as (select l_discount as v, 1 as a, 0 as b from lineitem union all select l_tax, 0, 1 from lineitem),
  c as (select v, sum(a) as a, sum(b) as b from v group by 1), e as (select sum(a) over (order by v) / sum(a) over ()::double as fa,
  sum(b) over (order by v) / sum(b) over ()::double as fb from c),
  k as (select max(abs(fa - fb)) as d, (select count(l_discount)::double * count(l_tax) / (count(l_discount) + count(l_tax)) from lineitem) as n from e)
  select round(d, 6) as d, round(least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda i: (case when i % 2 = 1 then 1 else -1 end) * exp(-2 * i * i * d * d * n))))), 6) + 0.0 as p_value from k""")
def _(s, d):
    return stats.ks_two_sample(line(s, d), "l_discount", "l_tax").select(r6("d").alias("d"), r6("p_value").alias("p_value"))


@BOOK.add("mardia", "H09", f"""with m as (select avg({QTY}) as ma, avg({PRICE}) as mb, var_pop({QTY}) as va, var_pop({PRICE}) as vb,
    covar_pop({QTY}, {PRICE}) as c from lineitem),
  q as (select (vb * pow({QTY} - ma, 2) - 2 * c * ({QTY} - ma) * ({PRICE} - mb) + va * pow({PRICE} - mb, 2)) / (va * vb - c * c) as q from lineitem, m),
  select round(kurtosis, 6) as kurtosis, round(z, 4) as z, {sql_two_sided('z')} as p_value
  from (select avg(q * q) as kurtosis, (avg(q * q) - 8) / sqrt(64.0::double / count(*)) as z from q)""")
def _(s, d):
    return stats.mardia(line(s, d), [QTY, PRICE]).select(r6("kurtosis").alias("kurtosis"), r6("z", 4).alias("z"), p4())


@BOOK.add("simple_regression", "H10", f"""with a as (select regr_slope({PRICE}, {QTY}) as slope, regr_intercept({PRICE}, {QTY}) as intercept,
    regr_r2({PRICE}, {QTY}) as r2, regr_sxx({PRICE}, {QTY}) as sxx, regr_syy({PRICE}, {QTY}) as syy, avg({QTY}) as mx, count(*) as n from lineitem),
  b as (select *, (1 - r2) * syy / (n - 2) as v from a) select round(slope, 4) + 0.0 as slope, round(intercept, 4) + 0.0 as intercept, round(r2, 6) + 0.0 as r2,
  round(sqrt(v / sxx), 4) as se_slope, round(sqrt(v * (1.0 / n + mx * mx / sxx)), 4) as se_intercept, n from b""")
def _(s, d):
    out = stats.simple_regression(line(s, d), QTY, PRICE)
    return out.select(*[r6(c, 6 if c == "r2" else 4).alias(c) for c in ("slope", "intercept", "r2", "se_slope", "se_intercept")], "n")


@BOOK.add("anova_oneway", "H11", """with g as (select count(*) as n, avg(o_totalprice) as m, var_pop(o_totalprice) as v from orders group by o_orderpriority),
  a as (select sum(n * m) / sum(n) as gm from g), s as (select sum(n * (m - gm) * (m - gm)) as sb, sum(n * v) as sw, count(*) - 1 as db,
  (sum(n) - count(*))::bigint as dw from g, a)
  select round(sb / 1e6, 4) as ss_between_m, round(sw / 1e6, 3) as ss_within_m, round(f, 6) as f, db as df_between, dw as df_within,
  round(exp(dw / 2.0 * ln(x)) * (1 + dw / 2.0 * (1 - x)), 6) + 0.0 as p_value from
  (select *, dw / (dw + db * f) as x from (select *, (sb / db) / (sw / dw) as f from s))""")
def _(s, d):
    """Five groups: with four degrees of freedom above, the tail of F is a closed form."""
    out = stats.anova_oneway(table(s, d, "orders"), "o_orderpriority", "o_totalprice")
    return out.select(r6(F.col("ss_between") / 1e6, 4).alias("ss_between_m"), r6(F.col("ss_within") / 1e6, 3).alias("ss_within_m"),
                      r6("f").alias("f"), "df_between", "df_within", r6("p_value").alias("p_value"))


# ---- one-aggregate models --------------------------------------------------------------------------------------


@BOOK.add("least_squares_origin", "M02", f"select round(sum({QTY} * {PRICE}) / sum({QTY} * {QTY}), 4) as theta from lineitem")
def _(s, d):
    return models.least_squares_origin(line(s, d), QTY, PRICE).select(r6("theta", 4).alias("theta"))


SHARES = [0.01, 0.1, 0.5, 1.0]


@BOOK.add("estimate_error_curve", "M03", " union all ".join(f"""select floor(top * {f})::bigint as size, round(abs(sum(k * (3 * k + o_totalprice / 1000))
  / sum(k * k) - 3), 6) as error from (select o_orderkey::double as k, o_totalprice, (select max(o_orderkey) from orders) as top from orders)
  where k <= floor(top * {f}) group by top""" for f in SHARES))
def _(s, d):
    x = F.col("o_orderkey").cast("double")
    rows = table(s, d, "orders").select("o_orderkey", x.alias("x"), (3 * x + F.col("o_totalprice") / 1000).alias("y"))
    top = rows.agg(F.max("o_orderkey")).first()[0]
    out = models.estimate_error_curve(rows, "o_orderkey", "x", "y", 3.0, [int(top * f) for f in SHARES])
    return out.select(F.col("size").cast("long").alias("size"), r6("error").alias("error"))


# ---- candidate scoring -----------------------------------------------------------------------------------------


def candidates(s, d):
    edges = table(s, d, "part").select(F.col("p_partkey").alias("edge"), F.col("p_retailprice").alias("cost"))
    chosen = line(s, d).select((F.col("l_orderkey") % 100).alias("candidate"), F.col("l_partkey").alias("edge")).distinct()
    return scoring.score_selections(chosen, edges)


SCORES = """c as (select distinct l_orderkey % 100 as candidate, l_partkey as p_partkey from lineitem),
  s as (select candidate, sum(p_retailprice) as cost, 1 - sum(p_retailprice) / (select sum(p_retailprice) from part) as fitness
  from c join part using (p_partkey) group by 1)"""


@BOOK.add("score_selections", "O01", f"with {SCORES} select candidate, round(cost, 4) as cost, round(fitness, 6) + 0.0 as fitness from s")
def _(s, d):
    return candidates(s, d).select("candidate", r6("cost", 4).alias("cost"), r6("fitness").alias("fitness"))


@BOOK.add("score_summary", "O01", f"""with {SCORES} select round(max(fitness), 6) as best, round(avg(fitness), 6) as mean, count(*) as candidates from s""")
def _(s, d):
    return scoring.score_summary(candidates(s, d)).select(r6("best").alias("best"), r6("mean").alias("mean"), "candidates")


HIMMEL = """b as (select o_orderkey, lpad(bin(o_orderkey % 65536), 16, '0') as bits from orders),
  v as (select o_orderkey, bits, ((o_orderkey % 65536) % 256) * (12 / 255.0::double) - 6 as x, ((o_orderkey % 65536) // 256) * (12 / 255.0::double) - 6 as y from b),
  z as (select *, pow(x * x + y - 11, 2) + pow(x + y * y - 7, 2) as f from v)"""


def himmel(s, d):
    rows = table(s, d, "orders").select("o_orderkey", F.lpad(F.bin(F.col("o_orderkey") % 65536), 16, "0").alias("bits"))
    return scoring.decode_and_score(rows, "bits", 16)


@BOOK.add("decode_and_score", "O02", f"""with {HIMMEL} select o_orderkey, bits, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, round(f, 6) as "value" from z""")
def _(s, d):
    return himmel(s, d).select("o_orderkey", "bits", *[r6(c).alias(c) for c in ("x", "y", "value")])


@BOOK.add("decode_and_score_best", "O02", f"""with {HIMMEL} select o_orderkey, round(f, 6) as "value" from z order by round(f, 9), o_orderkey limit 5""")
def _(s, d):
    best = top_k(himmel(s, d).withColumn("_v", F.round("value", 9)), ["_v", "o_orderkey"], 5)
    return best.select("o_orderkey", r6("value").alias("value"))
