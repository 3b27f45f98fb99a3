"""The numbered queries of this subpackage, each next to its SQL where SQL can state it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.llm import bpe, capfilter, exact, langid, mixing, periodic, private, quality, search, simhash, suffix, trie, warc
from lumenframe.llm.common import is_held_out, landed
from lumenframe.plans.book import Book, table

BOOK = Book()


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@BOOK.add("op1_suffix_dedup", "LLM1")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return suffix.suffix_dedup(table(spark, d, "documents").select("doc_id", "text"))


@BOOK.add("op2_simhash", "LLM2")
def op2(spark: SparkSession, d: str) -> DataFrame:
    rows = simhash.simhash_groups(table(spark, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@BOOK.add("op4_language", "LLM4")
def op4(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("held_out", is_held_out())
    profiles = langid.train_profiles(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")


@BOOK.add("op6_mix", "LLM6", f"""
with sizes as (select source, sum(length(coalesce(text, '')))::bigint as size from documents group by source),
aims as (select *, pow(size::double, {mixing.ALPHA}) as aim, sum(size) over () as total, sum(pow(size::double, {mixing.ALPHA})) over () as aims from sizes),
rates as (select source, case when size > 0 then aim / aims * total / size else 0 end as rate from aims),
terms as (select source, rate, k, -rate + sum(case when k = 0 then 0 else ln(rate) - ln(k) end) over (partition by source order by k) as log
          from (select source, rate, unnest(range(0, (ceil(rate + 12 * sqrt(rate) + 24))::bigint + 1)) as k from rates where rate > 0)),
cdf as (select source, k, sum(exp(log)) over (partition by source order by k) as p from terms),
lists as (select source, list(p order by k) as ps from cdf group by source),
drawn as (select doc_id, source, ('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, {mixing.DIGITS}))::bigint / {1 << 4 * mixing.DIGITS}.0::double as u from documents),
counts as (select doc_id, drawn.source, rate, len(list_filter(ps, lambda p: p <= u)) as n
           from drawn join lists on drawn.source is not distinct from lists.source join rates on rates.source is not distinct from drawn.source)
select doc_id, source, rate, c.copy::int as copy, ('0x' || substr(md5('{mixing.SEED}:' || doc_id || ':' || c.copy), 1, {mixing.DIGITS}))::bigint as order_key
from (select doc_id, source, round(rate, 9) as rate, unnest(range(1, n + 1)) as copy from counts) c""")
def op6(spark: SparkSession, d: str) -> DataFrame:
    """The mixed documents are written with all columns; the rows of the SQL are read from them."""
    mixed = landed(mixing.mix(table(spark, d, "documents")), "mix")
    return mixing.shuffled(mixed.select("doc_id", "source", F.round("rate", 9).alias("rate"), "copy", "order_key"))


@BOOK.add("op7_bpe", "LLM7")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"), tokenizer_path(), want=("n_tokens", "ids_sha256", "decoded_sha256"))


@BOOK.add("op10_exact_dedup", "LLM10", r"""
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, sha256(t) as text_sha256
from (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents) window w as (partition by t)""")
def op10(spark: SparkSession, d: str) -> DataFrame:
    rows = exact.exact_duplicates(table(spark, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


NEAREST_SQL = """
with usable as (select vec_id, embedding::double[] as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_distance(q.e, c.e) as score from usable q join usable c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, (row_number() over (partition by query_id order by score, vec_id))::int as rank, vec_id, score from pairs
qualify row_number() over (partition by query_id order by score, vec_id) <= 10"""


@BOOK.add("op3_vector_search", "LLM3", NEAREST_SQL)
def op3(spark: SparkSession, d: str) -> DataFrame:
    return search.nearest_of(table(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@BOOK.add("op8_warc", "LLM8", f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as h from pages),
f as (select *, min(page_id) over (partition by h) as first from p)
select page_id, n as payload_bytes, h as payload_digest, case when n >= {warc.LEAST} and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= {warc.LEAST} and page_id <> first then first end as refers_to from f""")
def op8(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    _, index, folder = warc.archive(pages)
    return warc.read_records(warc.find_captures(index, warc.url_keys(pages)), folder)


@BOOK.add("op5_quality", "LLM5")
def op5(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels").select("doc_id", "quality")
    return quality.resample(docs, labels)


@BOOK.add("op9_private", "LLM9")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return private.summary(private.find_private(table(spark, d, "documents").select("doc_id", "text")))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth text by crc32 of its id ends in a repeated stretch of its own words, as the contract of op11 asks."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = docs.withColumn("_h", h).withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_w"), F.floor(F.col("_h") / 10)
    plan = (marked.withColumn("_a", F.when(n > 0, (g % n).cast("int")))
            .withColumn("_p", F.when(n > 0, (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int"))))
    tail = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return plan.withColumn("text", F.when(F.col("_a").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text"))).select(*docs.columns)


@BOOK.add("op11_periodic_runs", "LLM11")
def op11(spark: SparkSession, d: str) -> DataFrame:
    found = periodic.find_runs(repeated_tails(table(spark, d, "documents").select("doc_id", "text")))
    best = F.col("strongest")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


NEAR_VECTORS_SQL = """
with recursive usable as (select vec_id, embedding::double[] as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as src, b.vec_id as dst from usable a join usable b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) as (select vec_id, vec_id from embeddings union select reach.vec_id, links.dst from reach join links on links.src = reach.other),
heads as (select vec_id, min(other) as component_id from reach group by vec_id),
counts as (select src, count(*) as n from links group by src)
select heads.vec_id, coalesce(n, 0)::bigint as n_links, component_id, heads.vec_id = component_id as kept
from heads left join counts on counts.src = heads.vec_id"""


@BOOK.add("op12_near_vectors", "LLM12", NEAR_VECTORS_SQL)
def op12(spark: SparkSession, d: str) -> DataFrame:
    rows = capfilter.near_vectors(table(spark, d, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


HEAD_TURNS = 6        # a rebuilt conversation starts with fewer turns than this of its base
BASE = 100            # conversations of one base


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, size) of every conversation after its first turns are exchanged for those of its base."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(BASE))
    heads = turns.where((F.pmod("conv_id", F.lit(BASE)) == 0) & (F.col("pos") < HEAD_TURNS)).withColumnRenamed("conv_id", "base")
    lent = convs.withColumns({"base": base, "h": h}).join(heads, "base").where(F.col("pos") <= F.col("h")).select("conv_id", "pos", "tid", "size")
    held = heads.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    own = salted_join(turns.withColumns({"base": base, "h": h}).where(F.col("pos") > F.col("h")), held, "base")
    place = F.col("pos") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0).cast("long")))
    return lent.unionByName(own.select("conv_id", place.alias("pos"), "tid", "size"))


TRIE_SQL = """
with recursive ids as (select distinct conv_id from conversations where conv_id is not null),
crc(conv_id, i, v) as (select conv_id, 0, 4294967295::bigint from ids union all
  select conv_id, i + 1, xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)
  from (select conv_id, i, case when i % 8 = 0 then xor(v, ascii(substr(conv_id::varchar, i // 8 + 1, 1))::bigint) else v end as x
        from crc where i < 8 * length(conv_id::varchar))),
h as (select conv_id, conv_id - (conv_id % 100 + 100) % 100 as base, xor(v, 4294967295) % 6 as h from crc where i = 8 * length(conv_id::varchar)),
t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos, {'r': coalesce(role, ''), 't': coalesce(text, '')} as said
      from conversations where conv_id is not null),
rebuilt as (select h.conv_id, pos, said from h join t on t.conv_id = h.base and pos <= h
  union all select t.conv_id, pos - h + least(h, (select count(*) from t b where b.conv_id = h.base)), said from t join h on t.conv_id = h.conv_id and pos > h),
m as (select conv_id, pos as depth, said, list(said) over (partition by conv_id order by pos) as path from rebuilt
  union all select conv_id, 0, null, [] from ids),
keyed as (select conv_id, depth, length(said.t) as size, md5(path::varchar) as key, md5(path[:depth - 1]::varchar) as up,
  max(depth) over (partition by conv_id) as n from m),
nodes as (select key, depth, any_value(case when depth > 0 then up end) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = depth), '')) as ends_sha256 from keyed group by key, depth),
kids as (select up as key, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (key, depth)),
subtree as (select a.key, a.depth, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n_convs - 1) * coalesce(f.size, 0)) as saved_tokens
  from full_nodes f join keyed a on a.conv_id = f.conv_id and a.depth <= f.depth group by all)
select f.conv_id, f.depth::bigint as depth, p.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, f.ends_sha256
from full_nodes f join subtree s using (key, depth) left join nodes p on p.key = f.up and p.depth = f.depth - 1"""


@BOOK.add("op13_conversation_trie", "LLM13", TRIE_SQL)
def op13(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations")
    convs = landed(rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), "trie-convs")
    turns = landed(trie.numbered_turns(trie.encoded_turns(rows)), "trie-turns")
    return trie.prefix_trie(rebuilt_turns(turns, convs), convs)
