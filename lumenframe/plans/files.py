"""Source and sink queries: tables are written below the shared folder and read back, or reshaped."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.functions.ordering import fresh_path
from lumenframe.plans.book import Book, table
from lumenframe.sources import files, reshape

BOOK = Book()
ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


@BOOK.add("read_csv", "S01", "select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus, o_totalprice from orders")
def _(s, d):
    path = fresh_path(s, "orders-csv")
    files.write_csv(table(s, d, "orders"), path)
    return files.read_csv(s, path, ORDER_SCHEMA, ["o_orderkey", "o_orderstatus", "o_totalprice"], null_value="P")


@BOOK.add("read_parquet", "S02", "select l_orderkey, l_linenumber, l_shipdate from lineitem")
def _(s, d):
    return files.read_parquet(s, f"{d}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_shipdate"])


def text_folder(s, d):
    path = fresh_path(s, "texts")
    (table(s, d, "documents").select("lang", "text").write.partitionBy("lang").option("maxRecordsPerFile", 1000).text(path))
    return path


@BOOK.add("read_labelled_text_dir", "S03", """select case lang when 'en' then 1 when 'fr' then 2 when 'de' then 3 else 4 end as "label",
  sum(length("text") + 1)::bigint as n_chars from documents group by 1""")
def _(s, d):
    rows = files.read_labelled_text_dir(s, text_folder(s, d), {"lang=en": 1, "lang=fr": 2, "lang=de": 3, "lang=es": 4})
    return rows.groupBy("label").agg(F.sum(F.length("text")).alias("n_chars"))


@BOOK.add("read_binary_dir", "S04", """select lang as "label", sum(strlen("text") + 1)::bigint as n_bytes from documents group by 1""")
def _(s, d):
    rows = files.read_binary_dir(s, text_folder(s, d), r"lang=([^/]+)/[^/]+$", "*.txt")
    return rows.groupBy("label").agg(F.sum(F.octet_length("content")).cast("bigint").alias("n_bytes"))


@BOOK.add("read_edge_list", "S05", "select l_suppkey as src, l_partkey as dst, sum(l_quantity) as cost from lineitem group by 1, 2")
def _(s, d):
    path = fresh_path(s, "edges")
    table(s, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity").write.csv(path)
    return files.read_edge_list(s, path).groupBy("src", "dst").agg(F.sum("cost").alias("cost"))


@BOOK.add("matrix_to_edges", "S06", """with c as (select vec_id as i, generate_subscripts(embedding, 1) - 1 as j, unnest(embedding)::double as w from embeddings)
  select least(i, j) as src, greatest(i, j) as dst, round(max(w), 6) + 0.0 as weight from c where w <> 0 group by 1, 2""")
def _(s, d):
    return reshape.matrix_to_edges(table(s, d, "embeddings"), "vec_id", "embedding").withColumn("weight", F.round("weight", 6) + 0.0)


@BOOK.add("flatten_json_items", "S07", """select event_id, event_type as full_name, cast(json_extract(props, '$.k') as bigint) as k from events
  union all select event_id, 'copy', cast(json_extract(props, '$.k') as bigint) from events""")
def _(s, d):
    item = lambda name: F.concat(F.lit('{"full_name":"'), name, F.lit('",'), F.expr("substring(props, 2)"))
    made = table(s, d, "events").select("event_id", F.concat(
        F.lit('{"items":['), item(F.col("event_type")), F.lit(","), item(F.lit("copy")), F.lit("]}")).alias("body"))
    return reshape.flatten_json_items(made, "body", {"full_name": "string", "k": "bigint"}, "event_id")


@BOOK.add("decode_code_files", "S08", """select 'src/' || lang || '/F' || doc_id || '.java' as path, 'F' || doc_id || '.java' as file_name, "text" as code
  from documents where doc_id % 3 = 0""")
def _(s, d):
    ext = F.when(F.col("doc_id") % 3 == 0, ".java").when(F.col("doc_id") % 3 == 1, ".py").otherwise(".java.txt")
    made = table(s, d, "documents").select(F.concat(F.lit("src/"), "lang", F.lit("/F"), F.col("doc_id").cast("string"), ext).alias("path"),
                                           F.base64(F.encode("text", "UTF-8")).alias("content"))
    return reshape.decode_code_files(made, "path", "content", "java")


@BOOK.add("load_wordlist", "S09", r"""select distinct unnest(regexp_extract_all(lower("text"), '[\p{L}\p{N}_]+')) as word from documents
  union select unnest(['wa', 'reported', 'zz top'])""")
def _(s, d):
    path = fresh_path(s, "words")
    found = table(s, d, "documents").select(F.explode(W.word_tokens("text")).alias("w")).distinct()
    found.select(F.concat("w", F.lit("  "))).write.text(path)
    return files.load_wordlist(s, path, ["wa", "reported", "zz top"])


@BOOK.add("write_csv", "S10", """select page_id, url from pages""")
def _(s, d):
    path = fresh_path(s, "pages-csv")
    files.write_csv(table(s, d, "pages").select("page_id", "url"), path)
    return files.read_csv(s, path, "page_id bigint, url string")


@BOOK.add("csv_with_line_breaks", "S10", """select doc_id, "text", lang from documents""")
def _(s, d):
    path = fresh_path(s, "documents-csv")
    files.write_csv(table(s, d, "documents").select("doc_id", "text", "lang"), path)
    return files.read_csv(s, path, "doc_id bigint, text string, lang string", multi_line=True)
