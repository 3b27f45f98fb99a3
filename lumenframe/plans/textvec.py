"""Vocabulary, tf-idf, sequence and word vector queries over documents and conversations."""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.functions.joins import spread
from lumenframe.functions.numbers import r6
from lumenframe.functions.ordering import cut
from lumenframe.operators import skipgram, textvec
from lumenframe.plans.book import Book, table

BOOK = Book()


def docs(s, d):
    return spread(table(s, d, "documents").select("doc_id", "text"))


WORDS = r"""regexp_extract_all(lower("text"), '[\p{L}\p{N}_]+')"""
WORDS2 = r"""regexp_extract_all(lower("text"), '[\p{L}\p{N}_]{2,}')"""
ROWS = f"""rows_ as (select doc_id, unnest({WORDS}) as token, generate_subscripts({WORDS}, 1) - 1 as pos from documents)"""
ROWS2 = f"""rows_ as (select doc_id, unnest({WORDS2}) as token from documents)"""


@BOOK.add("token_counts", "V01", f"with {ROWS} select token, count(*) as n from rows_ group by 1")
def _(s, d):
    return textvec.token_counts(docs(s, d), W.word_tokens("text"))


@BOOK.add("build_vocab", "V02", f"""with {ROWS} select '<pad>' as token, null as n, 0 as id union all select '<unk>', null, 1 union all
  select token, count(*), row_number() over (order by count(*) desc, token) + 1 from rows_ group by 1 having count(*) >= 3""")
def _(s, d):
    return textvec.build_vocab(textvec.token_counts(docs(s, d), W.word_tokens("text")), 3, ("<pad>", "<unk>"))


@BOOK.add("bag_of_words", "V03", f"""with {ROWS2}, v as (select token, row_number() over (order by token) - 1 as term_id from
  (select distinct token from rows_)) select doc_id, token, term_id, count(*) as tf from rows_ join v using (token) group by 1, 2, 3""")
def _(s, d):
    return textvec.bag_of_words(docs(s, d), "doc_id", "text")


@BOOK.add("term_document_matrix", "V04", f"""with {ROWS}, v as (select token, row_number() over (order by min((doc_id, pos))) - 1 as term_id
  from rows_ group by 1) select term_id, token, doc_id, count(*) as tf from rows_ join v using (token) group by 1, 2, 3""")
def _(s, d):
    return textvec.term_document_matrix(docs(s, d), "doc_id", W.word_tokens("text"))


TFIDF = f"""{ROWS2}, c as (select doc_id, token, count(*) as tf from rows_ group by 1, 2),
  n as (select count(*) as n from documents), f as (select token, ln((1 + n) / (1 + count(*))) + 1 as idf from c, n group by token, n),
  w as (select doc_id, token, tf, tf * idf as raw from c join f using (token)),
  t as (select doc_id, token, tf, raw / sqrt(sum(raw * raw) over (partition by doc_id)) as weight from w)"""


@BOOK.add("tfidf", "V05", f"with {TFIDF} select doc_id, token, tf, round(weight, 6) as weight from t")
def _(s, d):
    out = textvec.tfidf(docs(s, d), "doc_id", W.word_tokens("text", W.WORD2))
    return out.withColumn("weight", r6("weight"))


@BOOK.add("tfidf_top_terms", "V05", f"""with {TFIDF} select doc_id, token, round(weight, 6) as weight, rn as "rank" from (select *,
  row_number() over (partition by doc_id order by round(weight, 9) desc, token)::int as rn from t) where rn <= 5""")
def _(s, d):
    out = textvec.top_terms(textvec.tfidf(docs(s, d), "doc_id", W.word_tokens("text", W.WORD2)), "doc_id", 5)
    return out.select("doc_id", "token", r6("weight").alias("weight"), "rank")


@BOOK.add("encode_sequences", "V06", f"""with {ROWS}, v as (select token, row_number() over (order by count(*) desc, token) + 1 as id
    from rows_ group by 1 having count(*) >= 3)
  select doc_id, coalesce(string_agg(coalesce(id, 1)::varchar, ' ' order by pos), '') as ids, count(pos)::int as length
  from (select doc_id from documents) left join rows_ using (doc_id) left join v using (token) group by 1""")
def _(s, d):
    vocab = textvec.build_vocab(textvec.token_counts(docs(s, d), W.word_tokens("text")), 3, ("<pad>", "<unk>"))
    out = textvec.encode_sequences(docs(s, d), "doc_id", W.word_tokens("text"), vocab)
    return out.select("doc_id", F.array_join(F.transform("ids", lambda x: x.cast("string")), " ").alias("ids"), "length")


@BOOK.add("pad_batches", "V07", rf"""with x as (select conv_id, turn, role, list_transform({WORDS}, lambda t: length(t)) as ids,
    (row_number() over (order by conv_id, turn, role, "text") - 1) // 32 as batch from conversations),
  y as (select *, len(ids)::int as length, max(len(ids)) over (partition by batch) as m from x)
  select conv_id, turn, role, batch, length, array_to_string(list_concat(ids, list_transform(range(m - length), lambda z: 0)), ' ') as ids from y""")
def _(s, d):
    seqs = table(s, d, "conversations").select("conv_id", "turn", "role", "text",
                                               F.transform(W.word_tokens("text"), lambda t: F.length(t)).alias("ids"))
    out = textvec.pad_batches(seqs, ["conv_id", "turn", "role", "text"], "ids", 32)
    return out.select("conv_id", "turn", "role", "batch", "length",
                      F.array_join(F.transform("ids", lambda x: x.cast("string")), " ").alias("ids"))


@BOOK.add("word2vec", "V08")
def _(s, d):
    model = textvec.word2vec(docs(s, d), W.word_tokens("text"), size=100, window=5, min_count=5, partitions=s.sparkContext.defaultParallelism)
    return model.getVectors().select("word", F.array_join(F.transform(vector_to_array("vector"), lambda v: F.round(v, 4).cast("string")), " ").alias("vector"))


@BOOK.add("word_vectors", "V08", f"with {ROWS} select token, count(*) as n, 100 as width, true as moved from rows_ group by 1 having count(*) >= 5")
def _(s, d):
    """Five passes with the vectors spread over the tasks; every vector has left the small cube it was drawn from."""
    out = skipgram.skipgram(docs(s, d), W.word_tokens("text"), size=100, window=5, min_count=5, passes=5)
    return out.select("token", "n", F.size("vector").alias("width"), F.exists("vector", lambda x: F.abs(x) > 0.005).alias("moved"))


@BOOK.add("similar_words", "V08")
def _(s, d):
    """The ten words nearest to each of the twenty most frequent ones."""
    vectors = cut(skipgram.skipgram(docs(s, d), W.word_tokens("text"), size=100, window=5, min_count=5, passes=5))
    asked = vectors.orderBy(F.desc("n"), "token").limit(20).select(F.col("token").alias("word"))
    return skipgram.similar_words(vectors, asked, 10)


@BOOK.add("embed_tokens", "V09", f"""with {ROWS}, v as (select token, row_number() over (order by count(*) desc, token) as id from rows_ group by 1),
  e as (select doc_id, j, ((id * (j + 3)) % 17) / 17.0::double as x from rows_ join v using (token), unnest(range(4)) as u(j) where id % 3 <> 0)
  select doc_id, j::int as dim, round(avg(x), 6) as "value" from e group by 1, 2""")
def _(s, d):
    vocab = textvec.build_vocab(textvec.token_counts(docs(s, d), W.word_tokens("text"))).where("id % 3 <> 0")
    vectors = vocab.select("token", "n", F.array(*[(F.col("id") * (j + 3)) % 17 / 17.0 for j in range(4)]).alias("vector"))
    out = textvec.embed_tokens(docs(s, d), "doc_id", W.word_tokens("text"), vectors)
    return out.withColumn("value", r6("value"))
