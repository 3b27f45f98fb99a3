r"""Personal data: patterns, and terms that give a protected entity away, with DataFrame operations only.

Base: e-mail addresses, IPv4 addresses, payment cards and phone numbers, leftmost and non-overlapping per kind; a match
that fails its check (parts, Luhn, digits) is dropped without a retry. The patterns equal those of the contract but are
written so that matching is linear: a run is entered at its start only, and repeats are possessive.

Method: every distinct value found is a protected entity. Over the whole corpus it is counted in how many documents a
term and an entity occur together, n(t, e), and in how many documents the term occurs at all, n(t).
Knowing t leaves -log2 p(e|t) bits of e unknown, with p(e|t) = n(t, e) / n(t), and gains log2(p(e|t) / p(e)) bits. A
term discloses e if at most `LEFT_BITS` stay unknown, something and at least the share `GAIN_SHARE` of -log2 p(e) is
gained, and `SUPPORT` different texts say so; nothing can be gained of an entity that all documents name. Texts that
differ in white space only are copies: they count in n, but one text and its copies are no evidence.
Such terms are marked, in whole texts, wherever the document names an entity that they disclose; in `sanitised` a term
with digits is generalised to their number and any other term is removed. Documents without personal data stay as
they are.

Words are those of the whole text, at any distance from the entity, each once per document. Pairs are counted for the
entities that `SUPPORT` different texts name, in one copy of each text, and once for all entities that the same texts
name: a list of thousands of addresses that several documents hold is one class, not thousands of pairs per word. Words
of all documents are matched against the terms of such pairs only. Pairs are combined before each shuffle.

Defined results: null and empty texts have no spans. Repeated rows each get their own result and count as documents of
their own, but as one text. A null doc_id stays null. An empty table gives an empty result. Very long texts are read
whole. Extra columns are ignored. Offsets are code points, ends exclusive.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import ASCII_SPACE, landed

KINDS = ("email", "ip", "card", "phone")
#: The four patterns in linear form, in the order of KINDS.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9]++(?:[\x20-][0-9]++)*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must contain for the pattern to be worth trying: a cheap test that is true wherever the pattern can pass its check.
HINTS = (r"@[A-Za-z0-9-]", r"[0-9]\.[0-9]++\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){15}", r"\+[0-9]")
TERM = r"[\p{L}\p{N}]+"
TERM_KIND = "term"
SUPPORT = 2
LEFT_BITS = 1.0
GAIN_SHARE = 0.5
BROADCAST_TERMS = 200_000
PIECE = 1_024


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of digits from the right, every second one doubled, is a multiple of ten."""
    back = F.reverse(digits)
    one = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 1, one(i)).otherwise(F.when(one(i) > 4, one(i) * 2 - 9).otherwise(one(i) * 2))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    digits = _digits(hit)
    small = F.forall(F.split(hit, r"\."), lambda x: F.regexp_replace(x, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    card = F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, small).when(kind == 2, card).otherwise(F.length(digits).between(8, 15)))


def _by_kind(kind: Column, make) -> Column:
    out = F.when(kind == 0, make(PATTERNS[0]))
    for i, p in enumerate(PATTERNS[1:], 1):
        out = out.when(kind == i, make(p))
    return out


def rows_with_hits(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id, text and text_key where a pattern may match) of all documents, and all candidates with the length of the
    gap before. Copies have one text_key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = F.filter(F.array(*[F.when(F.col("text").rlike(h), F.lit(i)) for i, h in enumerate(HINTS)]), lambda x: x.isNotNull())
    rows = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("kinds", kinds)
            .select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.when(F.size("kinds") > 0, F.col("text")).alias("text"),
                    F.when(F.size("kinds") > 0, F.sha2(F.regexp_replace("text", ASCII_SPACE, " ").cast("binary"), 256)).alias("text_key"), "kinds"))
    rows = landed(rows, "private-rows")
    kind = F.col("kind")
    wide = (rows.where(F.size("kinds") > 0).select("uid", "text", F.explode("kinds").alias("kind"))
            .withColumn("parts", _by_kind(kind, lambda p: F.split("text", p, -1)))
            .withColumn("hits", _by_kind(kind, lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0)))))
    placed = F.transform("hits", lambda h, i: F.struct(h.alias("hit"), F.length(F.get("parts", i)).alias("gap")))
    return rows, wide.where(F.size("hits") > 0).select("uid", "kind", F.posexplode(placed).alias("no", "h")).select("uid", "kind", "no", "h.*")


def base_spans(hits: DataFrame) -> DataFrame:
    """(uid, kind, start, end, hit) of the candidates that pass their check."""
    up_to = Window.partitionBy("uid", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.length("hit")).over(up_to)
    placed = hits.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
    return placed.where(_valid(F.col("kind"), F.col("hit"))).select("uid", "kind", "start", "end", "hit")


def _entity(kind: Column, hit: Column) -> Column:
    return F.concat_ws(":", kind.cast("string"), F.when(kind <= 1, F.lower(hit)).otherwise(_digits(hit)))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def mentions(spans: DataFrame) -> DataFrame:
    """(uid, entity): the entities that a document names, once per document."""
    return spans.select("uid", _entity(F.col("kind"), F.col("hit")).alias("entity")).distinct()


def classes(named: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(entity, class, n_entity) of the entities that `support` texts name; class is the least entity named by the same texts
    in as many copies, found by two 64-bit sums over texts and copies. `named` is (entity, text_key, copies)."""
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "text_key", "copies"))
    able = (named.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count(F.lit(1)).alias("n_texts"), mark(1).alias("one"), mark(2).alias("two"))
            .where(F.col("n_texts") >= support))
    alike = ["n_entity", "n_texts", "one", "two"]
    return able.join(able.groupBy(*alike).agg(F.min("entity").alias("class")), alike).select("entity", "class", "n_entity")


def pairs(rows: DataFrame, named: DataFrame, heads: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(class, term, n_both): in how many documents a word of the text and an entity occur together, where `support` different
    texts say so. `heads` are the entities that stand for their class.

    The entities of a text are one row, so a frequent entity is no key of a join with texts; equal pairs are counted in
    the tasks before they are sent.
    """
    listed = (named.join(heads, "entity").groupBy("text_key")
              .agg(F.collect_list(F.struct(F.col("entity").alias("class"), "copies")).alias("classes")))
    texts = rows.where(F.col("text").isNotNull())
    one = texts.groupBy("text_key").agg(F.min("uid").alias("uid")).join(listed, "text_key").select("uid", "classes")
    words = texts.join(one, "uid").select("classes", F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    together = words.select(F.explode("classes").alias("c"), "term").select("c.*", "term")
    counted = together.groupBy("class", "term").agg(F.sum("copies").alias("n_both"), F.count(F.lit(1)).alias("n_texts"))
    return counted.where(F.col("n_texts") >= support).drop("n_texts")


def disclosing(docs: DataFrame, rows: DataFrame, spans: DataFrame, n_docs: int, text_col: str = "text", support: int = SUPPORT,
               left_bits: float = LEFT_BITS, gain_share: float = GAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(class, term, n_both, n_term, n_entity, left_bits, gain_bits) of the terms that give a class of entities away, and
    (entity, class, n_entity)."""
    named = landed(mentions(spans).join(rows.select("uid", "text_key"), "uid").groupBy("entity", "text_key")
                   .agg(F.count(F.lit(1)).alias("copies")), "private-mentions")
    members = landed(classes(named, support), "private-classes")
    heads = members.where(F.col("entity") == F.col("class"))
    both = landed(pairs(rows, named, heads.select("entity"), support), "private-pairs")
    terms = landed(both.select("term").distinct(), "private-terms")
    words = docs.select(F.explode(F.array_distinct(_words(F.coalesce(F.col(text_col), F.lit(""))))).alias("term"))
    count = lambda df: df.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    # size counted; beyond it words are added up first, so that a frequent one is no hot key of the join
    anywhere = count(words.join(F.broadcast(terms), "term")) if terms.count() <= BROADCAST_TERMS else count(words).join(terms, "term")
    scored = (both.join(anywhere, "term").join(heads.select("class", "n_entity"), "class")
              .withColumn("left_bits", -F.log2(F.col("n_both") / F.col("n_term")))
              .withColumn("gain_bits", F.log2(F.col("n_both") * F.lit(float(n_docs)) / (F.col("n_term") * F.col("n_entity")))))
    own = F.log2(F.lit(float(n_docs)) / F.col("n_entity"))
    found = scored.where((F.col("left_bits") <= left_bits) & (F.col("gain_bits") > 0) & (F.col("gain_bits") >= own * gain_share))
    return found, members


def term_spans(rows: DataFrame, spans: DataFrame, found: DataFrame, members: DataFrame) -> DataFrame:
    """(uid, kind, start, end) of the disclosing terms in the documents that name their entity, outside base spans."""
    named = mentions(spans).join(members.select("entity", "class"), "entity").select("uid", "class").distinct()
    wanted = named.join(found.select("class", "term"), "class").select("uid", "term").distinct()
    texts = rows.where(F.col("text").isNotNull()).join(wanted.select("uid").distinct(), "uid").select(
        "uid", F.split("text", TERM, -1).alias("parts"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("words"))
    each = texts.select("uid", F.posexplode(F.transform("words", lambda w, i: F.struct(w.alias("w"), F.length(F.get("parts", i)).alias("gap")))).alias("no", "x"))
    up_to = Window.partitionBy("uid").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.select("uid", "no", F.lower("x.w").alias("term"), F.length("x.w").alias("len"), (F.col("x.gap") + F.length("x.w")).alias("step"))
    placed = placed.withColumn("end", F.sum(F.col("step").cast("long")).over(up_to)).withColumn("start", F.col("end") - F.col("len"))
    terms = placed.join(wanted, ["uid", "term"]).select("uid", F.lit(len(KINDS)).alias("kind"), "start", "end")
    both = terms.unionByName(spans.select("uid", "kind", "start", "end"))
    is_base = F.col("kind") < len(KINDS)
    order = Window.partitionBy("uid").orderBy("start", "kind", "end")
    back = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    marked = both.withColumn("back", back).withColumn("ahead", ahead)
    free = (F.coalesce(F.col("back") <= F.col("start"), F.lit(True))) & (F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True)))
    return marked.where(~is_base & free).select("uid", "kind", "start", "end")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                 left_bits: float = LEFT_BITS, gain_share: float = GAIN_SHARE) -> DataFrame:
    """One row per document: uid, doc_id, text (null where no pattern can match) and spans, an array of (kind, start, end,
    seen) sorted by kind (number in KINDS, then terms) and start; seen is where the spans that begin before end."""
    rows, hits = rows_with_hits(docs, id_col, text_col)
    spans = landed(base_spans(hits), "private-spans")
    found, members = disclosing(docs, rows, spans, rows.count(), text_col, support, left_bits, gain_share)
    every = spans.select("uid", "kind", "start", "end").unionByName(term_spans(rows, spans, landed(found, "private-disclosing"), members))
    before = Window.partitionBy("uid").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
    listed = every.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "seen"))).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,seen:bigint>>")
    return (rows.join(listed, "uid", "left").select("uid", "doc_id", "text", F.coalesce("spans", none).alias("spans")))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM_KIND)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(found: DataFrame) -> DataFrame:
    """The counts and digests of the contract, from the spans; clean_sha256 is that of the sanitised text, null without spans."""
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    of_kind = lambda i: F.filter("spans", lambda s: s["kind"] == i)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    clean = F.when(F.size("spans") > 0, F.sha2(clean_text(F.col("text"), F.col("spans")).cast("binary"), 256))
    return found.withColumn("clean_sha256", clean).select("doc_id", *counts, F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), "clean_sha256")


def clean_text(text: Column, spans: Column) -> Column:
    """Each maximal marked stretch becomes its kind in brackets; a term with digits becomes one # per digit, any other term goes.

    Stretches are taken out of pieces of PIECE characters, so the work follows the text and not text times spans.
    """
    let = lambda value, body: F.get(F.transform(F.array(value), body), 0)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    apart = F.filter(spans, lambda s: s["start"] >= s["seen"])
    ordered = F.sort_array(F.transform(apart, lambda s: F.struct(s["start"], s["end"], s["seen"], s["kind"])))

    def stretch(pieces: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.when(end > start, F.substring(near, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))).otherwise("")

    def filled(pieces: Column) -> Column:
        term = lambda s: F.repeat(F.lit("#"), F.length(_digits(stretch(pieces, s["start"], s["end"]))))
        put = lambda s: F.when(s["kind"] == len(KINDS), term(s)).otherwise(F.get(names, s["kind"]))
        done = F.array_join(F.transform(ordered, lambda s: F.concat(stretch(pieces, s["seen"], s["start"]), put(s))), "")
        return F.concat(done, stretch(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text).cast("long")))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), filled)


def sanitised(found: DataFrame) -> DataFrame:
    """(uid, clean_text) of the documents with spans."""
    return found.where(F.size("spans") > 0).select("uid", clean_text(F.col("text"), F.col("spans")).alias("clean_text"))
