"""Text cleaning, issue extraction and sentiment queries over documents, pages, benchmark and conversations."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import words as W
from lumenframe.functions.joins import spread
from lumenframe.functions.numbers import r6
from lumenframe.operators import issues, relate, text
from lumenframe.operators.textvec import build_vocab, token_counts
from lumenframe.plans.book import Book, table

BOOK = Book()

# English function words used as stop words in the checks.
STOPWORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that",
             "the", "this", "to", "was", "were", "with"]
# Keywords for the issue extractor that occur in the documents.
TWO = {"device": "the", "reported": "and", "customer": "with", "patient": "for"}
ONE = {"device": "with", "patient": "for"}


def docs(s, d):
    return spread(table(s, d, "documents").select("doc_id", "text"))


def sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = sql_list(STOPWORDS)
WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
TOKENS = WORDS.format('"text"')
TOKEN_ROWS = f"""(select doc_id, pos, token from (select doc_id, unnest({TOKENS}) as token,
  generate_subscripts({TOKENS}, 1) - 1 as pos from documents))"""


def token_table(s, d):
    return text.token_rows(docs(s, d), "doc_id", W.word_tokens("text"))


@BOOK.add("strip_html", "T01", """select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as plain from pages""")
def _(s, d):
    return table(s, d, "pages").select("page_id", W.strip_html("html").alias("plain"))


SMILED = """(select doc_id, "text" || case doc_id % 3 when 0 then ' :-) and =D' when 1 then ' ;-( :P' else ' plain' end as t from documents)"""


def smiled(s, d):
    tail = F.when(F.col("doc_id") % 3 == 0, " :-) and =D").when(F.col("doc_id") % 3 == 1, " ;-( :P").otherwise(" plain")
    return docs(s, d).select("doc_id", F.concat("text", tail).alias("t"))


@BOOK.add("extract_emoticons", "T02", f"""select doc_id, replace(array_to_string(regexp_extract_all(t, '[:;=]-?[)(DP]'), ''), '-', '')
  as emoticons from {SMILED}""")
def _(s, d):
    return smiled(s, d).select("doc_id", W.extract_emoticons("t").alias("emoticons"))


@BOOK.add("clean_review", "T03", r"""with x as (select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as t from pages)
  select page_id, regexp_replace(lower(t), '[^\p{L}\p{N}_]+', ' ', 'g') ||
  replace(array_to_string(regexp_extract_all(lower(t), '[:;=]-?[)(DP]'), ''), '-', '') as spaced,
  regexp_replace(lower(t), '[^\p{L}\p{N}_]+', '', 'g') ||
  replace(array_to_string(regexp_extract_all(t, '[:;=]-?[)(DP]'), ''), '-', '') as joined from x""")
def _(s, d):
    return table(s, d, "pages").select("page_id", W.clean_review("html").alias("spaced"), W.clean_review("html", "joined").alias("joined"))


@BOOK.add("tokenize_space", "T04", r"""select doc_id, array_to_string(list_filter(string_split_regex("text", '[ \t\n\r\f\v]+'), lambda t: t <> ''), '|')
  as tokens from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", F.array_join(W.tokenize_space("text"), "|").alias("tokens"))


@BOOK.add("tokenize_clean", "T05", rf"""select doc_id, array_to_string(list_filter({TOKENS}, lambda t: length(t) > 2 and
  not list_contains({STOP}, t) and not regexp_matches(t, '\p{{Nd}}')), ' ') as tokens from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", F.array_join(W.tokenize_clean("text", STOPWORDS), " ").alias("tokens"))


@BOOK.add("process_text", "T06", rf"""select doc_id, array_to_string(list_transform(list_filter(string_split_regex(regexp_replace(
  translate("text", '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~', ''), '\p{{Nd}}', '', 'g'), '[ \t\n\r\f\v]+'), lambda t: t <> '' and
  not list_contains({STOP}, t)), lambda t: lower(t)), ' ') as tokens from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", F.array_join(W.process_text("text", STOPWORDS), " ").alias("tokens"))


@BOOK.add("clean_tweet", "T07", r"""select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace("text" ||
  case when doc_id % 3 = 0 then ' see http://a.example/x?y=1 by @Some_one!' else '' end, '[\p{L}\p{N}_]+://\S+', ' ', 'g'),
  '@[A-Za-z0-9]+', ' ', 'g'), '[^0-9A-Za-z \t]', ' ', 'g'), '[ \t]+', ' ', 'g'), ' ') as tweet from documents""")
def _(s, d):
    tail = F.when(F.col("doc_id") % 3 == 0, " see http://a.example/x?y=1 by @Some_one!").otherwise("")
    return docs(s, d).select("doc_id", W.clean_tweet(F.concat("text", tail)).alias("tweet"))


@BOOK.add("strip_code_format", "T08", r"""select doc_id, trim(replace(replace(replace(replace(replace("text", chr(10), ''), 'b''', ''),
  chr(13), ''), '''', ''), '\', ''), ' ') as code from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", W.strip_code_format("text").alias("code"))


COMMENTED = """(select doc_id, case doc_id % 3 when 0 then 'x = 1; /* first */ ' || "text" || ' /* last' || chr(10) || ' one */ y'
  when 1 then 'tail of a comment */ ' || "text" else "text" end as t from documents)"""


@BOOK.add("strip_block_comments", "T09", rf"""select doc_id, regexp_replace(regexp_replace(t, '(?s)/\*.*?\*/', '', 'g'), '(?s)^.*\*/', '', 'g')
  as code from {COMMENTED}""")
def _(s, d):
    t = (F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x = 1; /* first */ "), "text", F.lit(" /* last\n one */ y")))
         .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("tail of a comment */ "), "text")).otherwise(F.col("text")))
    return docs(s, d).select("doc_id", W.strip_block_comments(t).alias("code"))


@BOOK.add("normalize_tokens", "T10", f"""with f as (select token, left(token, length(token) - 1) as base from
    (select distinct token from {TOKEN_ROWS}) where length(token) > 4 and token like '%s')
  select t.doc_id, t.pos::int as pos, t.token, coalesce(f.base, t.token) as base from {TOKEN_ROWS} t left join f using (token)""")
def _(s, d):
    tokens = token_table(s, d)
    forms = (tokens.select("token").distinct().where((F.length("token") > 4) & F.col("token").endswith("s"))
             .select("token", F.expr("left(token, length(token) - 1)").alias("base")))
    return text.normalize_tokens(tokens, forms).select("doc_id", "pos", "token", "base")


@BOOK.add("ascii_only", "T11", r"""select doc_id, regexp_replace("text", '[^\x00-\x7F]', '', 'g') as plain from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", W.ascii_only("text").alias("plain"))


ISSUE_STOP, SYMBOLS = sql_list(W.ISSUE_STOPWORDS), sql_list(W.ISSUE_SYMBOLS)


def issue_sql(expr, stop=ISSUE_STOP):
    return f"""list_filter(string_split(lower({expr}), ' '), lambda t: (length(t) > 2 or length(t) = 1) and
  not list_contains({SYMBOLS}, t) and not list_contains({stop}, t))"""


@BOOK.add("tokenize_issue", "T12", f"""select doc_id, array_to_string({issue_sql('"text"')}, ' ') as tokens from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", W.tokenize_issue("text").alias("tokens"))


@BOOK.add("numeric_tokens", "T13", rf"""select doc_id, array_to_string(list_filter({issue_sql('"text"')},
  lambda t: regexp_matches(t, '\p{{Nd}}')), ' ') as scores from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", F.array_join(W.numeric_tokens(W.issue_tokens("text")), " ").alias("scores"))


@BOOK.add("split_sentences", "T14", """select doc_id, (generate_subscripts(string_split("text", '.'), 1) - 1)::int as pos,
  unnest(string_split("text", '.')) as sentence from documents""")
def _(s, d):
    return docs(s, d).select("doc_id", F.posexplode(W.split_sentences("text")).alias("pos", "sentence"))


SENTS = """string_split(lower("text"), '.')"""


def pick_sql(test):
    return f"list_filter({SENTS}, lambda t: {test})"


def has(k):
    return f"contains(t, '{k}')"


ROUTES = {"device": has("the"), "reported": f"not {has('the')} and {has('and')}", "customer": has("with"),
          "patient": f"not {has('with')} and {has('for')}", "other": f"not {has('with')} and not {has('for')}"}
EXCLUSIVE = {"device": has("with"), "patient": f"not {has('with')} and {has('for')}",
             "other": f"not {has('with')} and not {has('for')}"}


@BOOK.add("route_sentences", "T15", "select doc_id, " + ", ".join(
    f"array_to_string({pick_sql(t)}, '.') as {n}" for n, t in ROUTES.items()) + " from documents")
def _(s, d):
    routes = issues.route_sentences("text", TWO)
    return docs(s, d).select("doc_id", *[F.array_join(v, ".").alias(n) for n, v in routes.items()])


def phrases_sql(sents, trim="trim({}, ' ')"):
    inner = trim.format("x")
    return f"flatten(list_transform({sents}, lambda p: list_transform(string_split(p, ','), lambda x: {inner})))"


def context_sql(route, keyword, sides="both", trim="trim({}, ' ')"):
    part = lambda i: f"list_transform({pick_sql(route)}, lambda t: coalesce(string_split(t, '{keyword}')[{i}], ''))"
    after = phrases_sql(part(2), trim)
    return after if sides == "after" else f"list_concat({after}, {phrases_sql(part(1), trim)})"


@BOOK.add("keyword_context", "T16", f"""select doc_id, array_to_string({context_sql(ROUTES['device'], 'the')}, '|') as both_sides,
  array_to_string({context_sql(ROUTES['device'], 'the', 'after')}, '|') as after_side from documents""")
def _(s, d):
    found = issues.route_sentences("text", TWO)["device"]
    return docs(s, d).select("doc_id", F.array_join(issues.keyword_context(found, "the"), "|").alias("both_sides"),
                             F.array_join(issues.keyword_context(found, "the", "after"), "|").alias("after_side"))


CLASS_SQL = {"device": f"list_concat({context_sql(ROUTES['device'], 'the')}, {context_sql(ROUTES['reported'], 'and')})",
             "patient": f"list_concat({context_sql(ROUTES['patient'], 'for')}, {context_sql(ROUTES['customer'], 'with')})",
             "other": phrases_sql(pick_sql(ROUTES["other"]))}
KEPT = ", ".join(f"list_filter(list_transform({v}, lambda q: {issue_sql('q')}), lambda u: len(u) > 0) as {n}" for n, v in CLASS_SQL.items())


@BOOK.add("extract_issues", "T17", f"with x as (select doc_id, {KEPT} from documents) select doc_id, " + ", ".join(
    rf"""array_to_string(list_transform({n}, lambda t: array_to_string(t, ' ')), ',') as {n},
    array_to_string(list_filter(flatten({n}), lambda t: regexp_matches(t, '\p{{Nd}}')), ',') as {n}_score""" for n in CLASS_SQL) + " from x")
def _(s, d):
    return issues.extract_issues(docs(s, d), "text", TWO).drop("text")


LTRIM = "ltrim({}, ' ')"
AFTER_SQL = {"device": context_sql(EXCLUSIVE["device"], "with", "after", LTRIM),
             "patient": context_sql(EXCLUSIVE["patient"], "for", "after", LTRIM),
             "other": phrases_sql(pick_sql(EXCLUSIVE["other"]), LTRIM)}
FIRST_STOP = sql_list([*W.ISSUE_STOPWORDS, "wa", "reported"])
FIRST = ", ".join(f"list_transform({v}, lambda q: {issue_sql('q', FIRST_STOP)}) as {n}" for n, v in AFTER_SQL.items())
FREE = {"device": "true", "patient": "len(device) = 0", "other": "len(device) = 0 and len(patient) = 0"}


@BOOK.add("extract_issues_first", "T18", f"with x as (select doc_id, {FIRST} from documents) select doc_id, " + ", ".join(
    rf"""case when {FREE[n]} then array_to_string(list_transform({n}, lambda t: array_to_string(t, ' ')), '|') else '' end as {n},
    case when {FREE[n]} then array_to_string(list_filter(list_transform({n}, lambda u: array_to_string(list_filter(u,
    lambda t: regexp_matches(t, '\p{{Nd}}')), ' ')), lambda v: v <> ''), '|') else '' end as {n}_score""" for n in AFTER_SQL) + " from x")
def _(s, d):
    out = issues.extract_issues_first(docs(s, d), "text", ONE)
    return out.select("doc_id", *[F.array_join(c, "|").alias(c) for n in issues.CLASSES for c in (n, f"{n}_score")])


PHRASES_CTE = "a as (" + " union all ".join(
    f"select doc_id, '{n}' as class, {v} as raw from documents" for n, v in AFTER_SQL.items()) + f"""),
  r as (select doc_id, class, raw[1] <> '' as counts, unnest(raw) as p, generate_subscripts(raw, 1) as pos from a where len(raw) > 0),
  t as (select doc_id, class, counts, pos, array_to_string({issue_sql('p')}, ' ') as phrase from r),
  c as (select distinct class, phrase from t where counts and len(string_split(phrase, ' ')) in (2, 3) and class in
    (select class from t where counts group by 1 having count(*) >= 3))"""


@BOOK.add("phrase_corpus", "T19", f"with {PHRASES_CTE} select class, phrase from c")
def _(s, d):
    return issues.phrase_corpus(docs(s, d), "doc_id", "text", ONE)


@BOOK.add("extract_issues_phrases", "T20", f"with {PHRASES_CTE}, k as (select t.* from t semi join c using (class, phrase)) select doc_id, "
          + ", ".join(f"coalesce(string_agg(phrase, '|' order by pos) filter (class = '{n}'), '') as {n}" for n in issues.CLASSES)
          + " from (select doc_id from documents) left join k using (doc_id) group by 1")
def _(s, d):
    out = issues.extract_issues_phrases(docs(s, d), "doc_id", "text", keywords=ONE)
    return out.select("doc_id", *[F.array_join(n, "|").alias(n) for n in issues.CLASSES])


@BOOK.add("concat_corpus", "T21", """select role, (rn - 1) // 50 as chunk, string_agg("text", ' ' order by rn) as corpus from (select role,
  "text", row_number() over (partition by role order by conv_id, turn, "text") as rn from conversations) group by 1, 2""")
def _(s, d):
    return text.concat_corpus(table(s, d, "conversations"), "role", ["conv_id", "turn", "text"], "text", rows_per_chunk=50)


@BOOK.add("prefix_phrases", "T22", rf"""with x as (select item_id, list_filter(string_split_regex("text", '[ \t\n\r\f\v]+'), lambda t: t <> '' and
  not list_contains({sql_list(W.PREFIX_SYMBOLS)}, t)) as k from benchmark) select item_id, (i - 1)::int as pos,
  array_to_string(k[1:i], ' ') as phrase from (select item_id, k, unnest(range(1, len(k) + 1)) as i from x)""")
def _(s, d):
    found = W.prefix_phrases(W.tokenize_space("text"))
    return table(s, d, "benchmark").select("item_id", F.posexplode(found).alias("pos", "phrase"))


@BOOK.add("phrase_counts", "T23", rf"""with x as (select list_transform(list_filter(string_split_regex(regexp_replace(lower("text"),
  '[^\p{{L}}\p{{N}}_\s]+', ' | ', 'g'), '[ \t\n\r\f\v]+'), lambda t: t <> ''), lambda t: case when list_contains({STOP}, t) then '|' else t end)
  as k from documents), p as (select trim(unnest(string_split(array_to_string(k, ' '), '|')), ' ') as phrase from x)
  select phrase, count(*) as n from p where phrase <> '' group by 1""")
def _(s, d):
    return text.phrase_counts(docs(s, d), "text", STOPWORDS)


LEXICON = f"""x as (select token, row_number() over (order by count(*) desc, token) as id from {TOKEN_ROWS} group by 1),
  lexicon as (select token, ((id % 5) - 2) / 2.0::double as polarity from x where id % 2 = 0)"""
SCORED = f"""{LEXICON}, m as (select doc_id, avg(polarity) as p from {TOKEN_ROWS} join lexicon using (token) group by 1),
  scored as (select doc_id, p, case when p > 0 then 'positive' when p = 0 then 'neutral' else 'negative' end as sentiment from
    (select doc_id, round(coalesce(p, 0), 9) + 0.0 as p from documents left join m using (doc_id)))"""


def lexicon(s, d):
    """A lexicon by rule: every second token of the frequency order, polarity from its rank."""
    vocab = build_vocab(token_counts(docs(s, d), W.word_tokens("text")))
    return vocab.where("id % 2 = 0").select("token", "n", ((F.col("id") % 5 - 2) / 2.0).alias("polarity"))


@BOOK.add("lexicon_sentiment", "T24", f"with {SCORED} select doc_id, round(p, 6) as polarity, sentiment from scored")
def _(s, d):
    out = text.lexicon_sentiment(docs(s, d), "doc_id", "text", lexicon(s, d))
    return out.select("doc_id", r6("polarity").alias("polarity"), "sentiment")


@BOOK.add("sentiment_report", "T25", f"""with {SCORED} select sentiment, doc_id, rn as "rank", round(percent, 6) as percent from (select
  sentiment, doc_id, row_number() over (partition by sentiment order by doc_id)::int as rn,
  (100.0 * count(*) over (partition by sentiment) / count(*) over ())::double as percent from scored) where rn <= 10""")
def _(s, d):
    scored = text.lexicon_sentiment(docs(s, d), "doc_id", "text", lexicon(s, d))
    out = text.sentiment_report(scored.select("doc_id", "sentiment"), "doc_id", 10)
    return out.select("sentiment", "doc_id", "rank", r6("percent").alias("percent"))


@BOOK.add("apply_text", "U01", """select doc_id, upper(left("text", 1)) || '#' || length("text") as tag from documents""")
def _(s, d):
    return text.apply_text(docs(s, d), "text", lambda t: f"{t[:1].upper()}#{len(t)}", "tag").select("doc_id", "tag")


# ---- lookups over document tokens ------------------------------------------------------------------------------

BENCH = """(select distinct unnest(regexp_extract_all(lower("text"), '[\\p{L}\\p{N}_]+')) as token from benchmark)"""


@BOOK.add("lookup_join", "J03", f"""with v as (select token, row_number() over (order by count(*) desc, token) + 1 as id from {TOKEN_ROWS}
    group by 1 having count(*) >= 5) select t.doc_id, t.pos::int as pos, coalesce(v.id, 1) as id from {TOKEN_ROWS} t left join v using (token)""")
def _(s, d):
    tokens = token_table(s, d)
    vocab = build_vocab(token_counts(docs(s, d), W.word_tokens("text")), min_freq=5, specials=("<pad>", "<unk>"))
    return relate.lookup_join(tokens, vocab, "token", "id", 1).select("doc_id", "pos", "id")


@BOOK.add("keep_members", "J04", f"select doc_id, pos::int as pos, token from {TOKEN_ROWS} semi join {BENCH} using (token)")
def _(s, d):
    members = table(s, d, "benchmark").select(F.explode(W.word_tokens("text")).alias("token"))
    return relate.keep_members(token_table(s, d), members, "token").select("doc_id", "pos", "token")


@BOOK.add("remove_members", "J05", f"select doc_id, pos::int as pos, token from {TOKEN_ROWS} anti join {BENCH} using (token)")
def _(s, d):
    members = table(s, d, "benchmark").select(F.explode(W.word_tokens("text")).alias("token"))
    return relate.remove_members(token_table(s, d), members, "token").select("doc_id", "pos", "token")
