from pyspark.sql import functions as F

from lumenframe.functions import joins
from lumenframe.functions import words as W
from lumenframe.operators import issues, text, textvec


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr.alias("x")).first()["x"]


def test_review_cleaning_and_emoticons(spark):
    raw = "<br/>Café :-) is GREAT! :D"
    assert one(spark, raw, W.clean_review("t", "joined")) == "caféisgreatd:):D"
    assert one(spark, raw, W.clean_review("t")) == "café is great d:)"
    assert one(spark, raw, W.extract_emoticons("t")) == ":):D"


def test_tweet_links_go_first(spark):
    assert one(spark, "@bob see http://x.y/z?q=1 now!", W.clean_tweet("t")) == "see now"


def test_block_comments(spark):
    assert one(spark, "int a; /* x */ int b;", W.strip_block_comments("t")) == "int a;  int b;"
    assert one(spark, "rest */ int b; /* y\n z */ c", W.strip_block_comments("t")) == " int b;  c"
    assert one(spark, "b'x = \"1\";\n\\'", W.strip_code_format("t")) == 'x = "1";'


def test_issue_tokens(spark):
    assert one(spark, "There was a 5mm leak , at the tip (e.g sensor9)", W.tokenize_issue("t")) == "a 5mm leak tip (e.g sensor9)"
    assert one(spark, "a 5mm leak x9y", W.numeric_tokens(W.issue_tokens("t"))) == ["5mm", "x9y"]


def test_routing_chains_are_independent(spark):
    """A sentence with the device keyword but no customer or patient goes to device and to other."""
    r = spark.createDataFrame([("The Device broke. Patient fell. Customer reported it",)], "t string")
    got = r.select(*[v.alias(k) for k, v in issues.route_sentences("t").items()]).first()
    assert got["device"] == ["the device broke"] and got["patient"] == [" patient fell"] and got["customer"] == [" customer reported it"]
    assert got["reported"] == [" customer reported it"] and got["other"] == ["the device broke"]
    ex = r.select(*[v.alias(k) for k, v in issues.route_exclusive("t").items()]).first()
    assert ex["device"] == ["the device broke"] and ex["other"] == [" customer reported it"]


def test_keyword_context_and_extraction(spark):
    df = spark.createDataFrame([(1, "Broken tip, device leaked 5ml, badly. Patient felt pain9 , nausea. Nothing else")], "id int, t string")
    routes = issues.route_sentences("t")
    assert df.select(issues.keyword_context(routes["device"], "device").alias("x")).first()["x"] == ["leaked 5ml", "badly", "broken tip", ""]
    r = issues.extract_issues(df, "t").first()
    assert r["device"] == "leaked 5ml,badly,broken tip" and r["device_score"] == "5ml"
    assert r["patient"] == "felt pain9,nausea" and r["patient_score"] == "pain9"
    assert r["other"] == "broken tip,device leaked 5ml,badly,nothing else"
    f = issues.extract_issues_first(df, "t").first()
    assert f["device"] == ["leaked 5ml", "badly"] and f["device_score"] == ["5ml"] and f["patient"] == [] and f["other"] == []


def test_phrase_corpus_needs_three_phrases_and_first_not_empty(spark):
    df = spark.createDataFrame([(1, "device red light, blue light"), (2, "device broken cable end"), (3, "patient sharp pain"), (4, "device, red light")],
                               "id int, t string")
    assert sorted(tuple(r) for r in issues.phrase_corpus(df, "id", "t").collect()) == [
        ("device", "blue light"), ("device", "broken cable end"), ("device", "red light")]
    got = {r["id"]: (r["device"], r["patient"]) for r in issues.extract_issues_phrases(df, "id", "t").collect()}
    assert got == {1: (["red light", "blue light"], []), 2: (["broken cable end"], []), 3: ([], []), 4: (["red light"], [])}


FOUR = ["The sun is shining", "The weather is sweet", "The sun is shining, the weather is sweet", "and one and one is two"]


def test_four_sentences(spark):
    df = spark.createDataFrame(list(enumerate(FOUR)), "id int, t string")
    bag = textvec.bag_of_words(df, "id", "t")
    terms = {r["token"]: r["term_id"] for r in bag.select("token", "term_id").distinct().collect()}
    assert terms == {"and": 0, "is": 1, "one": 2, "shining": 3, "sun": 4, "sweet": 5, "the": 6, "two": 7, "weather": 8}
    weights = {(r["id"], r["token"]): r["weight"] for r in textvec.tfidf(df, "id", W.word_tokens("t", W.WORD2)).collect()}
    # idf 1.510826 (sun, shining), 1 (is), 1.223144 (the); length 2.657312
    assert abs(weights[(0, "shining")] - 1.510826 / 2.657312) < 1e-5 and abs(sum(v * v for (i, _), v in weights.items() if i == 3) - 1) < 1e-9
    plain = textvec.tfidf(df, "id", W.word_tokens("t", W.WORD2), use_idf=False, norm=False)
    assert {r["weight"] for r in plain.where("token = 'one'").collect()} == {2.0}


def test_vocabulary_sequences_and_padding(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, "a"), (3, "")], "id int, t string")
    vocab = textvec.build_vocab(textvec.token_counts(df, W.word_tokens("t")), 1, ("<pad>", "<unk>"))
    assert {r["token"]: r["id"] for r in vocab.collect()} == {"<pad>": 0, "<unk>": 1, "a": 2, "b": 3}
    seqs = textvec.encode_sequences(df, "id", W.word_tokens("t"), vocab.where("token <> 'b'"))
    assert {r["id"]: r["ids"] for r in seqs.collect()} == {1: [1, 2, 1], 2: [2], 3: []}
    padded = textvec.pad_batches(seqs, ["id"], "ids", 2, pad=0)
    assert {r["id"]: (r["batch"], r["length"], r["ids"]) for r in padded.collect()} == {1: (0, 3, [1, 2, 1]), 2: (0, 1, [2, 0, 0]), 3: (1, 0, [])}


def test_concat_corpus_keeps_everything_in_chunks(spark):
    df = spark.range(25).select(F.lit("g").alias("g"), "id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    got = text.concat_corpus(df, "g", ["id"], "t", rows_per_chunk=10).orderBy("chunk").collect()
    assert len(got) == 3 and " ".join(r["corpus"] for r in got) == " ".join(f"t{i}" for i in range(25))


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "good good bad"), (2, "bad"), (3, "unknown")], "id int, t string")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "token string, polarity double")
    got = text.lexicon_sentiment(df, "id", "t", lex)
    assert {r["id"]: r["sentiment"] for r in got.collect()} == {1: "positive", 2: "negative", 3: "neutral"}
    report = text.sentiment_report(got.select("id", "sentiment"), "id", 5).collect()
    assert len(report) == 3 and all(abs(r["percent"] - 100 / 3) < 1e-9 for r in report)


def test_phrases_prefixes_and_user_function(spark):
    assert one(spark, "The red light, and the cable", W.phrase_runs("t", ["the", "and"])) == ["red light", "cable"]
    assert one(spark, "a , b", W.prefix_phrases(W.tokenize_space("t"))) == ["a", "a b"]
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    assert [r["u"] for r in text.apply_text(df, "t", str.upper, "u").collect()] == ["AB", None]
    assert one(spark, "Hello, World 42!", F.array_join(W.process_text("t", ["hello"]), " ")) == "hello world"
    assert one(spark, "héé", W.ascii_only("t")) == "h"


def test_word2vec_vectors(spark):
    df = spark.createDataFrame([("a b c a b c",)] * 20, "t string")
    model = textvec.word2vec(df, W.word_tokens("t"), size=4, min_count=1)
    assert {r["word"] for r in model.getVectors().collect()} == {"a", "b", "c"} and model.findSynonyms("a", 2).count() == 2


def test_terms_are_counted_inside_rows_and_added_up_for_repeated_keys(spark):
    rows = [(1, "b a b"), (2, None), (3, ""), (4, "a c a a")]
    once = textvec.term_counts(spark.createDataFrame(rows, "i long, t string"), "i", W.word_tokens("t"), first=True)
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1, 1), (1, "b", 2, 0), (4, "a", 3, 0), (4, "c", 1, 1)]
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    twice = textvec.term_counts(spark.createDataFrame([*rows, (1, "c b"), (None, "a")], "i long, t string"), "i", W.word_tokens("t"), first=True)
    got = sorted(map(tuple, twice.collect()), key=str)
    assert got == sorted([(1, "a", 1, 1), (1, "b", 3, 0), (1, "c", 1, 0), (4, "a", 3, 0), (4, "c", 1, 1), (None, "a", 1, 0)], key=str)


def test_counted_join_keeps_every_row_with_few_or_many_frequent_keys(spark):
    big = spark.createDataFrame([("a", i) for i in range(9)] + [("b", i) for i in range(4)] + [("c", 0), ("d", 0), (None, 1)], "k string, i int")
    small = spark.createDataFrame([("a", 9, 1.0), ("b", 4, 2.0), ("c", 1, 3.0), ("e", None, 4.0)], "k string, n long, v double")
    want = sorted((k, i, {"a": 1.0, "b": 2.0, "c": 3.0}.get(k)) for k, i in ((r["k"], r["i"]) for r in big.collect()) if k) + [(None, 1, None)]
    for most in (1, 2, 3, 50):
        for how in ("left", "inner"):
            got = joins.counted_join(big, small, "k", how, most=most).select("k", "i", "v").collect()
            assert sorted(map(tuple, got), key=str) == sorted((w for w in want if how == "left" or w[2] is not None), key=str)
    plan = joins.counted_join(big, small, "k", "inner", most=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (" in plan and "strategy=broadcast" in plan
