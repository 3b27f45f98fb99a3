"""Numbered queries against their SQL, and the pipeline stage by stage."""
from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenframe.llm import mixing, queries
from lumenframe.llm.common import landed
from lumenframe.llm.queries import BOOK
from tests.llm.test_llm import components, prints
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return c


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in BOOK.entries) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n, q in BOOK.entries.items() if q.sql])
def test_query_matches_sql(spark, con, name):
    status, _, note = compare(spark, con, BOOK.entries[name], FOLDER)
    assert status == "ok", note


def test_stages_in_order_and_their_decisions(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mix_sources", "bpe"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(9001, None, None, None, 0), (9002, "12 34", "en", "src1", 5), (9003, docs.first().text, "en", "src1", 1), (9003, docs.first().text, "en", "src1", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("_fp", F.lit(1)).withColumn("extra", F.lit("x"))
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    ids = {r.doc_id for r in kept.collect()}
    assert {9001, 9002}.isdisjoint(ids) and len(ids) == docs.select("doc_id").distinct().count() - 2     # clean documents stay
    assert kept.columns == corpus_pipeline.COLUMNS
    unique = corpus_pipeline.exact_dedup(spark, kept, FOLDER)
    texts = {}
    for r in kept.collect():
        key = " ".join(r.text.replace("\x0b", " ").split()) if r.text.strip() == r.text else r.text
        texts[key] = min(texts.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(texts.values())
    near = corpus_pipeline.near_dedup(spark, unique, FOLDER)
    rows = {r.doc_id: r.text for r in unique.collect()}
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(components(prints(rows.items())).values()))
    mixed = corpus_pipeline.mixing_stage(spark, near, FOLDER)
    want = mixing.replicate(near, mixing.source_rates(near)).count()
    assert mixed.count() == want and mixed.columns == corpus_pipeline.COLUMNS
    last = corpus_pipeline.encoding(spark, mixed, FOLDER)
    assert last.count() == want and last.where("size(token_ids) <> n_tokens").count() == 0


def test_language_stage_rejects_other_languages_and_hex_dumps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    foreign = ["La casa era silenziosa quando il ragazzo tornò dalla scuola e trovò sua madre che preparava la cena con le verdure del giardino.",
               "Talo oli hiljainen kun poika palasi koulusta ja löysi äitinsä valmistamassa illallista puutarhan vihanneksista.",
               "Dom był cichy, kiedy chłopiec wrócił ze szkoły i zobaczył matkę przygotowującą kolację z warzyw z ogrodu.",
               "Ngôi nhà yên tĩnh khi cậu bé trở về từ trường và thấy mẹ đang nấu bữa tối với rau trong vườn.",
               "4f6e2063 e3a1 9bd4 0fce 77aa b00b deadbeef cafe 1f8b 0800 ffd8 ffe0 d0cf 11e0 " * 5]
    clean = [r.text[:80] for r in docs.where("text is not null").orderBy("doc_id").limit(20).collect()]
    more = [(6002 + 10_000 * k, t, None, "src1", len(t)) for k, t in enumerate(foreign + clean)]
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(more, docs.schema)), FOLDER).collect()}
    assert kept.isdisjoint(m[0] for m in more[:len(foreign)]) and kept >= {m[0] for m in more[len(foreign):]}
    assert kept >= {r.doc_id for r in docs.where("length(text) > 0").collect()}


def test_mix_query_shuffles_whole_documents(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "landed", lambda df, label: written.append(landed(df, label)) or written[-1])
    got = BOOK.entries["op6_mix"].run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert set(docs.columns) <= set(written[0].columns)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    copies = [(r.doc_id, r.copy, r.text) for r in written[0].collect()]
    assert {(i, t) for i, _, t in copies} <= texts
    assert sorted((i, c) for i, c, _ in copies) == sorted((r.doc_id, r.copy) for r in got.collect())


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
