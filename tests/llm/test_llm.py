"""The training-data operators on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lumenframe.llm import bpe, exact, langid, mixing, private, quality, search, simhash, suffix, warc
from lumenframe.llm.common import is_held_out
from lumenframe.llm.queries import BOOK, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **more):
    rows = [(i, t, None, f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).withColumns({k: F.lit(v) for k, v in more.items()})


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


# ---- 1 suffix arrays ---------------------------------------------------------------------------------------------


def removed(docs: list[tuple[int | None, bytes]], window: int = 50):
    rank = lambda i: math.inf if i is None else i
    first: dict[bytes, float] = {}
    for i, t in docs:
        for k in range(len(t) - window + 1):
            first[t[k:k + window]] = min(first.get(t[k:k + window], math.inf), rank(i))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - window + 1):
            if first[t[k:k + window]] < rank(i):
                gone[k:k + window] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [1, 2, 26])
def test_repeated_windows_equal_a_dictionary(letters):
    rng = random.Random(letters)
    for _ in range(40):
        a = bytearray(rng.choice(b"abcdefghijklmnopqrstuvwxyz"[:letters]) for _ in range(rng.randint(0, 900)))
        for _ in range(rng.randint(0, 4)):
            if len(a) > 300:
                x, y, n = rng.randrange(len(a) - 150), rng.randrange(len(a) - 150), rng.randint(40, 150)
                a[y:y + n] = a[x:x + n]
        valid = np.array([i + 50 <= len(a) and rng.random() < 0.9 for i in range(len(a))], bool)
        seen = defaultdict(list)
        for k in np.flatnonzero(valid):
            seen[bytes(a[k:k + 50])].append(int(k))
        place, first = suffix.repeated_windows(np.frombuffer(bytes(a), np.uint8), valid)
        assert dict(zip(place.tolist(), first.tolist(), strict=True)) == {k: v[0] for v in seen.values() if len(v) > 1 for k in v}


def test_large_buffers_take_the_wide_keys():
    a = np.tile(np.frombuffer(random.Random(0).randbytes(700_000), np.uint8), 4)
    place, first = suffix.repeated_windows(a, np.arange(len(a)) + 50 <= len(a))
    assert len(place) == len(a) - 49 and (first == place % 700_000).all()


def test_suffix_dedup_equals_brute_force_in_small_shards(spark):
    rng = random.Random(5)
    phrase = "".join(rng.choice("abcdefgh é") for _ in range(130))
    base = ["".join(rng.choice("abcdefghijk lmnopß") for _ in range(rng.randint(0, 400))) for _ in range(40)]
    texts = [(i, t[:100] + phrase + t[100:] if i % 3 else t) for i, t in enumerate(base)]
    texts += [(100 + i, base[i % 4]) for i in range(20)] + [(200, None), (201, ""), (None, base[0]), (5, base[7]), (300, "ab" * 4000), (301, "ab" * 3000), (2, texts[2][1])]
    docs = docs_of(spark, texts, h=1, id=2, r="x").repartition(5)
    want = removed([(i, (t or "").encode()) for i, t in texts])
    for shard in (400, 3000, suffix.SHARD):
        got = [tuple(r) for r in suffix.suffix_dedup(docs, shard=shard, range_bytes=300).collect()]
        assert sorted(got, key=str) == want
    kept = {r.doc_id: r.kept for r in suffix.suffix_dedup(docs.where("doc_id = 301 or doc_id = 300"), keep_text=True).collect()}
    assert kept[301] == b"" and len(kept[300]) == 8000


# ---- 2 SimHash ---------------------------------------------------------------------------------------------------


def prints(texts, width=3):
    out = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[k:k + width]) for k in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        out[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    return out


def components(fps: dict, radius=2):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_masks_cover_every_pair_in_the_radius():
    rng = random.Random(1)
    for radius in (1, 2, 3):
        masks = simhash.cover(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flip = sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
            assert any(flip & m == 0 for m in masks)
    for kept in simhash.cover(2):
        free = [b for b in range(64) if not kept >> b & 1]
        for x in free:
            for y in free:
                assert any((1 << x | 1 << y) & m == 0 for m in simhash.cover(2, kept))


def test_links_connect_as_all_pairs_do_with_small_buckets(spark):
    rng = random.Random(3)
    seed = rng.getrandbits(64)
    fps = {seed} | {seed ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(150)}
    fps |= {f ^ 1 << rng.randrange(64) for f in list(fps)} | {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    rows = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    want = components({simhash.signed(f): f for f in fps})
    for bucket in (8, 512):
        links = simhash.near_links(rows, bucket=bucket).collect()
        assert links and all(want[r.src] == want[r.dst] and r.src != r.dst for r in links)
        parent = {f: f for f in want}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for r in links:
            a, b = find(r.src), find(r.dst)
            parent[max(a, b)] = min(a, b)
        assert {f: find(f) for f in parent} == want


def test_simhash_groups_equal_brute_force(spark):
    rng = random.Random(9)
    words = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "eta", "Ünder"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(300)) for _ in range(6)]
    texts = [(i, base[i % 6].replace(" ", "\n", i % 3) + (" x" if i % 4 == 0 else "")) for i in range(40)]
    texts += [(50, None), (51, ""), (52, " \t "), (53, "one"), (54, "ONE"), (55, "one two"), (56, "w " * 70_000)]
    fps = prints(texts)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.simhash_groups(docs_of(spark, texts, fp=1, _fp=2)).collect()}
    parts = components(fps)
    assert got == {i: (fps[i], parts[i]) for i in fps}
    kept = simhash.keep_one(docs_of(spark, [*texts, (0, texts[0][1])]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(parts.values()))
    assert simhash.simhash_groups(docs_of(spark, [])).count() == 0


# ---- 3 nearest neighbours ----------------------------------------------------------------------------------------


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 7)), 3).astype(np.float32)
    x[10] = x[20] = x[30] = x[0]
    x[40] *= 1e6
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(300)]
    rows[50] = (50, None)
    rows[60] = (60, [0.0] * 7)
    rows[70] = (70, [float("nan")] * 7)
    rows[80] = (80, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0])
    rows[90] = (90, [float("inf")] * 7)
    rows += [rows[0], (None, rows[1][1]), (400, [1.0, 2.0]), (401, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).repartition(6)
    use = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None
           and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    want = []
    for q in (i for i in use if i % 20 == 0):
        near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(use[q], use[c], strict=True)))), c) for c in use if c != q and len(use[c]) == len(use[q]))
        want += [(q, r + 1, c, d) for r, (d, c) in enumerate(near[:10])]
    got = [tuple(r) for r in search.nearest_of(df, F.col("vec_id") % 20 == 0, block=32).collect()]
    assert sorted(r[:3] for r in got) == sorted(r[:3] for r in want)
    assert np.allclose([r[3] for r in sorted(got)], [r[3] for r in sorted(want)], rtol=1e-12, atol=0)
    assert search.nearest_of(df.limit(0), F.lit(True)).count() == 0


def plain_distance(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        d = float(x) - float(y)
        total += d * d if abs(d) < 1e300 else math.inf
    return math.sqrt(total)


def nearest_by_hand(ids, x, queries, k):
    out = {}
    for q in queries:
        near = sorted((plain_distance(x[q], x[c]), int(ids[c])) for c in range(len(ids)) if c != q)
        out[int(ids[q])] = [(d, i) for d, i in near[:k]]
    return out


@pytest.mark.parametrize("powers", [(160,), (-160,), (200, 0), (-310, -300), (308, 160, 0, -160, -300), (0, 3, 6), (154, 153)])
def test_search_of_vectors_of_any_size(powers):
    rng = np.random.default_rng(abs(sum(powers)))
    for _ in range(6):
        x = rng.normal(size=(150, 5)).clip(-1.7, 1.7) * 10.0 ** rng.choice(powers, size=(150, 1))
        x[7] = x[8] = x[9]
        x = x[(x != 0).any(axis=1)]
        ids = rng.permutation(len(x)) + 1
        q = np.arange(0, len(x), 4)
        for k in (3, 60):
            got = search.search_cell(ids[q], x[q], [(ids[i:i + 40], x[i:i + 40]) for i in range(0, len(x), 40)], k)
            want = nearest_by_hand(ids, x, q, k)
            assert {int(i): found for i, found in zip(ids[q], got, strict=True)} == want


def test_search_prunes_beside_one_huge_vector():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16))
    x[5] *= 1e200
    parts = {step: at for step, at in search._by_size(x)}
    assert len(parts) == 2
    rest = x[parts[0]]
    small = search._quantised(rest, search.SPAN)
    ids = np.arange(len(rest))
    qi, _ = search._survivors(ids, small, ids, small, search.SPAN, np.full(len(rest), np.inf), 10)
    assert len(qi) < 40 * len(rest)


def test_search_returns_huge_vectors_and_cuts_wide_blocks(spark, monkeypatch):
    x = [[float(i % 5), 1.0, float(i)] for i in range(1, 16)]
    rows = [(i, v) for i, v in enumerate(x, 1)] + [(20, [1e160, 1.0, 1.0]), (40, [2e160, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = search.nearest_of(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(q, i, i, math.inf) for q in (20, 40) for i in range(1, 11)]
    monkeypatch.setattr(search, "BLOCK_BYTES", 5 * 3 * 8)
    sizes = [len(r.ids) // 8 for r in search.packed(df.coalesce(1), 1000).collect()]
    assert max(sizes) == 5 and sum(sizes) == 17


# ---- 4 language ID -----------------------------------------------------------------------------------------------


def grams_by_hand(text):
    out = Counter()
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        p = f" {w} "
        out.update(w)
        out.update(p[i:i + 2] for i in range(len(p) - 1))
        out.update(p[i:i + 3] for i in range(len(p) - 2))
    return out


def test_gram_counts_are_those_of_the_words():
    text = "Ein Haus, zwei Häuser! 3x ab\tÀ"
    _, n = langid.gram_counts(text)
    want = grams_by_hand(text)
    assert sorted(n) == sorted(want.values())
    small, langid.CHUNK = langid.CHUNK, 7
    try:
        cut = langid.gram_counts(text)
    finally:
        langid.CHUNK = small
    assert (cut[1].sum(), len(cut[0])) == (sum(want.values()), len(want))


def test_language_defined_results_and_held_out_accuracy(spark):
    rows = [(1, "the house and the garden"), (2, "das haus und der garten"), (3, None), (4, ""), (5, "123 !"), (6, "x" * 300_000)]
    docs = docs_of(spark, rows).withColumn("lang", F.when(F.col("doc_id") == 1, "en").when(F.col("doc_id") == 2, "de"))
    profiles = langid.train_profiles(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs.withColumn("score", F.lit(9)), profiles).collect()}
    assert got[1][0] == "en" and got[2][0] == "de"
    assert all(got[i] == ("und", 0.0) for i in (3, 4, 5)) and got[6][0] in ("en", "de")
    assert langid.predict(docs.limit(0), langid.train_profiles(docs.limit(0))).count() == 0
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = BOOK.entries["op4_language"].run(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def ranked_by_hand(text, size):
    code = lambda g: sum(0 if c == " " else ord(c) << 20 * k for k, c in enumerate(reversed(g))) | len(g) << 60
    counts = Counter({code(g): n for g, n in grams_by_hand(text).items()})
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def test_profiles_and_distances_equal_brute_force(spark):
    rng, size = random.Random(8), 30
    letters = {"aa": "abcde", "bb": "defgh", "cc": "äöabz"}
    make = lambda of: " ".join("".join(rng.choice(of) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 12)))
    known = [(i, make(letters[lang]), lang) for i, lang in enumerate(sorted(letters) * 15)]
    asked = [(100 + i, make(rng.choice([*letters.values(), "abcdefghzqä"]))) for i in range(60)] + [(200, "Q9 q"), (201, "12"), (202, None)]
    profiles = langid.train_profiles(spark.createDataFrame(known + [(90, None, "aa"), (91, "x", None)], "doc_id long, text string, lang string"), size=size)
    want = {lang: ranked_by_hand(" ".join(t for _, t, x in known if x == lang), size) for lang in letters}
    got = defaultdict(dict)
    for r in profiles.collect():
        got[r.lang][r["rank"]] = r.gram
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == want
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs_of(spark, asked), profiles, size=size).collect()}
    anywhere = {g for grams in want.values() for g in grams}

    def moved(lang, k, g):
        return abs(k - want[lang].index(g)) if g in want[lang] else size - k if g in anywhere else size

    for i, t in asked:
        own = ranked_by_hand(t, size)
        far = [(sum(moved(x, k, g) for k, g in enumerate(own)), x) for x in sorted(letters)]
        if own:
            assert found[i][0] == min(far)[1] and math.isclose(found[i][1], 1 - min(far)[0] / (size * len(own)), abs_tol=1e-12), t
        else:
            assert found[i] == ("und", 0.0)


# ---- 5 quality ---------------------------------------------------------------------------------------------------


def test_quality_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in BOOK.entries["op5_quality"].run(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(is_held_out()).collect()
    good = np.array([got[r.doc_id].log_weight for r in labels if r.quality == 1])
    bad = np.array([got[r.doc_id].log_weight for r in labels if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert np.mean([got[r.doc_id].kept for r in labels if r.quality == 1]) > 0.95


def test_quality_keeps_the_k_largest_keys_and_handles_odd_rows(spark):
    rows = [(i, "fine words in order " * 5 if i % 2 else "## !! $$ " * 5) for i in range(20)] + [(30, None), (31, ""), (3, "fine words in order " * 5)]
    docs = docs_of(spark, rows, log_weight="x")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (13, None)], "doc_id long, quality int")
    got = quality.resample(docs, labels, share=0.5).collect()
    assert len(got) == 23 and sum(r.kept for r in got) == round(0.5 * 23)
    assert min(r.gumbel_key for r in got if r.kept) >= max(r.gumbel_key for r in got if not r.kept)
    assert all(r.kept for r in quality.resample(docs, labels.limit(0)).collect())
    assert quality.resample(docs.limit(0), labels).count() == 0


def test_weights_and_gumbel_keys_equal_brute_force(spark):
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choice(["good", "fine", "bad", "junk!", "so", "Ü"]) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    labels = [(i, rng.randint(0, 1)) for i in range(0, 80, 2)]

    def buckets(text):
        h = [zlib.crc32(w.encode()) for w in re.findall(r"\w+|[^\w\s]+", text.lower())]
        mix = [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2 ** 64 >> 20) % quality.BUCKETS for a, b in zip(h, h[1:], strict=False)]
        return Counter([x % quality.BUCKETS for x in h] + mix)

    known = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    good = {i for i, y in known if y == 1}
    raw, target = Counter(), Counter()
    for i, t in texts:
        raw.update(buckets(t))
        target.update(buckets(t) if i in good else {})
    total = lambda c: sum(c.values()) + quality.BUCKETS
    ratio = lambda b: math.log((target[b] + 1) / total(target)) - math.log((raw[b] + 1) / total(raw))
    want = {}
    for i, t in texts:
        weight = sum(n * ratio(b) for b, n in buckets(t).items())
        u = (int(hashlib.md5(f"{quality.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        want[i] = (weight, weight - math.log(-math.log(u)))
    k = round(len(good) / len(known) * len(texts))
    kept = set(sorted(want, key=lambda i: (-want[i][1], i))[:k])
    got = quality.resample(docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(texts) and {r.doc_id for r in got if r.kept} == kept
    assert all(np.allclose((r.log_weight, r.gumbel_key), want[r.doc_id], rtol=1e-9, atol=1e-9) for r in got)


def test_quality_grams_cross_pieces():
    text = "a b c d e f g"
    whole = np.concatenate(list(quality.grams(text)))
    small, quality.CHUNK = quality.CHUNK, 3
    try:
        cut = np.concatenate(list(quality.grams(text)))
    finally:
        quality.CHUNK = small
    assert sorted(whole) == sorted(cut) and len(whole) == 13


# ---- 6 mixing ----------------------------------------------------------------------------------------------------


def test_mixing_reaches_the_weights_and_shuffles(spark):
    rows = [(i, "x" * 10, None, "big" if i % 4 else "small", 10) for i in range(8000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("rate", F.lit("clash"))
    got = mixing.mix(docs, weights={"big": 1.0, "small": 1.0}).collect()
    share = Counter(r.source for r in got)
    assert abs(share["big"] - share["small"]) < 400 and abs(len(got) - 8000) < 400
    keys = [r.order_key for r in got]
    assert keys == sorted(keys) and abs(np.corrcoef(range(len(got)), [r.doc_id for r in got])[0, 1]) < 0.05
    n = np.array([Counter(r.doc_id for r in got if r.source == "small").get(i, 0) for i in range(0, 8000, 4)])
    assert abs(n.mean() - 2) < 0.15 and abs(n.var() - 2) < 0.3                # mean and variance of the same Poisson law


def test_mixing_odd_rows(spark):
    rows = [(1, "abc", None, None, 3), (2, None, None, "empty", 0), (3, "", None, "empty", 0), (None, "abc", None, None, 3), (1, "abc", None, None, 3), (4, "z" * 200_000, None, "long", 5)]
    docs = spark.createDataFrame(rows, DOCS)
    rates = {r.source: r.rate for r in mixing.source_rates(docs, alpha=1.0).collect()}
    assert rates["empty"] == 0 and abs(rates[None] - 1) < 1e-12
    got = mixing.mix(docs, alpha=1.0).collect()
    assert all(r.source != "empty" for r in got)
    assert Counter(r.copy for r in got if r.doc_id == 1).most_common(1)[0][1] in (0, 2) or not [r for r in got if r.doc_id == 1]
    assert mixing.mix(docs.limit(0)).count() == 0
    table = spark.range(1).select(mixing.poisson_table(F.lit(900.0)).alias("p")).first().p       # exp(-900) underflows, the table does not
    assert abs(table[-1] - 1) < 1e-9 and abs(np.searchsorted(table, 0.5) - 900) < 2


# ---- 7 BPE -------------------------------------------------------------------------------------------------------


def test_tree_encoding_equals_the_library():
    tok = bpe.tokenizer_of(bpe.read_vocabulary(tokenizer_path()))
    special = bpe.special_strings(tok)
    rng = random.Random(7)
    kinds = ["ab", "abcdefghij", "!'s're.-tle", "é́e한ññ漢字🙂👍🏽", "0123456789", ["a", "<|endoftext|>", "<|start", " ", "!!"], ["'s", "'ll", "'", " ", "word"], "therinationg "]
    for n in range(240):
        text = "".join(rng.choice(kinds[n % len(kinds)]) for _ in range(rng.randint(200, 1500)))
        assert bpe.encode_tree(tok, text, rng.choice([40, 100, 300]), special) == tok.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_documents(spark):
    tok = bpe.tokenizer_of(bpe.read_vocabulary(tokenizer_path()))
    texts = [(1, None), (2, ""), (3, "Hello  World's"), (4, "a" * 5000), (5, "some words and 12 numbers " * 400), (3, "Hello  World's"), (None, "<|endoftext|>x")]
    docs = docs_of(spark, texts, uid=1, lo=2)
    want = ("token_ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")
    got = bpe.encode_documents(docs, tokenizer_path(), want=want, leaf=700)
    rows = got.collect()
    assert len(rows) == len(texts)
    expected = []
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        expected.append((i, ids, len(ids), sha(" ".join(map(str, ids)).encode()), text, sha(text.encode())))
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, expected))
    again = bpe.decode_documents(got.select("doc_id", "token_ids", "decoded").withColumnRenamed("decoded", "was"), tokenizer_path())
    assert again.where("decoded <> was").count() == 0
    assert bpe.encode_documents(docs.limit(0), tokenizer_path()).count() == 0


# ---- 8 WARC ------------------------------------------------------------------------------------------------------


def test_url_keys():
    assert warc.url_key("http://WWW.Example.com:80/a?b=1") == "com,example,www)/a?b=1"
    assert warc.url_key("https://a.b:8443") == "b,a:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("no host") == "no host"


def test_warc_round_trip_and_lookups(spark):
    long = "<p>" + "ü" * 300_000
    rows = [(3, "http://a.com/x", "y" * 100), (1, "http://a.com/x", "y" * 100), (2, "http://b.org/ q\n", "y" * 100), (4, None, None), (5, "", ""), (6, "http://a.com/x", "short"),
            (7, "http://c.net/%41", "short"), (8, "http://d.de/é", long), (9, "http://d.de/é", long), (1, "http://a.com/x", "y" * 100), (None, "http://e.fr", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("x")).repartition(3)
    captures, index, folder = warc.archive(pages)
    got = warc.read_records(warc.find_captures(index, warc.url_keys(pages)), folder, payload=True).collect()
    assert len(got) == len(rows)
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {
        (1, "response", None), (3, "revisit", 1), (2, "revisit", 1), (None, "revisit", 1), (4, "response", None), (5, "response", None),
        (6, "response", None), (7, "response", None), (8, "response", None), (9, "revisit", 8)}
    html = {i: (h or "").encode() for i, _, h in rows}
    assert all(r.payload_digest == sha(html[r.page_id]) and r.payload_bytes == len(html[r.page_id]) and r.payload in (None, html[r.page_id]) for r in got)
    keys = spark.createDataFrame([(warc.url_key("http://a.com/x"),), ("zz)/nothing",)], "key string")
    assert sorted(r.page_id for r in warc.find_captures(index, keys).collect()) == [1, 1, 3, 6]
    _, small, _ = warc.archive(pages.limit(0))
    assert warc.find_captures(small, keys).count() == 0


def test_index_blocks_with_one_hot_url(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "http://hot.com/").otherwise(F.concat(F.lit("http://h/"), F.col("id"))).alias("url"),
                                     F.lit("z").alias("html"))
    captures, index, folder = warc.archive(pages)
    blocks = warc.write_index(captures, f"{index.folder}-small", block_lines=16)
    assert blocks.directory.count() >= 3000 // 16
    found = warc.find_captures(blocks, spark.createDataFrame([(warc.url_key("http://hot.com/"),)], "key string"))
    assert sorted(r.page_id for r in found.collect()) == list(range(0, 3000, 3))


# ---- 9 personal data ---------------------------------------------------------------------------------------------

CONTRACT = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(v if k % 2 == 0 else sum(divmod(2 * v, 10)) for k, v in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    def ok(kind, hit):
        d = re.sub("[^0-9]", "", hit)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in hit.split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(k, m[0])] for k, p in CONTRACT.items()}


def test_base_spans_equal_the_contract_on_random_text(spark):
    rng = random.Random(2)
    bits = ["a", "b.", "@", ".c", "-", "_", " ", "1", "25", "256", "+1", "(", ")", "4111111111111111", "4111 1111-1111 1111", "ü", "🙂", "\n", "x@y.z", "1.2.3.4", "00012", "+49 (0)30-1234567"]
    texts = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    texts += [(900, None), (901, ""), (902, "1 " * 60_000), (903, "a." * 40_000 + "a@b" + ".c" * 40_000), (904, "+1" + "(" * 50_000), (905, "9" * 100_000), (906, "1.2." * 20_000)]
    got = {r.doc_id: r for r in private.summary(private.find_private(docs_of(spark, texts, spans=1, uid=2, kind="x"))).collect()}
    for i, t in texts:
        want = base_spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for k in CONTRACT for a, b in want[k])
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(len(want[k]) for k in CONTRACT), t
        assert got[i].base_sha256 == sha(base.encode())
        assert ",".join(s for s in got[i].spans.split(",") if s and not s.startswith("term:")) == base
    assert private.find_private(docs_of(spark, [])).count() == 0


def test_terms_that_disclose_are_marked_and_clean_documents_left_alone(spark):
    texts = [(i, f"the agent Zyxomir met us at {'bob@x.org'} in room 77qq for tea{'!' * i}") for i in range(3)]
    texts += [(10 + i, f"the weather in room {i} was fine for tea") for i in range(60)] + [(90, "write to eve@y.org for tea")]
    found = private.find_private(docs_of(spark, texts))
    by_id = {r.doc_id: [t for s in r.spans if s.kind == 4 for t in [dict(texts)[r.doc_id][s.start:s.end]]] for r in found.collect()}
    assert all(set(by_id[i]) == {"Zyxomir", "agent", "met", "us", "at", "77qq"} for i in range(3))
    assert all(not v for k, v in by_id.items() if k >= 10)
    clean = {r.uid: r.clean_text for r in private.sanitised(found).collect()}
    assert len(clean) == 4
    assert sum("[EMAIL] in room ## for tea" in t and "Zyxomir" not in t for t in clean.values()) == 3
    assert "write to [EMAIL] for tea" in clean.values()


def terms_by_hand(texts, least_gain):
    """Free spans of disclosing terms per document, from sets of words and entities of whole documents."""
    rows = []
    for i, t in texts:
        base, words = base_spans(t), [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", t)]
        norm = {"email": str.lower, "ip": str.lower}
        names = {(k, norm.get(k, lambda x: re.sub("[^0-9]", "", x))(t[a:b])) for k in CONTRACT for a, b in base[k]}
        rows.append((i, [x for k in CONTRACT for x in base[k]], words, names))
    n_term = Counter(w for r in rows for w in {x[2] for x in r[2]})
    n_name = Counter(e for r in rows for e in r[3])
    n_both = Counter((e, w) for r in rows for e in r[3] for w in {x[2] for x in r[2]})
    plain = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in texts}
    seen = defaultdict(set)
    for i, _, words, names in rows:
        for e in names:
            for w in words:
                seen[e, w[2]].add(plain[i])
    found = defaultdict(set)
    for (e, w), n in n_both.items():
        info, left = math.log2(len(rows) / n_name[e]), math.log2(n_term[w] / n)
        if len(seen[e, w]) >= 2 and left <= 1 and info - left >= least_gain(info) - 1e-12:
            found[e].add(w)
    return {i: [(a, b) for a, b, w in words if any(w in found[e] for e in names) and all(b <= x or a >= y for x, y in spans)] for i, spans, words, names in rows}


def marked_terms(found):
    return {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 4] for r in found.collect()}


def test_terms_around_a_card_with_digits_and_other_entities(spark):
    card = "4111 1111 1111 1111"
    texts = [(i, f"Zyxomir Quell, flat 7, pays with {card}, ref9x Morlan {i}, e{i}@a.org on 2020-01-02 or bo@b.org, Tarn") for i in range(3)]
    texts += [(10 + i, f"flat {i} pays with ref by phone on 2020-01-0{i % 9} of house {i}") for i in range(60)]
    texts += [(90, "no 5 then 8, Oldo bo@b.org 12 Tarn"), (91, "10.0.0.1 7 Umbra 3 10.0.0.2"), (92, "10.0.0.1 9 Umbra 4")]
    got = marked_terms(private.find_private(docs_of(spark, texts)))
    assert got == terms_by_hand(texts, lambda info: 0.5 * info)
    words = {dict(texts)[0][a:b] for a, b in got[0]}
    assert {"Zyxomir", "Quell", "ref9x", "Morlan", "Tarn"} <= words


def test_terms_far_from_the_entity_count(spark):
    """A name in letter head and signature, near the address in one document of four only."""
    gap = "so it goes on and on " * 100
    texts = [(0, "Dear Zyxomir bo@b.org " + gap)] + [(i, f"Zyxomir {gap} bo@b.org {gap} Quell9{'!' * i}") for i in (1, 2, 3)] + [(10 + i, gap) for i in range(60)]
    got = marked_terms(private.find_private(docs_of(spark, texts)))
    assert [[dict(texts)[i][a:b] for a, b in got[i]] for i in range(4)] == [["Zyxomir"]] + [["Zyxomir", "Quell9"]] * 3
    assert got == terms_by_hand(texts, lambda info: 0.5 * info)


def test_copies_are_no_evidence(spark):
    """One text in several copies marks nothing; a second text with the same name does, and copies are marked alike."""
    note = "quarterly  harvest meeting minutes sent by bo@b.org yesterday evening, file 77"
    rest = [(10 + i, f"plain row {i} of the table") for i in range(200)]
    copies = [(0, note), (1, note.replace("  ", " \n")), (2, note)]
    assert not any(marked_terms(private.find_private(docs_of(spark, copies + rest))).values())
    more = [*copies, (3, "harvest by bo@b.org"), (4, "harvest")]
    got = marked_terms(private.find_private(docs_of(spark, more + rest)))
    assert got == terms_by_hand(more + rest, lambda info: 0.5 * info)
    assert [[dict(more)[i][a:b] for a, b in got[i]] for i in range(5)] == [["harvest", "by"]] * 3 + [["harvest", "by"], []]


def test_a_long_list_of_addresses_is_one_class(spark):
    """Thousands of addresses beside thousands of words in two documents: pairs follow the words, not the product."""
    names = " ".join(f"n{i}@list.org" for i in range(2_000))
    words = " ".join(f"word{i}" for i in range(8_000))
    texts = [(0, f"{names} {words} first"), (1, f"{words} {names} second n7@list.org"), (2, "n7@list.org third")] + [(10 + i, "some other row") for i in range(30)]
    rows, hits = private.rows_with_hits(docs_of(spark, texts), "doc_id", "text")
    spans = private.base_spans(hits)
    found, members = private.disclosing(docs_of(spark, texts), rows, spans, len(texts))
    assert members.count() == 2_000 and members.select("class").distinct().count() == 2
    assert found.count() < 2 * 11_000
    got = {r.doc_id: r for r in private.summary(private.find_private(docs_of(spark, texts))).collect()}
    assert [got[i].n_email for i in range(3)] == [2_000, 2_001, 1]
    assert got[0].spans.count("term:") == 8_000 and got[2].spans.count("term:") == 0


def test_the_digest_is_that_of_the_sanitised_text(spark):
    long = "ü🙂" * 1_500 + " bo@b.org " + "x" * 1_100
    texts = [(0, "bo@b.org or 10.0.0.1"), (1, "nothing"), (2, None), (3, long), (4, "pay 4111 1111 1111 1111, a@10.0.0.1")]
    got = {r.doc_id: r.clean_sha256 for r in private.summary(private.find_private(docs_of(spark, texts))).collect()}
    want = {0: "[EMAIL] or [IP]", 3: long.replace("bo@b.org", "[EMAIL]"), 4: "pay [CARD], [EMAIL]"}
    assert got == {i: sha(want[i].encode()) if i in want else None for i in range(5)}


def test_terms_of_an_entity_that_a_third_of_the_documents_carry(spark):
    texts = [(i, f"Zyxomir of shop@x.org sells tea {'Half' * (i % 2)}") for i in range(4)] + [(10 + i, f"some tea {'Half' * (i == 0)} is fine") for i in range(8)]
    for copies in (1, 10):                       # the same documents in a small and a larger table
        rows = [(100 * c + i, t) for c in range(copies) for i, t in texts]
        got = marked_terms(private.find_private(docs_of(spark, rows)))
        assert got == terms_by_hand(rows, lambda info: 0.5 * info)
        assert all({dict(rows)[i][a:b] for a, b in got[i]} >= {"Zyxomir", "of", "sells"} for i in (0, 1, 2, 3))
        assert all({dict(rows)[i][a:b] for a, b in got[i]}.isdisjoint({"tea", "is"}) for i in got)
    every = [(i, "Zyxomir of shop@x.org") for i in range(5)]
    assert not any(marked_terms(private.find_private(docs_of(spark, every))).values())


# ---- 10 exact duplicates -----------------------------------------------------------------------------------------


def test_exact_duplicates_over_several_micro_batches(spark):
    texts = [(9, "a  b"), (2, "a\tb"), (5, "a b"), (7, None), (3, ""), (8, " "), (1, "a b "), (None, "a b"), (2, "a\tb"), (6, "long " * 60_000), (4, "long\n" * 60_000), (None, "only")]
    docs = docs_of(spark, texts, digest="x", uid=1).repartition(6)
    got = exact.exact_duplicates(docs, files_per_batch=1)
    rows = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()]
    assert Counter(rows) == Counter([(9, 2, 5, False), (2, 2, 5, True), (2, 2, 5, False), (5, 2, 5, False), (None, 2, 5, False), (7, 3, 2, False), (3, 3, 2, True), (8, 8, 1, True),
                                     (1, 1, 1, True), (6, 4, 2, False), (4, 4, 2, True), (None, None, 1, True)])
    kept = exact.keep_first(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter([2, 3, 8, 1, 4, None])
    assert kept[0].asDict().keys() == docs.first().asDict().keys()
    assert exact.exact_duplicates(docs.limit(0)).count() == 0


def test_a_colliding_digest_is_resolved_by_the_bytes(spark):
    texts = [(i, f"text {i % 7}") for i in range(40)]
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1).eqNullSafe("7").cast("string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(docs_of(spark, texts), digest=weak).collect()}
    size = Counter(i % 7 for i, _ in texts)
    assert got == {i: (i % 7, size[i % 7], i < 7) for i, _ in texts}


def test_suffixes_near_the_end_are_in_order():
    rng = np.random.default_rng(11)
    for n, letters in ((1, 1), (7, 1), (90, 1), (400, 2), (900, 3)):
        a = rng.integers(97, 97 + letters, n).astype(np.uint8)
        a[-min(n, 60):] = a[:min(n, 60)]
        raw = a.tobytes()
        sa = suffix.refined(a, 40)[0].astype(int).tolist()
        assert [raw[p:p + 80] for p in sa] == sorted(raw[p:p + 80] for p in range(n))
        assert sorted(sa) == list(range(n))
