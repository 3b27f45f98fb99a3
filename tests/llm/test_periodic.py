"""Periodic runs against a word-by-word search."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lumenframe.llm import periodic
from lumenframe.llm.queries import BOOK, repeated_tails

FOLDER = "/root/testdata/sf0.001"


def brute(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period): every period is tried at every word; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i > s and i - s + q >= max(24, 3 * q):
                found.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(words: list[str]):
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def some_words(rng: random.Random, most: int = 400) -> list[str]:
    n, k = rng.randint(0, most), rng.choice([1, 2, 3, 40, 1000])
    words = [f"w{rng.randrange(k)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 30:
            s = rng.randrange(n - 20)
            p, e = rng.randint(1, (n - s) // 3 + 1), rng.randint(s, n)
            for i in range(s, e):
                words[i] = words[s + (i - s) % p]
    return words


@pytest.mark.parametrize("size", [8, 64, 512])
def test_convolution_is_exact(size):
    rng = np.random.default_rng(size)
    digit = int(((periodic.PRIME - 1) // size) ** 0.5)
    x, y = rng.integers(0, digit, (3, size)), rng.integers(0, digit, (3, 2 * size))
    x[0], y[0] = digit - 1, 0                                            # the largest sum there can be
    want = [[int(((x[r] - y[r, e:e + size]) ** 2).sum()) for e in range(size)] for r in range(3)]
    assert periodic.squared_differences(x, y).tolist() == want


def test_word_numbers_of_several_digits():
    rng = random.Random(3)
    part = [str(rng.randrange(10 ** 9)) for _ in range(30_000)]          # digits of 500 and less at this scale
    words = part[:7000] * 3 + part[7000:]
    assert periodic.analyse([" ".join(words).encode()])[0][1] == [(0, 21_000, 7000)]


def test_runs_of_many_texts_equal_a_search():
    rng = random.Random(11)
    for _ in range(40):
        texts = [some_words(rng) for _ in range(rng.randint(1, 6))]
        texts += [list(t) for t in texts for _ in range(rng.randint(0, 3))]            # copies side by side are no run
        for words, (n, runs, kept) in zip(texts, periodic.analyse([" ".join(t).encode() for t in texts]), strict=True):
            drop = {i for s, k, q in runs for i in range(s + q, s + k)}
            assert n == len(words) and runs == brute(words)
            assert kept == " ".join(w for i, w in enumerate(words) if i not in drop).encode()


def test_odd_input_and_clashing_columns(spark):
    long = "a b c " * 30_000
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n ", 5), (4, long, 5), (4, long, 5), (None, "x " * 24, 5), (6, "x " * 23, 5), (7, "é\x0bü " * 12 + "\x1c", 5),
            (8, "ab ab " * 30, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = {}
    for r in periodic.find_runs(docs, keep_text=True, group_bytes=100).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == got[2] == got[3] == [(0, [], "")] and got[4] == 2 * [(90_000, [(0, 90_000, 3)], "a b c")]
    assert got[None] == [(24, [(0, 24, 1)], "x")] and got[6] == [(23, [], " ".join("x" * 23))]
    assert got[7] == [(25, [(0, 24, 2)], "é ü \x1c")] and got[8] == [(30, [(0, 30, 1)], "ab ab")]
    assert periodic.find_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = {}
    for r in docs.collect():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w]
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want[r.doc_id] = expected(words)
    got = BOOK.entries["op11_periodic_runs"].run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert sum(w[0] for w in want.values()) > 5


def test_tails_of_odd_texts(spark):
    rows = [(i, t) for i in range(60) for t in (None, "", " ", "one", "a b c d e f g h")]
    docs = spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string")
    assert repeated_tails(docs).count() == len(rows) + 1
    assert {r.text for r in repeated_tails(docs).where("doc_id is null").collect()} == {"a b"}
