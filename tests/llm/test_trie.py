"""The conversation trie against a trie of dictionaries."""
from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import queries, trie
from lumenframe.llm.queries import BOOK

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs: dict[int, list[tuple[str, str]]]):
    """Rows of all nodes from conversations as lists of (role, text)."""
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    total: dict[tuple, list[int]] = {}
    children: dict[tuple, int] = {}
    for path in sorted(members, key=len, reverse=True):
        mine = total.setdefault(path, [0, 0])
        mine[0] += not children.get(path)
        mine[1] += (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        if path:
            up = total.setdefault(path[:-1], [0, 0])
            up[0], up[1] = up[0] + mine[0], up[1] + mine[1]
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    ends = {path: ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(path)) for path, who in members.items()}
    return sorted(((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children.get(path, 0), *total[path],
                    hashlib.sha256(ends[path].encode()).hexdigest()) for path, who in members.items()), key=str)


def rebuilt(convs: dict[int, list]) -> dict[int, list]:
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
    return {c: convs.get(c - c % 100, [])[:h[c]] + turns[h[c]:] for c, turns in convs.items()}


def turns_of(spark, convs: dict[int, list[tuple[str, str]]]):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return trie.numbered_turns(trie.encoded_turns(table)), spark.createDataFrame([(c,) for c in convs], "conv_id long")


def many(rng: random.Random, n: int) -> dict[int, list[tuple[str, str]]]:
    """Shared openings, copies, prefixes of others, long chains and empty ones."""
    kinds = [("user", "a"), ("user", "bb"), ("user", "é"), ("assistant", "a"), ("", ""), ("user", "")]
    out, opening = {}, [rng.choice(kinds) for _ in range(7)]
    for c in range(n):
        turns = (opening if rng.random() < 0.5 else []) + [rng.choice(kinds) for _ in range(rng.choice([0, 1, 2, 3, 9, 30]))]
        if out and rng.random() < 0.4:
            other = rng.choice(list(out.values()))
            turns = other[:rng.randint(0, len(other))] + (turns if rng.random() < 0.4 else []) if rng.random() < 0.5 else list(other)
        out[rng.randrange(10 ** 6)] = turns
    return out


@pytest.mark.parametrize("container,segment", [(None, None), (30, 9), (12, 1000)])
def test_trie_equals_dictionaries(spark, container, segment):
    convs = many(random.Random(segment or 0), 120)
    got = trie.prefix_trie(*turns_of(spark, convs), container=container, segment=segment)
    assert got.columns == COLUMNS and {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(convs)


def test_hot_first_turn_and_large_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 20)                                # ids of a group come in many rows
    rng = random.Random(2)
    same = [("user", "hello"), ("assistant", "x" * 50), ("user", "z")]
    convs = {c: list(same) for c in range(300)} | {c: same[:2] + [("user", str(rng.randrange(40)))] for c in range(1000, 1200)}
    convs |= {c: [] for c in range(2000, 2030)} | {3000: same * 40, 3001: same * 40, 3002: same * 40 + [("user", "end")]}
    got = trie.prefix_trie(*turns_of(spark, convs), container=40, segment=50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(convs)


def test_odd_rows_in_the_query(spark, tmp_path):
    rows = [(0, 0, "user", "a"), (0, None, "assistant", "first"), (0, 1, None, None), (0, 2, "user", "b"), (0, 3, "user", "c"), (0, 4, "user", "d"), (0, 5, "u", "e"),
            (7, 0, "user", "a"), (7, 1, "user", "y"), (7, 1, "user", "y"), (150, 0, "x", "no base"), (150, 1, "x", "b"), (None, 0, "user", "lost"), (33, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"tid": F.lit(1), "pos": F.lit("p"), "size": F.lit(0)})
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    order = lambda r: (-1 if r[1] is None else r[1])
    convs = {c: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)] for c in (0, 7, 150, 33)}
    got = BOOK.entries["op13_conversation_trie"].run(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rebuilt(convs))


def test_query_equals_dictionaries(spark):
    convs: dict[int, list] = {}
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    got = queries.op13(spark, FOLDER)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rebuilt(convs))


def test_no_conversations(spark):
    turns, convs = turns_of(spark, {1: []})
    assert trie.prefix_trie(turns, convs.limit(0)).count() == 0
    root = trie.prefix_trie(turns, convs).collect()
    assert [tuple(r) for r in root] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
