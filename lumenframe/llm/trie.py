"""Prefix trie of conversations by bursting containers.

A turn becomes a number of 128 bits (the start of SHA-256 over role and text); equal sequences of turns become one
sequence with a weight. All sequences start in the container of the root. A container that holds more than CONTAINER
turns bursts: its head becomes an inner node of the trie, and its sequences move to containers by their next turn, without
it. If all of them go on with the same turns, the head takes that chain along at once, so the number of rounds follows the
branchings on a path and not its length. What remains small is sorted by Spark and swept in one pass per container: a
stack holds the path of the last sequence, and the nodes below the common prefix with the next one are finished. Totals
of containers are added up along the heads above them.

A sequence is cut into segments of SEGMENT turns, so a row stays small (one row lists the digests of all segments of a
conversation: 16 bytes for 1,024 turns). Segments are done from the last to the first;
the totals of the trie below a segment's last node come from the segment after it. A sequence that no other one follows
into its next segment is a plain chain from there on and is written turn by turn without any container.

Defined results: null role and text count as empty; turns are ordered by turn, nulls first, equal turn numbers by the
turn's digest; rows without conversation id are left out; a repeated row is a further turn. Conversations without turns
are members of the root. Texts and conversations of any length are taken whole. Other columns are ignored. Without
conversations there are no nodes, not even a root.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.joins import salted_join
from lumenframe.functions.ordering import rank_in_group, running
from lumenframe.llm.common import landed

CONTAINER = 1 << 15           # turns in a container that one task sweeps
SEGMENT = 1 << 10             # turns of a sequence in one row
DIGEST = 16                   # bytes of a turn, a head and a sequence
CHUNK = 1 << 16               # bytes of joined ids in one row
SWEPT = 10_000                # nodes in a result batch
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ended long, head binary, path array<binary>")
_RESULT = _NODE[:_NODE.index(", head")]


def digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, DIGEST)


def encoded_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, tid, size): a turn's digest and the code points of its text."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    mark = F.concat(F.length(who).cast("string"), F.lit(":")).cast("binary")            # role and text cannot run into each other
    return df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        digest(mark, who.cast("binary"), said.cast("binary")).alias("tid"), F.length(said).cast("long").alias("size"))


def numbered_turns(encoded: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, size) with places from 1; a conversation may be larger than one task can hold."""
    return rank_in_group(encoded, ["conv_id"], ["turn", "tid"], "pos").select("conv_id", "pos", "tid", "size")


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (conv_id, the digests of its segments in order): the digest of all turns before and through each segment."""
    for batch in batches:
        out = {"conv_id": [], "seg": [], "before": [], "through": []}
        for conv, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            chain = bytes(DIGEST)
            for seg, part in enumerate(parts):
                out["conv_id"].append(conv)
                out["seg"].append(seg)
                out["before"].append(chain)
                chain = hashlib.sha256(chain + part).digest()[:DIGEST]
                out["through"].append(chain)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k in ("before", "through") else pa.int64()) for k, v in out.items()})


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers from rows sorted by (head, tids)."""
    names = [f.split()[0] for f in _NODE.split(", ")]
    kinds = [pa.binary() if n == "head" else pa.list_(pa.binary()) if n == "path" else pa.int64() for n in names]
    out: list[tuple] = []
    stack: list[list] = []            # conv_id, n_convs, n_children, n_leaves, saved, size of the last text, ended, finished children
    at = None                         # head, depth, path, size of the head's text
    last: list[bytes] = []

    def flush():
        done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)
        out.clear()
        return done

    def finish(down_to: int) -> None:
        while len(stack) > down_to:
            node = stack.pop()
            conv, n, children, leaves, saved, size, ended, below = node
            leaves, saved, depth = leaves or 1, saved + (n - 1) * size, at[1] + len(stack)
            for c, d, *rest in below:
                out.append((c, d, conv, *rest, None, None))
            if stack:
                up = stack[-1]
                up[0], up[1], up[2], up[3], up[4] = min(up[0], conv), up[1] + n, up[2] + 1, up[3] + leaves, up[4] + saved
                up[7].append((conv, depth, n, children, leaves, saved, ended))
            else:
                out.append((conv, depth, None, n, children, leaves, saved, ended, at[0], at[2]))

    for batch in batches:
        for head, depth, path, size, tids, sizes, conv, weight, ended, children, leaves, saved in zip(
                *(batch.column(c).to_pylist() for c in ("head", "depth", "path", "size", "tids", "sizes", "rep", "weight", "ended", "children", "leaves", "saved")), strict=True):
            if at is None or head != at[0]:
                finish(0)
                at, last = (head, depth, path, size), []
                stack.append([conv, 0, 0, 0, 0, size, None, []])
            same = 0
            while same < len(last) and same < len(tids) and last[same] == tids[same]:
                same += 1
            finish(same + 1)
            stack.extend([conv, 0, 0, 0, 0, s, None, []] for s in sizes[same:])
            top = stack[-1]
            top[0], top[1], top[2], top[3], top[4], top[6] = min(top[0], conv), top[1] + weight, top[2] + children, top[3] + leaves, top[4] + saved, ended
            last = tids
            if len(out) >= SWEPT:
                yield flush()
    finish(0)
    if out:
        yield flush()


def _burst(entries: DataFrame, container: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(sequences in small containers, burst heads, sequences that end at burst heads)."""
    rows = entries.withColumns({"depth": F.col("depth").cast("long"), "size": F.lit(0).cast("long"), "path": F.array().cast("array<binary>")})
    ready, heads, ends = [], [], []
    while True:
        rows = landed(rows, "trie-rows")
        sizes = rows.groupBy("head").agg(F.sum(F.size("tids") + 1).alias("held"), F.count(F.lit(1)).alias("n"), F.min("tids").alias("low"), F.max("tids").alias("high"))
        differs = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False)
        shared = F.when(differs > 0, differs - 1).otherwise(F.size("low")).cast("int")          # turns that all go on with
        large = landed(sizes.where((F.col("held") > container) & (F.col("n") > 1)).select(F.col("head"), "n", shared.alias("shared")), "trie-large")
        if large.isEmpty():
            ready.append(rows)
            break
        hot = [r["head"] for r in large.where("n > 100000").orderBy(F.desc("n")).limit(1000).select("head").collect()]
        marked = landed(salted_join(rows, large.select("head", "shared"), "head", "left", hot=hot), "trie-marked")
        ready.append(marked.where("shared is null").drop("shared"))
        over = marked.where("shared is not null")
        first = over.groupBy("head").agg(F.any_value("depth").alias("depth"), F.any_value("path").alias("path"), F.any_value(
            F.concat(F.array("size"), F.slice("sizes", F.lit(1), F.col("shared")))).alias("chain"))
        heads.append(first)
        done = F.size("tids") == F.col("shared")
        ends.append(over.where(done).select("head", "path", "rep", "weight", "ended", "children", "leaves", "saved"))
        rest = lambda c: F.slice(c, F.col("shared") + 2, F.size(c))
        rows = over.where(~done).select(
            digest(F.col("head"), F.array_join(F.transform(F.slice("tids", F.lit(1), F.col("shared") + 1), lambda t: F.hex(t)), "").cast("binary")).alias("head"),
            rest("tids").alias("tids"), rest("sizes").alias("sizes"), "rep", "weight", "ended", "children", "leaves", "saved",
            (F.col("depth") + F.col("shared") + 1).alias("depth"), F.get("sizes", F.col("shared")).alias("size"), F.concat("path", F.array("head")).alias("path"))

    def together(parts: list[DataFrame]) -> DataFrame | None:
        whole = None
        for p in parts:
            whole = p if whole is None else whole.unionByName(p)
        return whole
    return together(ready), together(heads), together(ends)


def _segment_nodes(entries: DataFrame, container: int) -> tuple[DataFrame, DataFrame]:
    """(nodes of a segment without the first heads, totals of the first heads)."""
    ready, heads, ends = _burst(entries, container)
    swept = ready.repartition("head").sortWithinPartitions("head", "tids").mapInArrow(_sweep, _NODE)
    swept = landed(swept, "trie-swept")
    tops = swept.where("head is not null")
    plain = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended"]
    totals = ["head", "n_convs", "n_children", "n_leaves", "saved_tokens", "conv_id", "ended"]
    nodes = swept.where("head is null").select(*plain)
    if heads is None:
        return nodes, tops.select(*totals)
    heads = landed(heads, "trie-heads")
    parent = F.try_element_at("path", F.lit(-1))
    below = (tops.where("size(path) > 0").select(F.explode("path").alias("head"), "conv_id", "n_convs", "n_leaves", "saved_tokens")
             .unionByName(ends.select(F.explode(F.concat("path", F.array("head"))).alias("head"), F.col("rep").alias("conv_id"),
                                      F.col("weight").alias("n_convs"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))))
    sums = below.groupBy("head").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    one = F.lit(1).cast("long")
    children = (tops.where("size(path) > 0").select(parent.alias("head"), one.alias("c"), F.lit(None).cast("long").alias("ended"))
                .unionByName(heads.where("size(path) > 0").select(parent.alias("head"), one.alias("c"), F.lit(None).cast("long").alias("ended")))
                .unionByName(ends.select("head", F.col("children").alias("c"), "ended"))
                .groupBy("head").agg(F.sum("c").alias("children"), F.max("ended").alias("ended")))
    chain = F.aggregate("chain", F.lit(0).cast("long"), lambda s, x: s + x)
    known = landed(heads.join(sums, "head").join(children, "head").withColumn("own", (F.col("n_convs") - 1) * chain), "trie-sums")
    inner = known.where("size(path) > 0").select(F.explode("path").alias("head"), "own").groupBy("head").agg(F.sum("own").alias("inner"))
    full = known.join(inner, "head", "left").withColumn("saved", F.col("saved") + F.coalesce("inner", F.lit(0).cast("long"))).drop("inner")
    up = known.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # every node of a chain has the same members; the last one has the children
    left = F.aggregate(F.slice("chain", F.col("at") + 1, F.size("chain")), F.lit(0).cast("long"), lambda s, x: s + x)
    rows = full.withColumn("parent", parent).join(up, "parent", "left").select("*", F.posexplode("chain").alias("at", "_s"))
    is_last = F.col("at") == F.size("chain") - 1
    inside = rows.select(
        "head", "path", "at", "conv_id", (F.col("depth") + F.col("at")).alias("depth"), F.when(F.col("at") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(is_last, F.col("children")).otherwise(one).alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * left).alias("saved_tokens"), F.when(is_last, F.col("ended")).alias("ended"))
    inside = landed(inside, "trie-inside")
    is_first = (F.size("path") == 0) & (F.col("at") == 0)
    placed = salted_join(tops.where("size(path) > 0").drop("parent_conv_id").withColumn("parent", parent), up, "parent", "inner")
    return (nodes.unionByName(inside.where(~is_first).select(*plain)).unionByName(placed.select(*plain)),
            tops.where("size(path) = 0").select(*totals).unionByName(inside.where(is_first).select(*totals)))


def _stream_runs(make):
    """Runs over (key, item, data) rows sorted by key: make(key) gives an object with add(item, data) -> rows and end() -> rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, out = None, None, []

        def packed():
            done = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())],
                                              names=["rep", "first", "data"])
            out.clear()
            return done
        for batch in batches:
            for k, item, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if now is None or k != key:
                    out += now.end() if now else []
                    now, key = make(k), k
                out += now.add(item, data)
            if out:
                yield packed()
        out += now.end() if now else []
        if out:
            yield packed()
    return work


class _Joined:
    """Ids joined by commas, in rows of bounded length."""

    def __init__(self, key: int) -> None:
        self.key, self.first, self.parts, self.held = key, None, [], 0

    def add(self, item: int, data: str) -> list[tuple]:
        self.first = item if self.first is None else self.first
        self.parts.append(data)
        self.held += len(data) + 1
        return self.end() if self.held >= CHUNK else []

    def end(self) -> list[tuple]:
        row = [(self.key, self.first, ",".join(self.parts))] if self.parts else []
        self.first, self.parts, self.held = None, [], 0
        return row


class _Hashed:
    """SHA-256 over rows in order, one comma between them."""

    def __init__(self, key: int) -> None:
        self.key, self.hash, self.first = key, hashlib.sha256(), True

    def add(self, item: int, data: str) -> list[tuple]:
        self.hash.update((data if self.first else "," + data).encode())
        self.first = False
        return []

    def end(self) -> list[tuple]:
        return [(self.key, None, self.hash.hexdigest())]


def member_digests(members: DataFrame) -> DataFrame:
    """(rep, ends_sha256) from (rep, conv_id): SHA-256 of the ids in ascending order, joined by commas.

    A hash has to be taken in order, so one task ends up with each group; it gets the ids in rows of 64 KB that many tasks
    have joined, and holds one of them at a time.
    """
    schema = "rep long, first long, data string"
    rows = members.select("rep", "conv_id", F.col("conv_id").cast("string").alias("data"))
    joined = rows.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(_stream_runs(_Joined), schema)
    hashed = joined.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(_stream_runs(_Hashed), schema)
    return hashed.select("rep", F.col("data").alias("ends_sha256"))


def _chain_nodes(pieces: DataFrame, segment: int) -> DataFrame:
    """A node for every turn of segments that one sequence has to itself; what it saves is a sum over the turns to its end."""
    zero = F.lit(0).cast("long")
    chain = pieces.select("conv_id", "weight", "n", "start", (F.col("seg") * segment + 1).alias("_at"), F.posexplode("sizes").alias("_i", "size"))
    parent = F.when(F.col("_i") == 0, F.col("start")).otherwise(F.col("conv_id"))
    chain = chain.select("conv_id", "weight", "n", parent.alias("parent_conv_id"), (F.col("_at") + F.col("_i")).cast("long").alias("depth"), "size")
    summed = running(chain.where("weight > 1"), ["conv_id"], ["-depth"], {"left": ("sum", "size")})
    known = (summed.withColumn("saved_tokens", F.col("left") * (F.col("weight") - 1)).drop("left", "size")
             .unionByName(chain.where("weight = 1").drop("size").withColumn("saved_tokens", zero)))
    more = F.col("depth") < F.col("n")
    return known.select("conv_id", "depth", "parent_conv_id", F.col("weight").alias("n_convs"), more.cast("long").alias("n_children"),
                        F.lit(1).cast("long").alias("n_leaves"), "saved_tokens", F.when(~more, F.col("conv_id")).alias("ended"))


def prefix_trie(turns: DataFrame, convs: DataFrame, container: int | None = None, segment: int | None = None) -> DataFrame:
    """One row per node from (conv_id, pos, tid, size), places from 1 without gaps, and all conversations (conv_id)."""
    container, segment = container or CONTAINER, segment or SEGMENT
    seg = F.floor((F.col("pos") - 1) / segment)
    parts = turns.groupBy("conv_id", seg.alias("seg")).agg(F.array_sort(F.collect_list(F.struct("pos", "tid", "size"))).alias("t")).select(
        "conv_id", "seg", F.transform("t", lambda x: x["tid"]).alias("tids"), F.transform("t", lambda x: x["size"]).alias("sizes"))
    parts = landed(parts.withColumn("part", digest(F.array_join(F.transform("tids", lambda t: F.hex(t)), "").cast("binary"))), "trie-parts")
    listed = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", "part"))).alias("p"), F.sum(F.size("tids")).cast("long").alias("n"))
    chains = landed(listed.select("conv_id", F.transform("p", lambda x: x["part"]).alias("p")).mapInArrow(_chains, "conv_id long, seg long, before binary, through binary"), "trie-chains")
    whole = chains.groupBy("conv_id").agg(F.max_by("through", "seg").alias("sequence"))
    start = F.lit(bytes(DIGEST))
    every = landed(convs.where("conv_id is not null").select("conv_id").distinct().join(whole, "conv_id", "left").join(listed.select("conv_id", "n"), "conv_id", "left")
                   .select("conv_id", F.coalesce("sequence", start).alias("sequence"), F.coalesce("n", F.lit(0)).alias("n")), "trie-all")
    sequences = landed(every.groupBy("sequence").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("n").alias("n")), "trie-sequences")

    mine = sequences.select(F.col("rep").alias("conv_id"), "weight", "n")
    pieces = parts.select("conv_id", "seg", "tids", "sizes").join(chains, ["conv_id", "seg"]).join(mine, "conv_id")
    nothing = mine.where("n = 0").select("conv_id", F.lit(0).cast("long").alias("seg"), F.array().cast("array<binary>").alias("tids"),
                                         F.array().cast("array<bigint>").alias("sizes"), start.alias("before"), start.alias("through"), "weight", "n")
    pieces = landed(pieces.select(*nothing.columns).unionByName(nothing), "trie-pieces")
    alone = pieces.where("seg > 0").groupBy("seg", "before").agg(F.count(F.lit(1)).alias("c")).where("c = 1").select("seg", "before", F.lit(True).alias("alone"))
    # the node before a segment also has sequences that end there
    starts = pieces.groupBy((F.col("seg") + 1).alias("seg"), F.col("through").alias("before")).agg(F.min("conv_id").alias("start"))
    pieces = landed(pieces.join(alone, ["seg", "before"], "left").join(starts, ["seg", "before"], "left")
                    .withColumn("alone", F.coalesce("alone", F.lit(False))), "trie-marked")
    last, lonely = pieces.agg(F.max(F.when(~F.col("alone"), F.col("seg"))), F.max("alone")).first()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    nodes = _chain_nodes(pieces.where("alone"), segment) if lonely else turns.sparkSession.createDataFrame([], _RESULT)
    ahead = pieces.where("alone").groupBy("conv_id", "seg", "before").agg(F.sum(F.aggregate("sizes", zero, lambda s, x: s + x) * (F.col("weight") - 1)).alias("own"))
    tails = None
    for s in range(last if last is not None else -1, -1, -1):
        # totals below the last node of this segment: from groups of the next one, or from a chain that starts there
        lone = ahead.where(F.col("seg") > s).groupBy("conv_id").agg(F.min("seg").alias("seg"), F.sum("own").alias("saved"), F.min_by("before", "seg").alias("through")).where(F.col("seg") == s + 1)
        lone = lone.select("through", one.alias("children"), one.alias("leaves"), "saved")
        below = lone if tails is None else lone.unionByName(tails)
        ends = F.col("n") <= (s + 1) * segment
        entries = (pieces.where((F.col("seg") == s) & ~F.col("alone")).groupBy("before", "through")
                   .agg(F.any_value("tids").alias("tids"), F.any_value("sizes").alias("sizes"), F.min("conv_id").alias("rep"), F.sum("weight").alias("weight"),
                        F.max(F.when(ends, F.col("conv_id"))).alias("ended")).join(below, "through", "left"))
        entries = entries.select(F.col("before").alias("head"), F.lit(s * segment).alias("depth"), "tids", "sizes", "rep", "weight", "ended",
                                 *[F.coalesce(c, zero).alias(c) for c in ("children", "leaves", "saved")])
        found, firsts = _segment_nodes(entries, container)
        firsts = landed(firsts, "trie-firsts")
        if s:
            first = pieces.where((F.col("seg") == s) & ~F.col("alone")).select("conv_id", "start")
            found = (found.join(first, "conv_id", "left")
                     .withColumn("parent_conv_id", F.when(F.col("depth") == s * segment + 1, F.col("start")).otherwise(F.col("parent_conv_id"))).drop("start"))
        nodes = nodes.unionByName(found)
        if s:
            tails = firsts.select(F.col("head").alias("through"), F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        else:
            nodes = nodes.unionByName(firsts.select("conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ended"))
    groups = sequences.where("weight > 1").select("sequence", F.col("rep"), "weight")
    hot = [r["sequence"] for r in groups.where("weight > 1000000").orderBy(F.desc("weight")).limit(1000).select("sequence").collect()]
    many = member_digests(salted_join(every.select("conv_id", "sequence"), groups.select("sequence", "rep"), "sequence", "inner", hot=hot))
    single = sequences.where("weight = 1").select("rep", F.sha2(F.col("rep").cast("string").cast("binary"), 256).alias("ends_sha256"))
    hashes = single.unionByName(many).withColumnRenamed("rep", "ended")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(hashes, "ended", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                                      F.coalesce("ends_sha256", empty).alias("ends_sha256"))
