"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 fingerprint bits gets a non-zero vector of radius + 1 bits. Table v (a non-zero vector) keeps the bits
whose vector has an odd number of ones in common with v. The vectors of up to `radius` differing bits span too little
to block every v, so every pair within the radius agrees on all kept bits of at least one of the 2^(radius+1) - 1
tables: no pair is missed.

Equal fingerprints are one row from the start. A bucket with more than `BUCKET` different fingerprints is covered again
on the bits its mask left free (the guarantee holds level by level) until buckets are small; a mask of level three
leaves only a few free bits, so this ends. Inside a bucket the links are found in numpy and only a star per connected
part leaves it, never all pairs. Components come from star contraction over these links.

Defined results: null, empty and blank texts have fingerprint zero and link like any other. Null doc_id sorts last.
Repeated rows share a fingerprint. An empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import extended, landed, same
from lumenframe.operators.graph import build_graph, connected_components

SEED = 42
SHINGLE = 3
RADIUS = 2
BUCKET = 512
BLOCK = 1 << 16
LAST_ID = (1 << 63) - 1
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit majority of the shingle hashes of a whole text, as an unsigned number."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    for at in range(0, total, BLOCK):
        n = min(BLOCK, total - at)
        shingles = map(b" ".join, zip(*(words[at + k:at + k + n] for k in range(width)), strict=True))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, n)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame, text_col: str = "text", width: int = SHINGLE, name: str = "_fp") -> DataFrame:
    """All columns of docs with the fingerprint as a signed long."""
    fields = [c for c in docs.columns if c != name]
    rows = docs.select(*fields)
    at = fields.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            found = pa.array([signed(fingerprint(t.as_py(), width)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    return rows.mapInArrow(add, extended(rows, **{name: "long"}))


def cover(radius: int = RADIUS, kept: int = 0) -> list[int]:
    """Masks that cover the radius on the bits outside `kept`, each with `kept` added."""
    free = [b for b in range(64) if not kept >> b & 1]
    vectors = (1 << radius + 1) - 1
    return [kept | sum(1 << b for i, b in enumerate(free) if ((i % vectors + 1) & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _stars(radius: int):
    """Links of each bucket (a list of different fingerprints) as stars: one row per member that is not a centre."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst = [], []
            for members in batch.column(0):
                left = np.sort(np.array(members.as_py(), np.int64))
                while len(left) > 1:
                    centre, front, rest = left[0], left[:1], left[1:]
                    while len(front) and len(rest):
                        near = (np.bitwise_count((rest[:, None] ^ front[None, :]).view(np.uint64)) <= radius).any(axis=1)
                        front, rest = rest[near], rest[~near]
                        src.append(front)
                        dst.append(np.full(len(front), centre))
                    left = rest
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({"src": np.concatenate([none, *src]), "dst": np.concatenate([none, *dst])})
    return links


def near_links(fingerprints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(src, dst): links that connect exactly the different fingerprints reachable by steps of `radius` bits or less."""
    spark = fingerprints.sparkSession
    masks = {0: cover(radius)}
    rows, found = fingerprints.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        table = spark.createDataFrame([(signed(m), [signed(s) for s in sub]) for m, sub in masks.items()], "mask long, subs array<long>")
        wide = (rows.join(F.broadcast(table), "mask").select("fp", F.explode("subs").alias("mask"))
                .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct())
        wide = landed(wide, "simhash-tables")
        sizes = landed(wide.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
        small = (wide.join(sizes.where(F.col("n") <= bucket), ["mask", "key"])
                 .groupBy("mask", "key").agg(F.collect_list("fp").alias("members")).select("members"))
        stars = small.mapInArrow(_stars(radius), "src long, dst long").distinct()
        found = stars if found is None else found.unionByName(stars)
        large = sizes.where(F.col("n") > bucket)
        if large.isEmpty():
            return found.distinct()
        rows = wide.join(large, ["mask", "key"]).select("fp", "mask")
        used = [m for (m,) in large.select("mask").distinct().collect()]        # at most 7 masks per mask of the level above
        masks = {m & (1 << 64) - 1: cover(radius, m & (1 << 64) - 1) for m in used}


def near_components(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From (doc_id, fp): one row per fingerprint with (fp, keep_id, keep_fp) of the first document of its component."""
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("at"), "doc_id", "fp")).alias("first")
    prints = landed(rows.groupBy("fp").agg(first), "simhash-prints")
    links = landed(near_links(prints.select("fp"), radius), "simhash-links")
    if links.isEmpty():
        return prints.select("fp", F.col("first.doc_id").alias("keep_id"), F.col("first.fp").alias("keep_fp"))
    parts = connected_components(build_graph(links)).withColumnRenamed("id", "fp")
    whole = landed(prints.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "simhash-parts")
    heads = whole.groupBy("component").agg(F.min("first").alias("head"))
    return (whole.join(heads, "component")
            .select("fp", F.col("head.doc_id").alias("keep_id"), F.col("head.fp").alias("keep_fp")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest doc_id reachable)."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = landed(with_fingerprints(plain, "text", width, "fp").select("doc_id", "fp"), "simhash-rows")
    parts = near_components(rows, radius)
    return rows.join(parts, "fp").select("doc_id", "fp", F.col("keep_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The first document of every component, with all its columns."""
    marked = with_fingerprints(docs, text_col, width)
    rows = landed(marked.select(F.col(id_col).cast("long").alias("doc_id"), F.col("_fp").alias("fp")), "simhash-rows")
    heads = near_components(rows, radius).select(F.col("keep_id").alias("_id"), F.col("keep_fp").alias("_head")).distinct()
    match = (F.col("_fp") == F.col("_head")) & same(F.col(id_col), F.col("_id"))
    return marked.join(heads, match).dropDuplicates([id_col, "_fp"]).select(*docs.columns)
