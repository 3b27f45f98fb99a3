"""Quality selection by importance resampling.

Target text (rows labelled good) and raw text (all rows) each get a generative model over hashed word and word-pair
buckets. A document's log importance weight is the sum of the log ratios of its n-grams. Adding Gumbel noise from a hash
of the id and keeping the k largest sums draws k documents without replacement in proportion to the weights.

Counting needs one vector of `BUCKETS` numbers per task, so the models have a fixed size whatever the corpus. k is a
share of the rows: the share of good rows among the labelled ones unless given. The global rank comes from range
partitions, not from one sorted task.

Defined results: null or blank text has weight 0 in logarithms. Without labels nothing is known and all rows stay.
Repeated rows are scored alike, with equal noise, and ranked by position. Rows with a null id take part with a fixed
noise. Extra columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import ranked
from lumenframe.llm.common import extended, is_held_out, landed
from lumenframe.llm.mixing import DIGITS, hashed

BUCKETS = 10_000
SMOOTHING = 1.0
SEED = 11
BROADCAST_IDS = 1_000_000
TOKENS = re.compile(r"\w+|[^\w\s]+")
CHUNK = 1 << 20


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of all words and word pairs of a whole text, piece by piece; pairs cross the pieces."""
    last: list[int] = []
    words = (m.group() for m in TOKENS.finditer(text.lower())) if text and len(text) > CHUNK else TOKENS.findall((text or "").lower())
    held: list[int] = []

    def buckets(codes: list[int]) -> np.ndarray:
        h = np.array(last + codes, np.uint64)
        one = h[len(last):]
        two = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
        return np.concatenate((one % np.uint64(BUCKETS), two % np.uint64(BUCKETS))).astype(np.int64)

    for w in words:
        held.append(zlib.crc32(w.encode("utf-8", "surrogatepass")))
        if len(held) == CHUNK:
            yield buckets(held)
            last, held = held[-1:], []
    if held:
        yield buckets(held)


def count_buckets(texts: DataFrame) -> np.ndarray:
    """Numbers of n-grams per bucket over all rows of a one-column table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                for g in grams(t.as_py()):
                    total += np.bincount(g, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at), "n": pa.array(total[at])})

    rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()   # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p, q = target + smoothing, raw + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def with_weight(docs: DataFrame, ratios: np.ndarray, text_col: str = "text") -> DataFrame:
    """All columns but the text, with the log importance weight."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    rows = docs.select(text_col, *[c for c in docs.columns if c not in (text_col, "log_weight")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            found = [float(sum(table[g].sum() for g in grams(t.as_py()))) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.float64())], names=[*batch.schema.names[1:], "log_weight"])

    return rows.mapInArrow(score, extended(rows.drop(text_col), log_weight="double"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray | None, float]:
    """Log ratio per bucket and the share of good rows; labels of held-out ids are not used."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col(label_col) == 1).cast("long")), F.lit(0))).first()
    if not good:
        return None, 1.0
    ids = known.where(F.col(label_col) == 1).select(F.col(id_col).alias("_id")).distinct()
    ids = F.broadcast(ids) if good <= BROADCAST_IDS else ids          # size known; beyond it an ordinary join
    target = docs.join(ids, F.col(id_col) == F.col("_id"), "left_semi")
    return log_ratios(count_buckets(target.select(text_col)), count_buckets(docs.select(text_col))), good / n


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, log_weight, gumbel_key, kept."""
    ratios, good = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_weight(rows, np.zeros(BUCKETS) if ratios is None else ratios)
    uniform = (hashed(F.lit(seed), F.col("doc_id")) + F.lit(0.5)) / F.lit(float(1 << 4 * DIGITS))
    scored = landed(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "quality")
    n = scored.count()
    k = n if ratios is None and share is None else round((good if share is None else share) * n)
    placed = ranked(scored, ["-gumbel_key", "doc_id"], "place")
    return placed.select("doc_id", "log_weight", "gumbel_key", (F.col("place") <= k).alias("kept"))
