"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters, words padded by one blank) of a language.
A text gets the language whose profile is nearest by out-of-place distance: the sum, over the text's own most frequent
n-grams, of how far the rank moved. An n-gram missing from the profile stands at the rank after its last one, and one
that no profile holds counts as the whole profile length.

Counting runs per Arrow batch in numpy; what leaves a task is one row per (language, n-gram) it has seen. The model
is `languages x profile_size` rows: `MAX_LANGUAGES` is the documented bound on what goes to every task.

Defined results: null text, empty text or no letter gives `und` and score 0. Ties between languages go to the
alphabetically first. Repeated rows each get their own row. With no training rows every text with letters is `und`.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import extended

PROFILE_SIZE = 400
MAX_LANGUAGES = 2_000
UNDECIDED = "und"
CHUNK = 1 << 20
FLUSH = 1 << 21

_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for everything else; made once per worker."""
    if not _TABLE:
        table = np.zeros(0x110000, np.uint64)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                table[c] = ord(ch.lower()[0]) & 0xFFFFF
        _TABLE.append(table)
    return _TABLE[0]


def _chunk_grams(letters: np.ndarray) -> np.ndarray:
    """n-grams of one run of letters (0 between words), each packed with its length into 62 bits."""
    before = np.concatenate(([np.uint64(0)], letters[:-1]))
    c = letters[(letters != 0) | (before != 0)]
    c = np.concatenate(([np.uint64(0)], c, [np.uint64(0)]))
    s = np.uint64(20)
    two = (c[:-1] << s) | c[1:]
    three = (two[:-1] << s) | c[2:]
    return np.concatenate((c[c != 0] | np.uint64(1 << 60), two[two != 0] | np.uint64(2 << 60),
                           three[c[1:-1] != 0] | np.uint64(3 << 60)))


def merged(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (value, count) lists."""
    v, at = np.unique(np.concatenate(values), return_inverse=True)
    return v, np.bincount(at, weights=np.concatenate(counts), minlength=len(v)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text with their counts; long texts go through in pieces."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    table, values, counts = _letters(), [], []
    at = 0
    while at < len(codes):
        end = min(at + CHUNK, len(codes))
        part = table[codes[at:end]]
        if end < len(codes) and (gaps := np.flatnonzero(part == 0)).size:     # cut between words where there is a gap
            end = at + int(gaps[-1]) + 1
            part = part[:end - at]
        at = end
        if part.any():
            v, n = np.unique(_chunk_grams(part), return_counts=True)
            values.append(v)
            counts.append(n)
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (values[0], counts[0]) if len(values) == 1 else merged(values, counts)


def by_rank(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent values first, ties by value."""
    return values[np.lexsort((values, -counts))[:size]]


def train_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, rank from 0): the profile of every non-null language value of the rows given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        waiting = 0

        def flush():
            for lang, parts in held.items():
                v, n = merged([p[0] for p in parts], [p[1] for p in parts])
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(v), pa.string()),
                                                  "gram": pa.array(v.astype(np.int64)), "n": pa.array(n)})

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                pair = gram_counts(text.as_py())
                if len(pair[0]):
                    held.setdefault(lang.as_py(), []).append(pair)
                    waiting += len(pair[0])
                if waiting > FLUSH:                     # merge in memory; emit only when distinct values pile up
                    held = {k: [merged([p[0] for p in ps], [p[1] for p in ps])] for k, ps in held.items()}
                    waiting = sum(len(ps[0][0]) for ps in held.values())
                    if waiting > FLUSH // 2:
                        yield from flush()
                        held, waiting = {}, 0
        yield from flush()

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
            .select("lang", "gram", "rank"))


def load_model(profiles: DataFrame, size: int = PROFILE_SIZE, most: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, sorted n-grams and their rank per language; fails beyond `most` languages, the bound of the model."""
    rows = profiles.limit(most * size + 1).toArrow().to_pydict()
    langs = sorted(set(rows["lang"]))
    if len(langs) > most or len(rows["lang"]) > most * size:
        raise ValueError(f"more than {most} languages")
    grams = np.unique(np.array(rows["gram"], np.int64).astype(np.uint64)) if langs else np.zeros(0, np.uint64)
    ranks = np.full((len(grams), len(langs)), size, np.int32)
    at = np.searchsorted(grams, np.array(rows["gram"], np.int64).astype(np.uint64))
    ranks[at, [langs.index(x) for x in rows["lang"]]] = rows["rank"]
    return langs, grams, ranks


def nearest_profile(text: str | None, model: tuple[list[str], np.ndarray, np.ndarray], size: int) -> tuple[str, float]:
    """Language and 1 minus the out-of-place distance as a share of the largest possible one."""
    langs, grams, ranks = model
    own = by_rank(*gram_counts(text), size)
    if not len(own) or not langs:
        return UNDECIDED, 0.0
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    known = grams[at] == own
    moved = np.abs(ranks[at[known]] - np.flatnonzero(known)[:, None])
    far = np.minimum(moved, size).sum(axis=0) + size * int((~known).sum())
    best = int(np.argmin(far))
    return langs[best], 1.0 - float(far[best]) / (size * len(own))


def predict(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """All columns of `docs` with `lang_pred` and `score`; only the text is looked at."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(profiles, size))
    fields = [f for f in docs.columns if f not in ("lang_pred", "score")]
    rows = docs.select(*fields)
    at = fields.index(text_col)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest_profile(t.as_py(), model.value, size) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(label, extended(rows, lang_pred="string", score="double"))
