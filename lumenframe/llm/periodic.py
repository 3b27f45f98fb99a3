"""Periodic runs of words by block convolution.

The words of some texts are laid out as one row of numbers. At scale B (8, 16, 32, ...) it is cut into blocks of B words.
A run of period q in [B, 2B) keeps a whole block whose copy stands q words later, so it is enough to compare every block
with the window of 2B words after it. Sums of squared differences for all distances at once come from one cyclic
convolution per block, done exactly as a number-theoretic transform over the integers modulo PRIME: word numbers are
written in digits so small that no sum reaches PRIME, and a distance counts if the sums of all digits are zero. Periods
under 8 are found by the blocks of the first scale, as a run has 24 words or more.

Equal distances of neighbouring blocks form chains; a chain is extended word by word on both sides, by less than a block.
Of the stretches with the same ends the one with the least distance is the run (its distance is the smallest period).
A block with a word that does not come again within 2B words cannot match and is not transformed; a block whose match
lies inside a run found at an earlier scale, at a multiple of its period, is not extended again. Both lose nothing.

Defined results: words are `[^\\x20\\x09-\\x0D]+`; null, empty and blank texts have no words and no runs. Texts of any
length are taken whole (about 50 bytes of memory a word; long texts are worked on alone). Repeated rows and ties are
independent of each other: every row gets its own result. Extra columns pass through; columns with the names of the
results are replaced. An empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

LEAST = 24                    # words in a run
TIMES = 3                     # periods in a run
FIRST = 8                     # words in a block of the first scale: any 16 words in a row hold a whole block
PRIME = 15 * (1 << 27) + 1
GENERATOR = 31
GROUP_BYTES = 1 << 22         # texts worked on together
CELLS = 1 << 19               # numbers in one transform call
REACH = 1 << 20               # words compared in one extension call
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // np.uint64(PRIME) * np.uint64(PRIME)


@lru_cache(maxsize=None)
def _roots(half: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out, at = np.ones(half, np.uint64), 1
    while at < half:
        out[at:2 * at] = _mod(out[:at] * np.uint64(pow(root, at, PRIME)))
        at *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row; the results stand in bit-reversed order."""
    a, n = rows.astype(np.uint64), rows.shape[1]
    half = n // 2
    while half:
        v = a.reshape(len(a), n // (2 * half), 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        total = low + high
        np.copyto(high, _mod((low + np.uint64(PRIME) - high) * _roots(half, False)))
        np.copyto(low, np.where(total >= PRIME, total - np.uint64(PRIME), total))
        half //= 2
    return a


def inverse(rows: np.ndarray) -> np.ndarray:
    """From bit-reversed order back to the row."""
    a, n, half = rows.copy(), rows.shape[1], 1
    while half < n:
        v = a.reshape(len(a), n // (2 * half), 2, half)
        low, high = v[:, :, 0].copy(), _mod(v[:, :, 1] * _roots(half, True))
        v[:, :, 0] = _mod(low + high)
        v[:, :, 1] = _mod(low + np.uint64(PRIME) - high)
        half *= 2
    return _mod(a * np.uint64(pow(n, PRIME - 2, PRIME)))


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of (block[k] - window[e + k]) ** 2 for e in 0..B-1; windows have 2B numbers. Exact below PRIME."""
    size = blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, size + 1:] = blocks[:, :0:-1]            # a cyclic product with the reversed block is a correlation
    cross = inverse(_mod(transform(turned) * transform(windows)))[:, :size].astype(np.int64)
    sums = np.zeros((len(windows), 2 * size + 1), np.int64)
    np.cumsum(windows.astype(np.int64) ** 2, axis=1, out=sums[:, 1:])
    return (blocks.astype(np.int64) ** 2).sum(axis=1)[:, None] + sums[:, size:2 * size] - sums[:, :size] - 2 * cross


def matches(words: np.ndarray, blocks: np.ndarray, size: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(block number, distance) where a block equals the words `distance` later, for distances offset .. offset + size - 1."""
    digit = int(((PRIME - 1) // size) ** 0.5)            # size * (digit - 1) ** 2 stays below PRIME
    top, found_block, found_at = int(words.max(initial=0)), [], []
    at_once = max(1, CELLS // (2 * size))
    for i in range(0, len(blocks), at_once):
        no = blocks[i:i + at_once]
        x = words[no[:, None] * size + np.arange(size)]
        at = no[:, None] * size + offset + np.arange(2 * size)
        y = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)
        zero, open_, scale = np.ones((len(no), size), bool), np.arange(len(no)), 1
        while scale <= top and len(open_):
            differ = squared_differences(x[open_] // scale % digit, y[open_] // scale % digit)
            zero[open_] &= differ == 0
            open_ = open_[zero[open_].any(axis=1)]
            scale *= digit
        row, e = np.nonzero(zero)
        found_block.append(no[row])
        found_at.append(e + offset)
    none = np.zeros(0, np.int64)
    block, distance = np.concatenate([none, *found_block]), np.concatenate([none, *found_at])
    inside = (block * size + distance + size <= len(words)) & (distance > 0)
    return block[inside], distance[inside]


def _extend(words: np.ndarray, start: np.ndarray, distance: np.ndarray, way: int, most: int) -> np.ndarray:
    """How many words in a row equal those `distance` later, from `start` on (way 1) or before it (way -1).

    Steps double up to `most` words, so the work follows the length.
    """
    length, open_, step = np.zeros(len(start), np.int64), np.arange(len(start)), 1
    while len(open_):
        going = []
        for i in range(0, len(open_), max(1, REACH // step)):
            who = open_[i:i + max(1, REACH // step)]
            first = start[who] + (length[who] if way > 0 else -length[who] - 1)
            at = first[:, None] + way * np.arange(step)
            far = at + distance[who][:, None]
            ok = (at >= 0) & (far < len(words))
            same = ok & (words[np.clip(at, 0, len(words) - 1)] == words[np.minimum(far, len(words) - 1)])
            ahead = np.where(same.all(axis=1), step, same.argmin(axis=1))
            length[who] += ahead
            going.append(who[ahead == step])
        open_, step = np.concatenate(going), min(2 * step, most)
    return length


def word_runs(words: np.ndarray, doc: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in some texts at once, ascending; places are those of `words`.

    `words` holds numbers from 1 on and a negative number of its own after each text; `doc` is the text of each word and
    `longest` the number of words of the longest text.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    again = (words[order][1:] == words[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    gap = np.full(n, 1 << 62, np.int64)
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    plain = np.maximum(words, 0)                        # all separators are 0, which no block that is compared holds
    size, widest = FIRST, gap[:n // FIRST * FIRST].reshape(-1, FIRST).max(axis=1)
    runs: dict[tuple[int, int], int] = {}
    while TIMES * size <= max(longest, LEAST) and len(widest):
        alive = np.flatnonzero(widest < 2 * size)
        if len(alive):
            parts = [matches(plain, alive, size, offset) for offset in ((0, size) if size == FIRST else (size,))]
            block, distance = (np.concatenate(p) for p in zip(*parts, strict=True))
            reach, period = np.zeros(n, np.int64), np.ones(n, np.int64)
            for (i, j), q in runs.items():
                part = slice(i, j)
                period[part] = np.where(reach[part] < j, q, period[part])
                reach[part] = np.maximum(reach[part], j)
            at = block * size
            known = (reach[at] >= at + distance + size) & (distance % period[at] == 0)
            block, distance = block[~known], distance[~known]
            order = np.lexsort((block, distance))
            block, distance = block[order], distance[order]
            first = np.ones(len(block), bool)
            first[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + 1)
            last = np.append(first[1:], True)[:len(block)]
            d, left, right = distance[first], block[first] * size, (block[last] + 1) * size
            begin, end = left - _extend(words, left, d, -1, size), right + _extend(words, right, d, 1, size) + d
            long = end - begin >= np.maximum(LEAST, TIMES * d)
            for i, j, q in zip(begin[long].tolist(), end[long].tolist(), d[long].tolist(), strict=True):
                runs[i, j] = min(q, runs.get((i, j), q))
        size *= 2
        widest = widest[:len(widest) // 2 * 2].reshape(-1, 2).max(axis=1)
    return sorted((i, j, q) for (i, j), q in runs.items())


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The (start, length, period) with the greatest length / period; ties to the smallest start, then period."""
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return best


def analyse(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs as (start, length, period) by start and period, kept words joined by one space) of each text."""
    raw = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    blank = _BLANK[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1                  # the blank after each word
    letters = pa.py_buffer(raw[~blank].tobytes())
    lengths = stops - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), letters])
    number = listed.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    n_words = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
    doc = np.repeat(np.arange(len(texts)), n_words + 1)
    tops = np.cumsum(n_words + 1)                                          # a separator ends each text
    words = np.empty(len(doc), np.int64)
    ended = tops - 1
    words[ended] = -1 - np.arange(len(texts))
    inner = np.ones(len(doc), bool)
    inner[ended] = False
    words[inner] = number
    runs = word_runs(words, doc, int(n_words.max(initial=0)))
    spaced = raw[~blank | np.concatenate([[False], ~blank[:-1]])].copy()    # every word and one blank
    spaced[np.cumsum(lengths + 1) - 1] = 0x20
    cuts = np.concatenate([[0], np.cumsum(lengths + 1)])
    of: dict[int, list[tuple[int, int, int]]] = {}
    for i, j, q in runs:
        k = int(doc[i])
        of.setdefault(k, []).append((i - int(tops[k] - n_words[k] - 1), j - i, q))
    out, at = [], 0
    for k, n in enumerate(n_words.tolist()):
        held = spaced[cuts[at]:cuts[at + n]]
        if k in of:
            kept = np.ones(n, bool)
            for s, length, q in of[k]:
                kept[s + q:s + length] = False
            held = held[np.repeat(kept, lengths[at:at + n] + 1)]
        out.append((n, sorted(of.get(k, []), key=lambda r: (r[0], r[2])), held[:-1].tobytes()))
        at += n
    return out


def _groups(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def find_runs(docs: DataFrame, text_col: str = "text", keep_text: bool = False, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The columns of docs without the text, and n_words, runs (start, length, period), the strongest run, the digests of
    the listed runs and of the collapsed text; with keep_text the collapsed text itself as `collapsed`."""
    made = {"n_words": "long", "runs": "array<struct<start:long,length:long,period:long>>",
            "strongest": "struct<start:long,length:long,period:long>", "runs_sha256": "string", "collapsed_sha256": "string"}
    if keep_text:
        made["collapsed"] = "string"
    carried = docs.select(*[c for c in docs.columns if c != text_col and c not in made])
    rows = docs.select(*carried.columns, docs[text_col].alias("collapsed"))
    schema = StructType([*carried.schema.fields, *StructType.fromDDL(", ".join(f"{c} {t}" for c, t in made.items())).fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("start", "length", "period")
        run = pa.struct([(f, pa.int64()) for f in fields])
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(batch.num_columns - 1).cast(pa.large_binary())]
            found = [r for group in _groups(texts, group_bytes) for r in analyse(group)]
            packed = [[dict(zip(fields, r, strict=True)) for r in runs] for _, runs, _ in found]
            best = [_strongest(runs) for _, runs, _ in found]
            listed = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for _, runs, _ in found]
            columns = [pa.array([n for n, _, _ in found], pa.int64()), pa.array(packed, pa.list_(run)),
                       pa.array([b and dict(zip(fields, b, strict=True)) for b in best], run),
                       pa.array([hashlib.sha256(t.encode()).hexdigest() for t in listed], pa.string()),
                       pa.array([hashlib.sha256(t).hexdigest() for _, _, t in found], pa.string())]
            if keep_text:
                columns.append(pa.array([t for _, _, t in found], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return rows.mapInArrow(find, schema)
