"""Suffix-array de-duplication of byte strings across documents.

Every byte covered by a string of `WINDOW` bytes that also starts in a document with a smaller id is to go.

Shards. Each task packs documents into buffers of at most `SHARD` bytes, sorts all suffixes of a buffer by Larsson-
Sadakane refinement in numpy (ranks of h bytes give ranks of 2h bytes; only groups that are still equal are sorted
again) and finds with Kasai's rule which neighbours share `WINDOW` bytes (along a chain of suffixes whose neighbours
move in step, the common prefix grows by one per step back). The first suffix of a group is the one of the smallest id,
so the repeats inside a shard are known.

Merging. Of what is left, each window is represented by its anchor: the `GRAM` bytes in it with the least hash. Equal
windows have equal anchors at equal places, so windows of two shards can only match where their shards hold the same
anchor. Each shard sends its sorted anchor keys by key range; in a range, binary search of every shard's run in the keys
that several shards hold tells which anchors are shared. Only the bytes around shared anchors travel then, grouped by
anchor, and the same suffix sort finds the windows that are equal byte by byte and the smallest id of each.

Keys are 32 bits inside a range, and the number of ranges follows the input, so the share of accidental hits is the same
at every size; hits only cost transport, since bytes decide. Texts longer than a shard are cut into overlapping pieces.
A passage in a third of all rows is one representative per shard before anything is sent.

Defined results: null text is empty. Rows with equal ids never remove from each other; repeated rows get equal results.
A null id counts as larger than all others. Empty tables give an empty result. Extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import landed

WINDOW = 50
GRAM = 20
SHARD = 1_000_000
PIECES = 60_000
RANGE_BYTES = 2 << 20
FIRST = 5                          # bytes of the first sort
BITS = 21                          # a rank or a place in a buffer
LAST_ID = (1 << 63) - 1
U = np.uint64
MASK = U((1 << BITS) - 1)


# ---- one buffer ------------------------------------------------------------------------------------------------


def refined(a: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in suffix order by the first h >= 2 * depth bytes or more, with the slots whose suffixes shared h / 2 bytes
    with a neighbour before the last round, and the group head of each of these slots then."""
    n = len(a)
    padded = np.concatenate((a, np.zeros(FIRST, np.uint8)))
    key = np.zeros(n, U)
    for i in range(FIRST):
        key <<= U(8)
        key |= padded[i:n + i]
    place = np.arange(n, dtype=U)
    small = n < (1 << BITS) - 1
    if small:
        key <<= U(BITS)
        key |= place
        key.sort()
        sa, pair = key & MASK, key >> U(BITS)
    else:
        sa = np.argsort(key, kind="stable").astype(U)
        pair = key[sa]
    head = np.concatenate((np.ones(min(n, 1), bool), pair[1:] != pair[:-1]))
    slot = np.arange(n, dtype=np.int32 if small else np.int64)                # narrow numbers keep the ranks in the cache
    group = np.maximum.accumulate(np.where(head, slot, 0)) if n else slot
    rank = np.zeros(n + 4 * depth, np.uint32 if small else U)                 # zero past the end
    rank[sa] = group + 1
    live = slot[~(head & np.concatenate((head[1:], [True])))] if n else slot
    h = FIRST
    while True:
        last, own = h >= depth, group[live]
        pos = sa[live]
        second = rank[pos + U(h)]
        if small:
            key = own.astype(U)
            key <<= U(BITS)
            key |= second
            key <<= U(BITS)
            key |= pos
            key.sort()
            pos = key & MASK
            key >>= U(BITS)
            changed = key[1:] != key[:-1]
        else:
            order = np.lexsort((pos, second, own))
            pos, second = pos[order], second[order]
            changed = (np.diff(own) != 0) | (second[1:] != second[:-1])
        sa[live] = pos
        if last or not len(live):
            return sa, live, own
        head = np.concatenate((np.ones(min(len(live), 1), bool), changed))
        group[live] = np.maximum.accumulate(np.where(head, live, 0)) if len(live) else live
        rank[pos] = group[live] + 1
        live = live[~(head & np.concatenate((head[1:], [True])))] if len(live) else live
        h *= 2


def repeated_windows(a: np.ndarray, valid: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places of the valid windows that occur at least twice in a buffer, and the first place of the same window."""
    depth = FIRST
    while 2 * depth < window:
        depth *= 2
    sa, live, group = refined(a, depth)
    none = np.zeros(0, np.int64)
    if len(live) < 2:
        return none, none
    here, before = sa[live].astype(np.int64), np.concatenate(([-1], sa[live[:-1]].astype(np.int64)))
    near = np.concatenate(([False], group[1:] == group[:-1]))              # neighbours that share `depth` bytes
    n = len(a)
    phi = np.full(n + 1, -2, np.int64)
    phi[here[near]] = before[near]
    at = np.flatnonzero(phi[:n] >= 0)
    ends = at[phi[at + 1] != phi[at] + 1]                                   # where a chain in step stops: compared byte by byte
    padded = np.concatenate((a, np.zeros(window, np.uint8)))
    common, same = np.full(len(ends), depth), np.ones(len(ends), bool)
    for k in range(depth, window):
        same &= (padded[ends + k] == padded[phi[ends] + k]) & (phi[ends] + k < n) & (ends + k < n)
        common += same
    stop = np.searchsorted(ends, at)
    reach = common[stop] + (ends[stop] - at)                                # Kasai, read backwards
    shares = np.zeros(n, bool)
    shares[at[reach >= window]] = True
    joined = near & shares[here]
    number = np.cumsum(~joined)
    ok = valid[here]
    here, number = here[ok], number[ok]
    if not len(here):
        return none, none
    starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    sizes = np.diff(np.append(starts, len(here)))
    first = np.repeat(np.minimum.reduceat(here, starts), sizes)
    many = np.repeat(sizes > 1, sizes)
    return here[many], first[many]


def gram_hashes(a: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of the gram bytes from every place; built by doubling."""
    base, made, out, done = 0x9E3779B97F4A7C15, {1: a.astype(U) + U(1)}, None, 0
    size = 1
    while 2 * size <= gram:
        h = made[size]
        made[2 * size] = h[:-size] * U(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    for s in sorted(made, reverse=True):
        if gram & s:
            out = made[s] if out is None else out[:len(made[s][done:])] * U(pow(base, s, 1 << 64)) + made[s][done:][:len(out)]
            done += s
    out = out[:max(0, len(a) - gram + 1)]
    out = (out ^ (out >> U(32))) * U(0xD6E8FEB86659FD93)
    out = (out ^ (out >> U(29))) * U(0xA0761D6478BD642F)
    return out ^ (out >> U(32))


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For the window at every place, the place of its gram with the least hash, the first one if several."""
    width = window - gram + 1
    m, size = (hashes & ~MASK) | np.arange(len(hashes), dtype=U), 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if width > size:
        m = np.minimum(m[:len(m) - (width - size)], m[width - size:])
    return (m & MASK).astype(np.int64)


def runs_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs in sorted places."""
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return (places[np.concatenate(([0], cut))], places[np.concatenate((cut, [len(places)])) - 1] + 1) if len(places) else (places, places)


#: id, text hash, place of the piece in its text, bytes, and what else is known of the document.
Piece = tuple[int, int, int, bytes, object]


class Buffer:
    """Pieces of documents in the order of their ids, with the places where a window fits into a piece."""

    def __init__(self, pieces: list[Piece], window: int = WINDOW):
        pieces = sorted(pieces, key=lambda p: p[:3])
        self.ids = np.array([p[0] for p in pieces], np.int64)
        self.hashes = np.array([p[1] for p in pieces], np.int64)
        self.offsets = np.array([p[2] for p in pieces], np.int64)
        self.extras = [p[4] for p in pieces]
        sizes = np.array([len(p[3]) for p in pieces], np.int64)
        self.a = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        self.starts = np.cumsum(sizes) - sizes
        self.piece = np.repeat(np.arange(len(pieces)), sizes)
        self.valid = np.arange(len(self.a)) + window <= np.repeat(self.starts + sizes, sizes)

    def flagged(self, window: int = WINDOW) -> np.ndarray:
        """Places of windows that also start in a piece with a smaller id."""
        place, first = repeated_windows(self.a, self.valid, window)
        hit = self.ids[self.piece[place]] > self.ids[self.piece[first]]
        return np.sort(place[hit])

    def spans(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of window places as piece number, start and end in the document's bytes; a run stays in one piece."""
        a, b = runs_of(places)
        piece = self.piece[a] if len(a) else a
        shift = self.offsets[piece] - self.starts[piece] if len(a) else a
        return piece, a + shift, b + shift


def range_of(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range number and the 32-bit key inside it."""
    return ((hashes >> U(32)) * U(ranges) >> U(32)).astype(np.int64), (hashes & U(0xFFFFFFFF)).astype(np.uint32)


def pieces_of(doc_id: int, text_hash: int, text: bytes, extra: object, shard: int, window: int = WINDOW) -> Iterator[Piece]:
    """The text in overlapping pieces, so that every window lies in exactly one of them from its start on."""
    step = shard // 2
    if len(text) <= shard:
        yield doc_id, text_hash, 0, text, extra
        return
    for at in range(0, len(text), step):
        yield doc_id, text_hash, at, text[at:at + step + window - 1], extra


def buffers(rows: Iterator[tuple[int, int, bytes, object]], shard: int, window: int = WINDOW) -> Iterator[Buffer]:
    held, size = [], 0
    for row in rows:
        for piece in pieces_of(*row, shard, window):
            if size + len(piece[3]) > shard or len(held) == PIECES:
                yield Buffer(held, window)
                held, size = [], 0
            held.append(piece)
            size += len(piece[3])
    if held:
        yield Buffer(held, window)


# ---- the Spark job ---------------------------------------------------------------------------------------------

SHARED = "r long, shard long, docs binary, keys binary, ids binary, hashes binary, spans binary"
AROUND = "r long, docs binary, places binary, anchor binary, bytes binary"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, None]]:
    for batch in batches:
        for i, h, text in zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), batch.column("text"), strict=True):
            yield i, h, text.as_py(), None


def _blob(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(f.split(" ") for f in schema.split(", ")), strict=True)
    of = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], of[k]) for i, k in enumerate(kinds)], names=list(names))


def _sort_shards(ranges: int, shard: int):
    """Per buffer: its repeats (a row with r below 0) and the anchors of everything else by key range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buf in buffers(_texts(batches), shard):
            number = int.from_bytes(hashlib.sha256(buf.ids.tobytes() + buf.hashes.tobytes() + buf.offsets.tobytes()).digest()[:7], "little")
            gone = buf.flagged()
            piece, start, end = buf.spans(gone)
            rows = [(-1 - number % ranges, number, None, None, _blob(buf.ids, "<i8"), _blob(buf.hashes, "<i8"), _blob(np.stack((piece, start, end)), "<i8"))]
            left = buf.valid.copy()
            left[gone] = False
            place = np.flatnonzero(left)
            if len(place):
                hashes = gram_hashes(buf.a)
                at = anchors(hashes)[place]
                keep = np.concatenate(([True], (at[1:] != at[:-1]) | (buf.piece[place[1:]] != buf.piece[place[:-1]])))
                r, key = range_of(hashes[at[keep]], ranges)
                doc = buf.piece[place[keep]]
                packed = np.unique((r.astype(U) << U(48)) | (key.astype(U) << U(16)) | doc.astype(U)) if ranges < 1 << 16 else None
                if packed is None:
                    order = np.lexsort((doc, key, r))
                    r, key, doc = r[order], key[order], doc[order]
                else:
                    r, key, doc = (packed >> U(48)).astype(np.int64), ((packed >> U(16)) & U(0xFFFFFFFF)).astype(np.uint32), packed & U(0xFFFF)
                cut = np.concatenate(([0], np.flatnonzero(np.diff(r)) + 1, [len(r)]))
                for a, b in zip(cut, cut[1:], strict=False):
                    rows.append((int(r[a]), number, _blob(doc[a:b], "<u2"), _blob(key[a:b], "<u4"), None, None, None))
            yield _batch(SHARED, rows)
    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    """The anchors of a key range that at least two shards hold, per shard; rows on repeats pass through."""
    r = table["r"][0].as_py()
    if r < 0:
        return table
    shards = table["shard"].to_pylist()
    keys = [np.frombuffer(x, "<u4") for x in table["keys"].to_pylist()]
    docs = [np.frombuffer(x, "<u2") for x in table["docs"].to_pylist()]
    held, n = np.unique(np.concatenate([np.unique(k) for k in keys]), return_counts=True)
    several = held[n > 1]
    rows = []
    for s, k, d in zip(shards, keys, docs, strict=True):
        at = np.searchsorted(several, k)                            # binary search of the shard's run in the merged keys
        hit = several[np.minimum(at, len(several) - 1)] == k if len(several) else np.zeros(len(k), bool)
        if hit.any():
            rows.append((r, s, _blob(d[hit], "<u2"), _blob(k[hit], "<u4"), None, None, None))
    return pa.Table.from_batches([_batch(SHARED, rows)])


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From all rows of a shard: id, text hash, shared anchors (range and key) and repeats of every document concerned."""
    for batch in batches:
        out = {"id": [], "h": [], "anchors": [], "starts": [], "ends": []}
        for row in batch.column(0).to_pylist():
            own = next(x for x in row if x["r"] < 0)
            ids, hashes = np.frombuffer(own["ids"], "<i8"), np.frombuffer(own["hashes"], "<i8")
            piece, start, end = np.frombuffer(own["spans"], "<i8").reshape(3, -1)
            none = np.zeros(0, U)
            doc = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x["docs"], "<u2").astype(np.int64) for x in row if x["r"] >= 0)])
            key = np.concatenate([none, *((U(x["r"]) << U(32)) | np.frombuffer(x["keys"], "<u4").astype(U) for x in row if x["r"] >= 0)])
            order, order2 = np.argsort(doc, kind="stable"), np.argsort(piece, kind="stable")
            doc, key, piece, start, end = doc[order], key[order], piece[order2], start[order2], end[order2]
            for d in np.unique(np.concatenate((doc, piece))):
                a, b = np.searchsorted(doc, (d, d + 1))
                c, e = np.searchsorted(piece, (d, d + 1))
                out["id"].append(int(ids[d]))
                out["h"].append(int(hashes[d]))
                out["anchors"].append(_blob(key[a:b], "<u8"))
                out["starts"].append(_blob(start[c:e], "<i8"))
                out["ends"].append(_blob(end[c:e], "<i8"))
        kinds = {"id": pa.int64(), "h": pa.int64(), "anchors": pa.binary(), "starts": pa.binary(), "ends": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in kinds.items()], names=list(kinds))


def _around_shared(ranges: int, shard: int):
    """The bytes around shared anchors of windows not yet gone, by key range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("id", "h", "text", "anchors", "starts", "ends")]
                for i, h, text, near, start, end in zip(*cols, strict=True):
                    yield i, h, zstandard.decompress(text), (np.frombuffer(b"".join(near), "<u8"), np.frombuffer(b"".join(start), "<i8"), np.frombuffer(b"".join(end), "<i8"))

        for buf in buffers(rows(), shard):
            wanted, gone = [], np.zeros(len(buf.a) + 1, np.int64)
            for lo, hi, offset, (near, start, end) in zip(buf.starts, np.append(buf.starts[1:], len(buf.a)), buf.offsets, buf.extras, strict=True):
                wanted.append(near)
                np.add.at(gone, np.clip(start + lo - offset, lo, hi), 1)
                np.add.at(gone, np.clip(end + lo - offset, lo, hi), -1)
            wanted = np.unique(np.concatenate(wanted))
            place = np.flatnonzero(buf.valid & (np.cumsum(gone)[:-1] == 0))
            if not len(place) or not len(wanted):
                continue
            hashes = gram_hashes(buf.a)
            at = anchors(hashes)[place]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(place) != 1) | (np.diff(at) != 0))))
            a, b = place[first], place[np.append(first[1:], len(place)) - 1] + WINDOW
            r, key = range_of(hashes[at[first]], ranges)
            full = (r.astype(U) << U(32)) | key.astype(U)
            hit = wanted[np.minimum(np.searchsorted(wanted, full), len(wanted) - 1)] == full
            order = np.argsort(r[hit], kind="stable")
            a, b, r, key = a[hit][order], b[hit][order], r[hit][order], key[hit][order]
            d = buf.piece[a]
            cut = np.concatenate(([0], np.flatnonzero(np.diff(r)) + 1, [len(r)])) if len(r) else []
            raw, out = buf.a.tobytes(), []
            for x, y in zip(cut, cut[1:], strict=False):
                s = slice(x, y)
                docs = np.stack((buf.ids[d[s]], buf.hashes[d[s]]))
                places = np.stack((a[s] - buf.starts[d[s]] + buf.offsets[d[s]], b[s] - a[s]))
                text = b"".join([raw[p:q] for p, q in zip(a[s].tolist(), b[s].tolist(), strict=True)])
                out.append((int(r[x]), _packed(_blob(docs, "<i8")), _packed(_blob(places, "<u4")), _blob(key[s], "<u4"), _packed(text)))
            yield _batch(AROUND, out)
    return run


def _equal_windows(shard: int):
    """In one key range: the windows that also stand in a document with a smaller id, as runs per document."""
    def run(table: pa.Table) -> pa.Table:
        ids, hashes = np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), "<i8").reshape(2, -1) for x in table["docs"]], axis=1)
        starts, sizes = np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), "<u4").reshape(2, -1) for x in table["places"]], axis=1).astype(np.int64)
        anchor = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table["anchor"]])
        raw = b"".join([zstandard.decompress(x.as_py()) for x in table["bytes"]])
        begin = np.cumsum(sizes) - sizes
        order = np.lexsort((ids, anchor))
        lot = np.cumsum(sizes[order]) // (shard // 2)                      # about half a shard each; one anchor stays together
        new = np.concatenate(([True], anchor[order[1:]] != anchor[order[:-1]]))
        lot = lot[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(lot)) + 1, [len(order)]))
        found = []
        for x, y in zip(cut, cut[1:], strict=False):
            seen: dict[bytes, int] = {}
            pieces, whole = [], []
            for k, i, h, at, p, n in zip(order[x:y].tolist(), *(v[order[x:y]].tolist() for v in (ids, hashes, starts, begin, sizes)), strict=True):
                text = raw[p:p + n]
                if seen.setdefault(text, i) < i:                            # the same bytes stand under a smaller id: all windows go
                    whole.append(k)
                else:
                    pieces.append((i, h, at, text, None))
            buf = Buffer(pieces)
            piece, a, b = buf.spans(buf.flagged())
            found.append((buf.ids[piece], buf.hashes[piece], a, b))
            found.append((ids[whole], hashes[whole], starts[whole], starts[whole] + sizes[whole] - WINDOW + 1))
        cols = [np.concatenate([f[i] for f in found]) for i in range(4)]
        return pa.table(cols, names=["id", "h", "start", "end"])
    return run


def _cleaned(keep_text: bool):
    """Removed bytes, spans and the rest of every document from its text and the runs of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(5)]
            for i, packed, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts", "ends")), strict=True):
                text = zstandard.decompress(packed)
                cover = np.zeros(len(text) + 1, np.int64)
                np.add.at(cover, np.array(starts or [], np.int64), 1)
                np.add.at(cover, np.array(ends or [], np.int64) + WINDOW - 1, -1)
                gone = np.cumsum(cover)[:-1] > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                for c, v in zip(out, (i, len(text), int(gone.sum()), n_spans, kept if keep_text else hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary() if keep_text else pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept" if keep_text else "kept_sha256"])
    return run


def _packed(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([pack.compress(x.as_py()) for x in batch.column(at)], pa.binary()))


def repeated_spans(docs: DataFrame, shard: int = SHARD, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, id, h, text) and the runs (id, h, start, end) of window starts that occur under a smaller id."""
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, round(total * 0.25 / range_bytes))
    keyed = rows.select("id", "h", "text").where(F.octet_length("text") >= WINDOW)
    shared = landed(keyed.mapInArrow(_sort_shards(ranges, shard), SHARED).groupBy("r").applyInArrow(_shared_anchors, SHARED), "suffix-shared")
    per_shard = shared.groupBy("shard").agg(F.collect_list(F.struct("r", "docs", "keys", "ids", "hashes", "spans")).alias("rows")).select("rows")
    per_doc = landed(per_shard.mapInArrow(_per_document, "id long, h long, anchors binary, starts binary, ends binary"), "suffix-documents")
    each = per_doc.groupBy("id", "h").agg(*[F.collect_list(c).alias(c) for c in ("anchors", "starts", "ends")])
    packed = keyed.mapInArrow(_compressed, "id long, h long, text binary")
    texts = packed.join(each, ["id", "h"])
    around = texts.mapInArrow(_around_shared(ranges, shard), AROUND)
    across = around.groupBy("r").applyInArrow(_equal_windows(shard), "id long, h long, start long, end long")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [np.frombuffer(x, "<i8") for x in batch.column("starts").to_pylist()]
            ends = [np.frombuffer(x, "<i8") for x in batch.column("ends").to_pylist()]
            sizes = [len(s) for s in starts]
            flat = lambda v: np.concatenate([np.zeros(0, np.int64), *v])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(c).to_numpy(), sizes)) for c in ("id", "h")] + [pa.array(flat(starts)), pa.array(flat(ends))],
                                             names=["id", "h", "start", "end"])

    inside = per_doc.mapInArrow(unpack, "id long, h long, start long, end long")
    return rows, landed(across.unionByName(inside), "suffix-runs")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, shard: int = SHARD,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256 (or the kept bytes)."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, runs = repeated_spans(plain, shard, range_bytes)
    listed = runs.distinct().groupBy("id", "h").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    packed = rows.mapInArrow(_compressed, "doc_id long, id long, text binary, h long")
    last = "kept binary" if keep_text else "kept_sha256 string"
    return (packed.join(listed, ["id", "h"], "left").select("doc_id", "text", "starts", "ends")
            .mapInArrow(_cleaned(keep_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}"))
