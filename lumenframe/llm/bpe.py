"""BPE encoding and decoding with a public vocabulary; long texts by tree concatenation.

Texts up to `LEAF` characters go to the tokenizers library as they are. A longer text is halved again and again until
the parts are leaves; all leaves of all texts are encoded in parallel, and then joined pairwise up the tree. At a join
the two sides may be wrong near the cut, so a window around it is encoded anew and grows until it agrees exactly with
both sides; tokens left of the left agreement and right of the right one stay.

Agreement is a token with the same id and the same clean character span on both sides that either starts a pre-token
in both (the splitter reads from left to right, so what follows is the same), or lies, in both, in the one pre-token
that runs across the edge of the window (byte-pair merges are fixed by neighbouring pairs: two correct encodings that
share a token can be glued at it). If nothing agrees, the window ends up as the whole of both sides, so the result is
always that of the library on the whole text.

Texts of letters up to U+017F go word by word when the vocabulary file has the splitter whose rules `SPLIT` states: the
library encodes every new word once, and a worker keeps the last words. All other texts go to the library whole.

Defined results: null text counts as empty and has no tokens. Special tokens in a text are found as the library finds
them; no cut falls into one. Repeated rows each get their own result. Extra columns pass through.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import extended, landed

LEAF = 65_536
WINDOW = 64
BATCH_CHARS = 1 << 18
CACHED_WORDS = 100_000
KINDS = {"token_ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
_LOADED: dict[object, object] = {}


def read_vocabulary(path: str) -> str:
    """The tokenizer file as text; it is a fixed small file and goes to the tasks as a broadcast value."""
    return Path(path).read_text(encoding="utf-8")


def tokenizer_of(spec: str):
    """The library's tokenizer, without truncation and padding; made once per worker."""
    if spec not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)
        tok.no_truncation()
        tok.no_padding()
        _LOADED[spec] = tok
    return _LOADED[spec]


#: The normaliser and splitter of the word-level vocabulary file.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters for which NFC changes nothing and lower case is one character in the same range.
SIMPLE = "\x00-\u012f\u0131-\u017f"


class Words:
    """Encodings of words as decimal ids and as decoded text, both joined by blanks."""

    def __init__(self, tok, spec: str):
        form = json.loads(spec)
        pre = form.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [{}])[0]
        self.usable = ((form.get("normalizer") or {}).get("normalizers") == NORMALIZERS and len(pre.get("pretokenizers") or []) == 2
                       and first.get("pattern") == {"Regex": SPLIT} and first.get("invert") and first.get("behavior") == "Removed"
                       and form["model"].get("end_of_word_suffix") == "</w>" and form.get("decoder") is None and form.get("post_processor") is None)
        letters, numbers = ("".join(chr(c) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
        self.split = re.compile(f"'(?:[stmd]|re|ve|ll)|[{letters}]+|[{numbers}]|[^\\t-\\r \x85\xa0{letters}{numbers}]+")
        self.other = re.compile("|".join([f"[^{SIMPLE}]", *map(re.escape, special_strings(tok))]))
        self.tok, self.held = tok, {}
        self.tokens = {i: t for t, i in tok.get_vocab().items()} if self.usable else {}

    def of(self, text: str) -> list[str] | None:
        """The words of a simple text, None for any other."""
        return None if not self.usable or self.other.search(text) else self.split.findall(text.lower())

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.held]
        if len(self.held) + len(new) > CACHED_WORDS:
            self.held, new = {}, list(words)
        for at in range(0, len(new), 500):
            part = new[at:at + 500]
            ids: list[int] = []
            done = []
            for i in self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids:
                ids.append(i)
                if self.tokens[i].endswith("</w>"):
                    done.append((" ".join(map(str, ids)), " ".join(self.tokens[j] for j in ids)))
                    ids = []
            self.held.update(zip(part, done, strict=True))


def words_of(spec: str) -> Words:
    if ("words", spec) not in _LOADED:
        _LOADED["words", spec] = Words(tokenizer_of(spec), spec)
    return _LOADED["words", spec]


def encode_texts(spec: str, texts: list[str], want: Sequence[str]) -> list[pa.Array]:
    """The wanted columns of some texts."""
    tok, words = tokenizer_of(spec), words_of(spec)
    split = [words.of(t) for t in texts]
    words.learn({w for s in split if s for w in s})
    rest = [i for i, s in enumerate(split) if s is None]
    slow = dict(zip(rest, tok.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True)) if rest else {}
    held, decode = words.held, any(w.startswith("decoded") for w in want)
    numbers, decoded = [], []
    for i, s in enumerate(split):
        if s is None:
            ids = slow[i].ids
            numbers.append(" ".join(map(str, ids)))
            decoded.append(tok.decode(ids, skip_special_tokens=False) if decode else "")
        else:
            pairs = [held[w] for w in s]
            numbers.append(" ".join([p[0] for p in pairs]))
            decoded.append(" ".join([p[1] for p in pairs]) if decode else "")
    return _columns(numbers, decoded, want)


@dataclass
class Part:
    """Tokens of text[lo:hi]: ids, character spans in the text, and the number of the pre-token each belongs to."""
    lo: int
    hi: int
    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray

    def clean(self) -> np.ndarray:
        """Tokens whose borders are character borders shared with no other token."""
        n = len(self.ids)
        ok = np.ones(n, bool)
        if n > 1:
            ok[1:] &= self.end[:-1] <= self.start[1:]
            ok[:-1] &= self.start[1:] >= self.end[:-1]
        return ok

    def first_of_word(self) -> np.ndarray:
        return np.concatenate(([True], self.word[1:] != self.word[:-1])) if len(self.ids) else np.zeros(0, bool)


def encode_span(tok, text: str, lo: int, hi: int) -> Part:
    e = tok.encode(text[lo:hi], add_special_tokens=False)
    spans = np.array(e.offsets, np.int64).reshape(-1, 2) + lo
    word, last, number = np.zeros(len(e.ids), np.int64), object(), -1
    for i, w in enumerate(e.word_ids):
        if w is None or w != last:
            number += 1
        last = w if w is not None else object()
        word[i] = number
    return Part(lo, hi, np.array(e.ids, np.int64), spans[:, 0], spans[:, 1], word)


def _agreement(side: Part, window: Part, edge: int, left: bool) -> tuple[int, int] | None:
    """Indexes in side and window of a token that both have for certain: the first one for the left side, the last
    one for the right side. `edge` is where the one of the two that was cut there begins (left: the window, right: the side)."""
    where = {(int(s), int(e), int(i)): k for k, (s, e, i, ok) in enumerate(zip(side.start, side.end, side.ids, side.clean(), strict=True))
             if ok and s >= window.lo and e <= window.hi}
    firsts, window_firsts = side.first_of_word(), window.first_of_word()
    cut, whole = (window, side) if left else (side, window)
    run = None
    if len(cut.ids) and len(whole.ids):             # the pre-token of `whole` that runs across the edge, if there is one
        at = int(np.searchsorted(whole.start, edge, side="right")) - 1
        if at >= 0 and whole.start[whole.word == whole.word[at]].min() < edge < whole.end[whole.word == whole.word[at]].max() and cut.start[0] == edge:
            run = (whole.word[at], cut.word[0])
    order = range(len(window.ids)) if left else range(len(window.ids) - 1, -1, -1)
    ok = window.clean()
    for k in order:
        j = where.get((int(window.start[k]), int(window.end[k]), int(window.ids[k]))) if ok[k] else None
        if j is None:
            continue
        inside = run is not None and ((side.word[j], window.word[k]) if left else (window.word[k], side.word[j])) == run
        starts = firsts[j] and window_firsts[k] and window.start[k] > edge
        last_of_side = left and j + 1 == len(side.ids)              # the end of the left side is the cut itself
        last_of_window = not left and k + 1 == len(window.ids) and window.hi < side.hi
        if (starts or inside and window.start[k] > edge) and not last_of_side and not last_of_window:
            return j, k
    return None


def join(tok, text: str, left: Part, right: Part, first: int = WINDOW) -> Part:
    """Tokens of text[left.lo:right.hi] from those of its two halves."""
    mid, width = left.hi, first
    while True:
        lo, hi = max(left.lo, mid - width), min(right.hi, mid + width)
        window = encode_span(tok, text, lo, hi)
        a = (0, 0) if lo == left.lo else _agreement(left, window, lo, True)
        b = (len(right.ids), len(window.ids)) if hi == right.hi else _agreement(right, window, mid, False)
        if a is not None and b is not None and a[1] <= b[1]:
            break
        width *= 2
    take = lambda f: np.concatenate((getattr(left, f)[:a[0]], getattr(window, f)[a[1]:b[1]], getattr(right, f)[b[0]:]))
    start = take("start")
    fresh = np.concatenate((left.first_of_word()[:a[0]], window.first_of_word()[a[1]:b[1]], right.first_of_word()[b[0]:]))
    if a[0] and a[1] < len(window.ids):
        fresh[a[0]] = left.first_of_word()[a[0]] if a[0] < len(left.ids) else fresh[a[0]]
    at = a[0] + b[1] - a[1]
    if b[0] < len(right.ids) and b[1] < len(window.ids):
        fresh[at] = window.first_of_word()[b[1]]
    return Part(left.lo, right.hi, take("ids"), start, take("end"), np.cumsum(fresh))


def _safe(text: str, at: int, specials: Sequence[str]) -> bool:
    """Nothing at this place composes across the cut, and no special token lies over it."""
    a, b = text[max(0, at - 8):at], text[at:at + 8]
    if unicodedata.normalize("NFC", a + b) != unicodedata.normalize("NFC", a) + unicodedata.normalize("NFC", b):
        return False
    for s in specials:
        found = text.find(s, max(0, at - len(s) + 1), at + len(s) - 1)
        if found >= 0 and found < at < found + len(s):
            return False
    return not unicodedata.combining(text[at])


def cuts(text: str, leaf: int, specials: Sequence[str], lo: int = 0, hi: int | None = None) -> list[int]:
    """Borders of the leaves in order: halves, cut after white space where there is some near the middle."""
    hi = len(text) if hi is None else hi
    if hi - lo <= leaf:
        return [lo]
    mid, reach = (lo + hi) // 2, min(256, (hi - lo) // 4)
    near = sorted(range(mid - reach, mid + reach), key=lambda p: abs(p - mid))
    at = next((p for p in near if text[p - 1].isspace() and _safe(text, p, specials)), None)
    at = at or next((p for p in range(mid, hi - 1) if _safe(text, p, specials)), None)
    return cuts(text, leaf, specials, lo, at) + cuts(text, leaf, specials, at, hi) if at else [lo]


def join_all(tok, text: str, parts: list[Part]) -> Part:
    """Neighbours joined pairwise, level by level."""
    while len(parts) > 1:
        pairs = [join(tok, text, parts[i], parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(pairs) * 2:]
    return parts[0]


def encode_tree(tok, text: str, leaf: int = LEAF, specials: Sequence[str] = ()) -> list[int]:
    """The whole tree for one text in one place; the Spark job does the same with its leaves spread over tasks."""
    at = [*cuts(text, leaf, specials), len(text)]
    return join_all(tok, text, [encode_span(tok, text, a, b) for a, b in zip(at, at[1:], strict=False)]).ids.tolist()


def special_strings(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def _columns(numbers: list[str], decoded: list[str], want: Sequence[str]) -> list[pa.Array]:
    """From ids as decimal text and decoded texts."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

    def ids():
        parts = [np.array(n.split(), np.int32) for n in numbers]
        ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))

    make = {"token_ids": ids, "n_tokens": lambda: pa.array([n.count(" ") + 1 if n else 0 for n in numbers], pa.int64()),
            "ids_sha256": lambda: pa.array(map(sha, numbers), pa.string()),
            "decoded": lambda: pa.array(decoded, pa.string()), "decoded_sha256": lambda: pa.array(map(sha, decoded), pa.string())}
    return [make[w]() for w in want]


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                     want: Sequence[str] = ("token_ids", "n_tokens"), leaf: int = LEAF) -> DataFrame:
    """Columns `keep` of every document with the wanted of token_ids, n_tokens, ids_sha256, decoded, decoded_sha256."""
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    kept, fields = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], [docs.schema[c] for c in keep]
    rows = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    is_long = F.length("text") > leaf
    types = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)]
    out = ", ".join([*types, *(f"{w} {KINDS[w]}" for w in want)])

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            sizes = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            while at < len(sizes):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_CHARS)))
                part = batch.slice(at, n)
                found = encode_texts(spec.value, part.column("text").to_pylist(), want)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], names=[*part.schema.names[:-1], *want])
                at += n

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = special_strings(tokenizer_of(spec.value))
        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist(), strict=True):
                at = [*cuts(text, leaf, specials), len(text)]
                yield pa.RecordBatch.from_pydict({"uid": pa.array([uid] * (len(at) - 1), pa.int64()), "lo": pa.array(at[:-1], pa.int64()),
                                                  "text": [text[a:b] for a, b in zip(at, at[1:], strict=False)]})

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of(spec.value)
        for batch in batches:
            parts = [encode_span(tok, t, 0, len(t)) for t in batch.column("text").to_pylist()]
            packed = {c: pa.array([getattr(p, c).astype("<i4").tobytes() for p in parts], pa.binary()) for c in ("ids", "start", "end", "word")}
            yield pa.RecordBatch.from_arrays([*batch.columns, *packed.values()], names=[*batch.schema.names, *packed])

    def join_leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        tok, pdf = tokenizer_of(spec.value), pdf.sort_values("lo")
        text, parts = "".join(pdf["text"]), []
        for r in pdf.itertuples():
            ids, start, end, word = (np.frombuffer(x, "<i4").astype(np.int64) for x in (r.ids, r.start, r.end, r.word))
            parts.append(Part(r.lo, r.lo + len(r.text), ids, start + r.lo, end + r.lo, word))
        ids = join_all(tok, text, parts).ids.tolist()
        cols = _columns([" ".join(map(str, ids))], [tok.decode(ids, skip_special_tokens=False)], want)
        return pd.DataFrame({"uid": [pdf["uid"].iloc[0]], **{w: [c.to_pylist()[0]] for w, c in zip(want, cols, strict=True)}})

    short = rows.where(~is_long).mapInArrow(direct, out)
    long = landed(rows.where(is_long).withColumn("uid", F.monotonically_increasing_id()), "bpe-long")
    leaf_rows = long.select("uid", "text").mapInArrow(leaves, "uid long, lo long, text string")
    done = (leaf_rows.repartition("uid", "lo").mapInArrow(encode_leaves, "uid long, lo long, text string, ids binary, start binary, end binary, word binary")
            .groupBy("uid").applyInPandas(join_leaves, ", ".join(["uid long", *(f"{w} {KINDS[w]}" for w in want)])))
    whole = short.unionByName(long.drop("text").join(done, "uid").select(short.columns))
    return whole.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *want)


def decode_documents(rows: DataFrame, vocabulary: str, ids_col: str = "token_ids", name: str = "decoded") -> DataFrame:
    """All columns with the decoded text; null ids give the empty text."""
    spec = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    fields = [c for c in rows.columns if c != name]
    at = fields.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer_of(spec.value)
        for batch in batches:
            text = tok.decode_batch([x or [] for x in batch.column(at).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, name])

    plain = rows.select(*fields)
    return plain.mapInArrow(decode, extended(plain, **{name: "string"}))
