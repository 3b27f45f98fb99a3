"""WARC archives with a two-level capture index.

Writing: every partition writes its records, one gzip member each, to archive files of its own below a shared folder and
returns where each record went. Of equal payloads of `LEAST` bytes or more the one with the smallest page id is written
as response; the others become revisit records without payload that refer to it.

Index: the captures are sorted by reversed-host URL key; each range of keys becomes one index file of compressed blocks
of sorted lines, and a sparse directory holds the first key, place and size of every block. A lookup finds the index
files whose range may hold its key (a binary search in a list with one entry per file), then the blocks in that file's
part of the directory, and then the lines in a block, each by binary search; only the blocks found are read, by range.
Records are fetched by range reads in the order they lie in the archives.

File names are new for every task attempt, so a repeated task never touches what another wrote; places are taken from
written tables only. A url or payload that a third of all rows carry is spread: sort keys end in the place of the record,
and counts are combined before the shuffle.

Defined results: null html is an empty payload; null url has the empty key; null page ids sort last and stay null; of
repeated rows with the smallest page id each is a response. Empty tables write nothing and give an empty result.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.ordering import fresh_path, shared_folder
from lumenframe.llm.common import landed

LEAST = 100
LEVEL = 4
FILE_BYTES = 1 << 30
BLOCK_LINES = 512
SPAN = 16 << 20                     # bytes of an archive that one reading task takes
GAP = 64 << 10                      # unread bytes between two records that are still read in one go
DATE = "2020-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
CAPTURE = "key string, page_id long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Sort key with the host reversed: http://www.example.com:80/a?b gives com,example,www)/a?b."""
    try:
        u = urlsplit((url or "").strip())
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip()
    back = ",".join(reversed(host.split(".")))
    port_text = f":{port}" if port and port not in (80, 443) else ""
    return f"{back}{port_text}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def _line(url: str | None) -> str:
    return quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; with refers_to a revisit, which holds the HTTP headers only."""
    block = _HTTP.format(len(payload)).encode() + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse_record(member: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of one gzip member; checks the digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-Id"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": number("X-Refers-To-Page"), "payload": payload if fields["WARC-Type"] == "response" else None}


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder)


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, digest and refers_to: the page id of the response where a page is a revisit."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    repeated = (rows.where(F.octet_length("payload") >= least).groupBy("digest")
                .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"))
    marked = rows.join(landed(repeated.select("digest", "first"), "warc-repeated"), "digest", "left")
    return marked.select("page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archives(plan: DataFrame, folder: str, level: int = LEVEL, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Writes all records below the folder; gives one row per record (key, page_id, file, offset, length)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    member = gzip_member(record_bytes(page_id, url, payload, digest, refers_to, date), level)
                    out.write(member)
                    rows.append((url_key(url), page_id, name, at, len(member)))
                    at += len(member)
                    if at >= file_bytes:
                        out.close()
                        out = None
                cols = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                                 names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return landed(plan.mapInArrow(write, CAPTURE), "warc-captures")


@dataclass(frozen=True)
class Index:
    """Folder of the index files and the sparse directory: one row per block (file, first_key, last_key, offset, length)."""
    folder: str
    directory: DataFrame

    def files(self) -> list[tuple[str, str, str]]:
        """First and last key and name of every index file, in order; one entry per file, whatever the number of captures."""
        rows = self.directory.groupBy("file").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect()
        return sorted((r.a, r.b, r.file) for r in rows)


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> Index:
    """Sorted captures as compressed blocks, with their directory."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        name, out, at, lines, rows = f"part-{uuid.uuid4().hex}.cdx.gz", None, 0, [], []

        def flush():
            nonlocal out, at, lines
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            data = gzip_member("\n".join(f"{quote(k, safe=_PLAIN)} {'' if p is None else p} {f} {o} {n}" for k, p, f, o, n in lines).encode(), 6)
            out.write(data)
            rows.append((name, lines[0][0], lines[-1][0], at, len(data)))
            at, lines = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines.append(row)
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "first_key", "last_key", "offset", "length"])

    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    directory = landed(ordered.mapInArrow(write, "file string, first_key string, last_key string, offset long, length long"), "warc-directory")
    return Index(folder, directory)


_PLAIN = "/:=&?~#+!$,;'@()*[]"


def _block_lines(data: bytes) -> tuple[list[bytes], list[list[str]]]:
    from urllib.parse import unquote

    rows = [x.split(" ") for x in zlib.decompress(data, 31).decode().split("\n")]
    return [_utf8(unquote(r[0])) for r in rows], rows


def find_captures(index: Index, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """All captures (key, page_id, file, offset, length) of the distinct keys given."""
    files, folder = index.files(), index.folder
    order = sorted(files, key=lambda x: _utf8(x[0]))
    firsts, lasts, names = [_utf8(f[0]) for f in order], [_utf8(f[1]) for f in order], [f[2] for f in order]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, names[i]) for k in batch.column(0).to_pylist()
                     for i in range(bisect_left(lasts, _utf8(k)), bisect_right(firsts, _utf8(k)))]
            yield pa.RecordBatch.from_pydict({"key": pa.array([x[0] for x in found], pa.string()), "file": pa.array([x[1] for x in found], pa.string())})

    def look(asked: pa.Table, directory: pa.Table) -> pa.Table:
        entries = sorted(zip(*(directory[c].to_pylist() for c in ("offset", "length", "first_key", "last_key")), strict=True))
        first, last = [_utf8(e[2]) for e in entries], [_utf8(e[3]) for e in entries]
        store, base = _open(folder)
        out = [[] for _ in range(5)]
        if asked.num_rows and entries:
            held, lines, rows = -1, [], []
            with store.open_input_file(f"{base}/{asked['file'][0].as_py()}") as src:
                for key in sorted(asked["key"].to_pylist(), key=_utf8):
                    raw = _utf8(key)
                    for b in range(bisect_left(last, raw), bisect_right(first, raw)):
                        if b != held:
                            src.seek(entries[b][0])
                            held, (lines, rows) = b, _block_lines(src.read(entries[b][1]))
                        for r in rows[bisect_left(lines, raw):bisect_right(lines, raw)]:
                            for c, v in zip(out, (key, int(r[1]) if r[1] else None, r[2], int(r[3]), int(r[4])), strict=True):
                                c.append(v)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["key", "page_id", "file", "offset", "length"])

    asked = keys.select(F.col(key_col).alias("key")).distinct().mapInArrow(route, "key string, file string")
    return asked.groupBy("file").cogroup(index.directory.groupBy("file")).applyInArrow(look, CAPTURE)


def read_records(captures: DataFrame, folder: str, payload: bool = False, span: int = SPAN) -> DataFrame:
    """The records at the given places: page_id, payload_bytes, payload_digest, record_type, refers_to (and payload)."""
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    kinds |= {"payload": pa.binary()} if payload else {}

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        src, name = None, None

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], names=list(kinds))

        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(places):
                file, begin, size = places[at]
                end, stop = at + 1, begin + size
                while end < len(places) and places[end][0] == file and places[end][1] - stop <= GAP and places[end][1] + places[end][2] - begin <= 8 << 20:
                    stop = max(stop, places[end][1] + places[end][2])
                    end += 1
                if file != name:
                    if src is not None:
                        src.close()
                    src, name = store.open_input_file(f"{base}/{file}"), file
                src.seek(begin)
                data = src.read(stop - begin)
                yield batch_of([parse_record(data[o - begin:o - begin + n]) for _, o, n in places[at:end]])
                at = end
        if src is not None:
            src.close()

    places = landed(captures.select("file", "offset", "length"), "warc-places")
    size = places.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(-(-size // span), captures.sparkSession.sparkContext.defaultParallelism)       # by what is read, not by the size of the places
    laid = places.repartition(parts, "file", F.floor(F.col("offset") / span)).sortWithinPartitions("file", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payload else "")
    return laid.mapInArrow(fetch, schema)


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> tuple[DataFrame, Index, str]:
    """Captures, index and archive folder after all pages were written."""
    spark = pages.sparkSession
    shared_folder(spark)
    folder = folder or fresh_path(spark, "warc")
    captures = write_archives(planned(pages, least), f"{folder}/archive")
    return captures, write_index(captures, f"{folder}/index"), f"{folder}/archive"


def url_keys(pages: DataFrame) -> DataFrame:
    """(key): the sort keys of the urls of some pages."""
    @F.pandas_udf("string")
    def key(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: url_key(None if pd.isna(u) else u))

    return pages.select(key("url").alias("key"))
