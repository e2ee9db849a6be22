"""WARC archives: a writer with revisit records and a sequential reader.

Writing.  Payloads are told apart by digests made in Spark; the smallest page
of each group of equal ones is written as a response, the others as revisits
without a payload.  Every task writes its records, one gzip member each, to
files of its own under new names and hands back their names; the table of
names is written by Spark, so a file of a lost or repeated task is in no table
and is never read.

Reading.  A file is read from front to back in small pieces: a decompressor per
member gives bounded output, the record's header is parsed, its block is taken
by Content-Length and hashed on the way, and both digests are compared at the
end.  A damaged member becomes a row that says so, and reading goes on at the
next member that holds a record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .lookup import looked_up
from .tables import batch_of, cut_batches, utf8_bytes, written

PIECE = 1 << 16          # bytes read, and bytes decompressed, at a time
ARCHIVE_BYTES = 1 << 30  # a file is closed once it is that large
LONGEST_HEADER = 1 << 20
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file that all executors share."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(uri).path)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(record_id: Column) -> Column:
    """The page_id in a record id of this writer, else null."""
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> list[bytes]:
    """The parts of one record: a response, or a revisit of ``refers_to``,
    which keeps the HTTP header but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    block = [http] if refers_to is not None else [http, payload]
    whole = hashlib.sha1()
    for part in block:
        whole.update(part)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {date}"]
    if url:  # no control character may end the field
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{b32(hashlib.sha1(payload).digest())}",
             f"WARC-Block-Digest: sha1:{b32(whole.digest())}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {sum(map(len, block))}"]
    return ["\r\n".join(head).encode() + END, *block, END]


def first_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, first): first is the smallest page_id with an equal
    payload where another page has one of at least ``min_bytes`` bytes, else
    null.  Null html is an empty payload."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("_sha"),
                         F.xxhash64(html).alias("_mix"))
    groups = (keyed.where(utf8_bytes(F.col("html")) >= min_bytes).groupBy("_sha", "_mix")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    groups = written(groups, "warc-groups")
    total = groups.agg(F.sum("_n")).first()[0] or 0
    return looked_up(keyed, groups, ["_sha", "_mix"], "_n", total).select("page_id", "url", "html", "first")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) to gzip files
    in ``folder`` and return the table of those that count: archive, records,
    bytes.  ``folder`` must be on a file system that every executor reaches
    (local or mounted, or one that pyarrow opens by its URI).

    Null html is an empty payload; a null or empty url leaves the target out; a
    null page_id is written as 'none', is no group's first unless all its ids
    are null, and then all of the group are responses, as are rows that repeat
    the first page's id.  Very long payloads are written in pieces, one record
    at a time.  An empty table gives no file; other columns, whatever their
    names, are ignored."""
    schema = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        out = name = None
        count, done = 0, []
        for part in cut_batches(batches, "html"):
            for page_id, url, html, first in zip(*(part.column(c) for c in ("page_id", "url", "html", "first")),
                                                 strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                page, first = page_id.as_py(), first.as_py()
                refers = first if first is not None and first != page else None
                gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                for piece in record(page, url.as_py(), html.as_buffer().to_pybytes(), refers, date):
                    out.write(gz.compress(piece))
                out.write(gz.flush())
                count += 1
                if out.tell() >= archive_bytes:
                    done.append((f"{folder}/{name}", count, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((f"{folder}/{name}", count, out.tell()))
            out.close()
        if done:
            yield batch_of(schema, [list(c) for c in zip(*done, strict=True)])

    rows = first_pages(pages, min_bytes)
    return written(rows.mapInArrow(run, "archive string, records long, bytes long"), "warc-archives")


class Framer:
    """One record, fed with the pieces of its member."""

    def __init__(self, keep: bool):
        self.head, self.fields, self.left, self.tail = b"", None, 0, b""
        self.http, self.in_http, self.size = b"", False, 0
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.kept: list[bytes] | None = [] if keep else None

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            at = self.head.find(END)
            if at < 0:
                if len(self.head) > LONGEST_HEADER:
                    raise ValueError("no end of the record's header")
                return
            data = self.head[at + 4:]
            lines = self.head[:at].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("no WARC record")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            length = self.fields.get("content-length", "")
            if not length.isdecimal():
                raise ValueError("no Content-Length")
            self.left = int(length)
            self.in_http = self.fields.get("content-type", "").lower().startswith("application/http")
        if self.left:
            part, data = data[:self.left], data[self.left:]
            self.left -= len(part)
            self.block.update(part)
            self._payload(part)
        self.tail = (self.tail + data)[:5]

    def _payload(self, part: bytes) -> None:
        if self.in_http:
            self.http += part
            at = self.http.find(END)
            if at < 0:
                return
            part, self.http, self.in_http = self.http[at + 4:], self.http[:at], False
        self.payload.update(part)
        self.size += len(part)
        if self.kept is not None and part:
            self.kept.append(part)

    def row(self) -> dict:
        """What the record says, and in ``problem`` what does not hold."""
        if self.fields is None:
            raise ValueError("no WARC record")
        f, problem = self.fields, None
        said = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", self.http)
        kind, digest = f.get("warc-type"), f.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size, block = self.size, f.get("warc-block-digest")
        if self.left or self.tail != END:
            problem = "the block is not as long as Content-Length says"
        elif block is not None and block != f"sha1:{b32(self.block.digest())}":
            problem = "the block's digest differs"
        elif kind == "revisit":
            size = int(said[1]) if said else None
        elif digest is not None and digest != b32(self.payload.digest()):
            problem = "the payload's digest differs"
        elif said and int(said[1]) != size:
            problem = "the payload's length differs"
        return {"record_id": f.get("warc-record-id"), "record_type": kind, "target": f.get("warc-target-uri"),
                "refers_to": f.get("warc-refers-to"), "payload_bytes": size, "payload_digest": digest,
                "problem": problem, "payload": None if self.kept is None else b"".join(self.kept)}


def _member(f, framer: Framer) -> int:
    """Feed one gzip member, from the file's place on; returns its size."""
    gz, data, used = zlib.decompressobj(31), b"", 0
    full = False
    while not gz.eof:
        if not data and not full:
            data = f.read(PIECE)
            if not data:
                raise ValueError("the member is cut off")
            used += len(data)
        out = gz.decompress(data, PIECE)
        full, data = len(out) == PIECE, gz.unconsumed_tail
        framer.feed(out)
    return used - len(gz.unused_data)


def _next_record(f, at: int) -> int | None:
    """Where the next member that holds a record starts, from ``at`` on."""
    while True:
        f.seek(at)
        piece = f.read(PIECE)
        hit = piece.find(MAGIC)
        if hit < 0:
            if len(piece) < PIECE:
                return None
            at += PIECE - len(MAGIC) + 1
            continue
        at += hit
        f.seek(at)
        try:
            if zlib.decompressobj(31).decompress(f.read(PIECE), 5) == b"WARC/":
                return at
        except zlib.error:
            pass
        at += 1


def records(f, keep: bool = False) -> Iterator[dict]:
    """The records of an open archive, in order, each with its ``offset``."""
    at: int | None = 0
    size = f.size()
    while at is not None and at < size:
        f.seek(at)
        framer = Framer(keep)
        try:
            end = at + _member(f, framer)
            yield {"offset": at, **framer.row()}
            at = end
        except (zlib.error, ValueError) as e:
            yield {"offset": at, "problem": str(e)}
            at = _next_record(f, at + 1)


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the files named in ``archives.archive``: archive,
    offset, record_id, record_type, target, refers_to, payload_bytes,
    payload_digest (bare base32 SHA-1), problem (null if the framing, both
    digests and the length hold) and, if asked for, the payload.

    A file is read by one task in pieces of bounded size; only a payload asked
    for is held whole, one at a time.  A null name is passed over, a name given
    twice is read twice, a file without content gives no rows, and so does an
    empty table; other columns are ignored."""
    text = pa.string()
    fields = [("archive", text), ("offset", pa.int64()), ("record_id", text), ("record_type", text), ("target", text),
              ("refers_to", text), ("payload_bytes", pa.int64()), ("payload_digest", text), ("problem", text)]
    if with_payload:
        fields.append(("payload", pa.binary()))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = file_system(name)
                with fs.open_input_file(path) as f:
                    held, size = [], 0
                    for row in records(f, with_payload):
                        held.append({"archive": name, **row})
                        size += 1000 + len(row.get("payload") or b"")
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    names = archives.where("archive is not null").select("archive")
    ddl = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary' if f.name == 'payload' else 'string'}"
                    for f in schema)
    return names.repartition(max(1, names.count())).mapInArrow(run, ddl)


def broken_revisits(read: DataFrame) -> DataFrame:
    """Revisits whose response is absent or of another digest or length:
    (refers_to, payload_digest, payload_bytes, n), counted before the join."""
    same = ["payload_digest", "payload_bytes"]
    asked = read.where("record_type = 'revisit'").groupBy("refers_to", *same).agg(F.count(F.lit(1)).alias("n"))
    there = read.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), *same)
    return asked.join(there, ["refers_to", *same], "left_anti")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and
    return per record: page_id, payload_bytes, payload_digest, record_type and
    refers_to (a page_id).  Ends with an error if a record does not read as it
    was written, if one is missing, or if a revisit's response does not fit."""
    spark = pages.sparkSession
    archives = write_archives(pages, f"{checkpoint_dir(spark)}/quarry-warc-{uuid.uuid4().hex}", min_bytes)
    read = written(read_archives(archives), "warc-records")
    said = archives.agg(F.sum("records")).first()[0] or 0
    seen = read.agg(F.count(F.lit(1)).alias("n"), F.count("problem").alias("bad"), F.min("problem").alias("p")).first()
    if seen.bad or seen.n != said or broken_revisits(read).head(1):
        raise ValueError(f"{seen.n} of {said} records read, {seen.bad} damaged ({seen.p})")
    return read.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page_of(F.col("refers_to")).alias("refers_to"))


# The round trip's rows, for DuckDB.
DIGEST_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
d AS (SELECT page_id, strlen(x)::BIGINT AS payload_bytes, sha1(x) AS h, min(page_id) OVER (PARTITION BY x) AS first
      FROM p)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) % 32 + 1), 1)
           for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""
