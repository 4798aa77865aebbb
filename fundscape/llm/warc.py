"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

``write_archives`` writes one record per row, gzip members one after another, in archives
of bounded size. ``read_archives`` reads each archive as a stream: every record must pass
its checks (gzip checksum, version line, header fields, length, closing blank lines,
block and payload digests). Where one fails, the reader looks for the next place at which
a member or a version line begins and a whole valid record follows, goes on from there,
and logs the bytes between as a quarantined gap with the reason. Headers, and so urls, may
be of any length. Ids are percent-encoded in their fields, so that any text comes back; an url with other
than visible ASCII characters is encoded in its field and kept whole, encoded, in one of its own.

Of rows with equal payloads (compared by SHA-256 and length) of at least ``min_revisit``
bytes, those with the smallest id are ``response`` and the others ``revisit``; the latter
carry the headers and digest but no payload. The writer keeps its work in memory for one
record, the reader for one record and one chunk: before it reads a long record, it looks at
the place where that must end, so a damaged length costs nothing.

Nulls: a null payload is empty; a null url is an empty field; null ids take part as a
revisit of the smallest id there is, or stay responses where there is none; repeated rows
with the smallest id are all responses. Other columns are ignored. An empty table makes no archive and no rows."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.llm.common import open_file, stored, write_file

VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"  # records made from tables have no fetch time; a fixed one keeps reruns alike
CHUNK = 1 << 20
END = b"\r\n\r\n"
PAYLOAD_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = re.compile(rb"\x1f\x8b\x08")
LINE = re.compile(rb"WARC/1\.[01]\r\n")


# Characters an url keeps as they are; ids keep all of them but the percent sign.
VISIBLE = "".join(map(chr, range(0x21, 0x7F)))


def encoded(text: str) -> str:
    return quote(text, VISIBLE.replace("%", ""))


def decoded(text: str | None) -> str | None:
    return None if text is None else unquote(text)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: str | None, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record's bytes. ``refers_to`` makes it a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, VISIBLE)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if quote(url, VISIBLE) != url:
        fields.append(("WARC-Source-URL", encoded(url)))
    if page_id is not None:
        fields.append(("WARC-Source-ID", encoded(page_id)))
    if refers_to is not None:
        fields.append(("WARC-Profile", PAYLOAD_PROFILE))
        fields.append(("WARC-Refers-To", f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}').urn}>"))
        fields.append(("WARC-Refers-To-Source-ID", encoded(refers_to)))
    fields.append(("Content-Length", str(len(block))))
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + END


def compress(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
    min_revisit: int = 0, archive_bytes: int = 64 << 20, gzip: bool = True,
) -> DataFrame:
    """Write all rows; returns the manifest: file, bytes, records."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"), body.alias("payload")
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    first = rows.groupBy("key").agg(F.min("id").alias("first"))
    revisits = (F.octet_length("payload") >= min_revisit) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.join(first, "key").select(
        F.col("id").cast("string").alias("id"), "url", "payload",
        F.when(revisits, F.col("first").cast("string")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = (
            tuple(c[i].as_py() for c in (b.column("id"), b.column("url"), b.column("payload"), b.column("refers_to")))
            for b in batches
            for i in range(b.num_rows)
        )
        last = next(source, None)
        while last is not None:
            count = 0

            def members() -> Iterator[bytes]:
                nonlocal last, count
                size = 0
                while last is not None and size < archive_bytes:
                    data = record(*last)
                    data = compress(data) if gzip else data
                    size, count = size + len(data), count + 1
                    last = next(source, None)
                    yield data

            name = f"{uuid.uuid4().hex}.warc{'.gz' if gzip else ''}"
            size = write_file(f"{path}/{name}", members())
            yield pa.record_batch([pa.array([name]), pa.array([size]), pa.array([count])], names=["file", "bytes", "records"])

    made = rows.mapInArrow(write, "file string, bytes long, records long")
    return stored(made, f"{path}/manifest")


# -- salvage reader ------------------------------------------------------------------


class Damaged(Exception):
    """A record failed a check."""


class Short(Exception):
    """More bytes are needed to decide."""


class Window:
    """A file seen through a buffer that starts at ``at`` and grows on demand."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.at, self.data, self.ended = read, 0, bytearray(), False

    def more(self) -> bool:
        got = self.read(CHUNK)
        self.data += got
        self.ended = not got
        return bool(got)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.at += n


def url(fields: dict[str, str]) -> str | None:
    kept = fields.get("warc-source-url")
    return fields.get("warc-target-uri") if kept is None else decoded(kept)


def parse(data: bytes | bytearray, whole: bool, ahead: Callable[[int], bytes] | None = None) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and length of the record at the start of ``data``; checks it.

    ``whole``: no more bytes follow. ``ahead`` gives the four bytes at a place after the start."""
    if not LINE.match(data):
        raise Damaged("no version line") if whole or len(data) >= 10 else Short
    stop = data.find(END)
    if stop < 0:
        # A header may be of any length, but a line of it that is there in full must have a colon.
        if any(b":" not in line for line in data.split(b"\r\n")[1:-1]):
            raise Damaged("header line without colon")
        raise Damaged("endless header") if whole else Short
    fields: dict[str, str] = {}
    for line in bytes(data[:stop]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    start, end = stop + 4, stop + 4 + int(length)
    if len(data) < end + 4:
        if not whole and ahead is not None and (closing := ahead(end)) != END:
            raise Damaged("length does not match" if len(closing) == 4 else "cut short")
        raise Damaged("cut short") if whole else Short
    if bytes(data[end : end + 4]) != END:
        raise Damaged("length does not match")
    block = bytes(data[start:end])
    wanted = fields.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted[5:] != digest(block):
        raise Damaged("block digest")
    wanted = fields.get("warc-payload-digest", "")
    if wanted.startswith("sha1:") and fields.get("warc-type") == "response" and wanted[5:] != digest(block.partition(END)[2]):
        raise Damaged("payload digest")
    return fields, block, end + 4


def unpack(data: bytearray, whole: bool) -> tuple[dict[str, str], bytes, int]:
    """As ``parse``, for a gzip member that holds one record."""
    z = zlib.decompressobj(31)
    try:
        out = z.decompress(data)
    except zlib.error as e:
        raise Damaged(f"gzip: {str(e)[:60]}") from None
    if not z.eof:
        if len(out) >= 10 and not LINE.match(out):
            raise Damaged("no version line")
        raise Damaged("cut short") if whole else Short
    fields, block, used = parse(out, True)
    if used != len(out):
        raise Damaged("member holds more than a record")
    return fields, block, len(data) - len(z.unused_data)


def salvage(read: Callable[[int], bytes], peek: Callable[[int], bytes] | None = None) -> Iterator[tuple[str, int, int, str, dict[str, str], bytes]]:
    """("record", start, end, "", fields, block) and ("gap", start, end, reason, {}, b"")
    of a file, in order and without holes. ``peek`` gives the four bytes at a place of the file."""
    w, gap, reason = Window(read), None, ""
    while True:
        if not w.data and not w.more():
            break
        if len(w.data) < 3 and not w.ended:
            w.more()
            continue
        gz = w.data[:3] == b"\x1f\x8b\x08"
        try:
            if gz:
                fields, block, used = unpack(w.data, w.ended)
            else:
                fields, block, used = parse(w.data, w.ended, peek and (lambda n: peek(w.at + n)))
        except Short:
            # Ask for as much again as there is, so a long record is tried few times.
            for _ in range(max(1, len(w.data) // CHUNK)):
                if not w.more():
                    break
            continue
        except Damaged as e:
            if gap is None:
                gap, reason = w.at, str(e)
            while not (at := _next(w)):
                w.drop(max(1, len(w.data) - 9))  # a mark may be cut by the end of the buffer
                if not w.more():
                    at = len(w.data)
                    break
            w.drop(at)
            continue
        if gap is not None:
            yield "gap", gap, w.at, reason, {}, b""
            gap = None
        start = w.at
        w.drop(used)
        yield "record", start, w.at, "", fields, block
    if gap is not None:
        yield "gap", gap, w.at, reason, {}, b""


def _next(w: Window) -> int:
    """Where the next member or version line may begin after the first byte, or 0."""
    found = [m.start() for m in (MEMBER.search(w.data, 1), LINE.search(w.data, 1)) if m]
    return min(found, default=0)


SCHEMA = (
    "file string, entry string, start_byte long, end_byte long, reason string, record_type string, source_id string, "
    "url string, payload_digest string, refers_to string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """All records and gaps of ``files`` (a column ``file``, below ``path``), as SCHEMA.

    ``entry`` is ``record`` or ``gap``. ``payload`` is null for a revisit; its
    ``payload_bytes`` is what the kept HTTP headers say."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with open_file(f"{path}/{name}") as f:

                    def peek(at: int, f=f) -> bytes:
                        here = f.tell()
                        f.seek(min(at, f.size()))
                        found = f.read(4)
                        f.seek(here)
                        return found

                    for entry, a, b, reason, fields, block in salvage(f.read, peek):
                        http, _, payload = block.partition(END)
                        kind = fields.get("warc-type")
                        if kind == "response":
                            n = len(payload)
                        else:
                            said = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", http)
                            n, payload = int(said[1]) if said else None, None
                        marked = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        rows.append(
                            (name, entry, a, b, reason or None, kind, decoded(fields.get("warc-source-id")), url(fields),
                             marked, decoded(fields.get("warc-refers-to-source-id")), n, payload)
                        )
                        size += len(block)
                        if size > 4 << 20:
                            yield _batch(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[x.split()[1]] for x in SCHEMA.split(", ")]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    spread = files.select("file").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(read, SCHEMA)
