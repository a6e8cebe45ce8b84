"""WARC archives: written as one gzip member per record, read by byte ranges.

The reader deals out ranges of bytes, not files. A task looks in its range for the three bytes that begin a
gzip member, takes a place as a record only if what is there decodes to a WARC header, and owns the
records that begin inside the range, to whose end it reads on. So one archive of any size is read by many
tasks, each of which holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewright.llm.tables import open_folder, written
from lodewright.session import shared_dir

# Fixed values of the formats: how a deflated gzip member begins, how a WARC header begins and ends.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
BLANK = b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 30

RECORDS = (
    "path string, offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload binary, error string"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, key, url, payload: bytes, hashed: str, first, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = http % len(payload) + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{hashed}"),
        ("X-Payload-Length", len(payload)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{first}>")]
    fields.append(("Content-Length", len(block)))
    head = VERSION + b"1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + b"\r\n" + block + BLANK) + packer.flush()


def write_archives(
    frame: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record per row below ``folder``; returns (path, length, records) per archive, written too.

    Of rows whose payloads are equal and have ``least_bytes`` or more, that with the largest key is a
    response and the others revisit it (rows that repeat that key and payload are responses too); shorter
    payloads are responses. A null payload is empty, a null url has no field, a null key has an empty record
    id and is the smallest. An empty table gives no archive. An attempt that is lost leaves an archive that
    isn't listed.
    """
    rows = frame.select(
        frame[key].cast("long").alias("key"),
        frame[url].alias("url"),
        F.coalesce(frame[payload].cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("hash", F.sha1("payload"))
    # Only shared payloads: one row each, reduced before the shuffle.
    shared = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("hash")
        .agg(F.max("key").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("hash", "first", F.lit(True).alias("shared"))
    )
    marked = rows.join(shared, "hash", "left").select(
        "key",
        "url",
        "payload",
        "first",
        (F.coalesce("shared", F.lit(False)) & ~F.col("key").eqNullSafe(F.col("first"))).alias("again"),
    )

    def write(batches):
        target, out, path, count = None, None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    target, base = open_folder(folder)
                    target.create_dir(base, recursive=True)
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out = target.open_output_stream(f"{base}/{path}", compression=None)
                kind = "revisit" if row["again"] else "response"
                data = row["payload"]
                out.write(_record(kind, row["key"], row["url"], data, digest(data), row["first"], date))
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    yield _listed(folder, path, out, count)
                    out, count = None, 0
        if out is not None:
            yield _listed(folder, path, out, count)

    return written(marked.mapInArrow(write, "path string, length long, records long"), "archives")


def _listed(folder: str, path: str, out, count: int) -> pa.RecordBatch:
    length = out.tell()
    out.close()
    return pa.RecordBatch.from_pylist(
        [{"path": f"{folder}/{path}", "length": length, "records": count}]
    )


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the archives that a path or pattern names; their content isn't read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


class _Window:
    """Bytes of a file from any offset on, read in blocks."""

    def __init__(self, file):
        self.file, self.begin, self.data = file, 0, b""

    def at(self, offset: int, size: int) -> bytes:
        if offset < self.begin or offset + size > self.begin + len(self.data):
            self.file.seek(offset)
            self.begin, self.data = offset, self.file.read(max(size, READ_BYTES))
        return self.data[offset - self.begin : offset - self.begin + size]


def _header(window: _Window, offset: int) -> bool:
    """Whether a member at the offset decodes to the beginning of a WARC record."""
    try:
        return zlib.decompressobj(31).decompress(window.at(offset, 1024), 64).startswith(VERSION)
    except zlib.error:
        return False


def _member(window: _Window, first: int) -> tuple[bytes, int, str | None]:
    """The content of the member at ``first``, where it ends, and what is wrong with it.

    Of a damaged one there is the content up to the damage; it ends behind its first byte, so that a record that
    begins inside is looked for too.
    """
    unpack, parts, offset = zlib.decompressobj(31), [], first
    while not unpack.eof:
        data = window.at(offset, READ_BYTES)
        if not data:
            return b"".join(parts), first + 1, "cut off"
        try:
            parts.append(unpack.decompress(data))
        except zlib.error:
            return b"".join(parts), first + 1, "damaged member"
        offset += len(data) - len(unpack.unused_data)
    return b"".join(parts), offset, None


def members(file, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the records that begin in [begin, end)."""
    return ((offset, content) for offset, content, _ in _members(file, begin, end))


def _members(file, begin: int, end: int) -> Iterator[tuple[int, bytes, str | None]]:
    """Offset, content and what is wrong with the member, of the records that begin in [begin, end)."""
    window, offset = _Window(file), begin
    while offset < end:
        data = window.at(offset, READ_BYTES)
        found = data.find(MAGIC)
        if found < 0:
            if len(data) < len(MAGIC):
                return
            offset += len(data) - len(MAGIC) + 1  # the mark may lie across two blocks
            continue
        offset += found
        if offset >= end:
            return
        if not _header(window, offset):
            offset += 1
            continue
        first = offset
        content, offset, error = _member(window, offset)
        yield first, content, error


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else None


def parse(path: str, offset: int, content: bytes, error: str | None = None) -> dict:
    """The row of a record. What is wrong with it is its ``error``; the fields that can be read are there still."""
    head, _, rest = content.partition(BLANK)
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    kind, length = fields.get("warc-type"), _number(fields.get("content-length"))
    if kind is None:
        error = error or "no record type"
    if length is None:
        error = error or "no content length"
    elif len(rest) < length:
        error = error or "cut off"
    block = payload = rest[:length]
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(BLANK)[2]
    algorithm, _, named = fields.get("warc-payload-digest", "").rpartition(":")
    size = len(payload)
    if kind == "revisit":
        payload, size = None, _number(fields.get("x-payload-length"))
    elif named and algorithm in ("", "sha1") and named != digest(payload):
        error = error or "payload without its digest"
    return {
        "path": path,
        "offset": offset,
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"),
        "payload_digest": named or (None if payload is None else digest(payload)),
        "payload_bytes": size,
        "payload": payload,
        "error": error,
    }


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for each record of the archives (path, length), read by ranges of ``range_bytes``.

    The payload is that of the HTTP message if there is one, null for a revisit. A place that looks like a member
    and isn't a record is passed over. A record that is damaged, cut off, without type or length, or whose payload
    differs from its SHA-1 digest, is a row whose ``error`` says so, with what can be read of it; the records
    behind it are read all the same. ``error`` is null for all others.
    """
    ranges = files.select(
        "path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(range_bytes))).alias("begin")
    ).where("length > 0")
    tasks = files.agg(F.sum(F.ceil(F.col("length") / range_bytes))).first()[0] or 1

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                source, base = open_folder(row["path"])
                end = min(row["begin"] + range_bytes, row["length"])
                with source.open_input_file(base) as file:
                    rows, size = [], 0
                    for offset, content, error in _members(file, row["begin"], end):
                        rows.append(parse(row["path"], offset, content, error))
                        size += len(content)
                        if size > RANGE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return ranges.repartition(int(tasks)).mapInArrow(read, RECORDS)


_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (column.split() for column in RECORDS.split(", "))
    ]
)


def page_of(urn):
    """The key in a record id that ``write_archives`` gave; null where it is empty."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(frame: DataFrame) -> DataFrame:
    """Writes the pages below the shared folder and reads them back."""
    folder = shared_dir(frame.sparkSession, "warc")
    return read_archives(write_archives(frame, folder))
