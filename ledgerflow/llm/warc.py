"""WARC archives: a writer with one gzip member per record and a reader that splits files by bytes.

Writer. Payloads that repeat are stored once: of records with equal payloads of at least ``least`` bytes one is a
``response``, the others are ``revisit`` records that refer to it. Tasks stream their rows into files of their own below
a shared folder and return a row per file. Only files in that manifest count, so what a lost or repeated task attempt
left behind is never read.

Reader. A file is cut into byte ranges. A task scans its range for the gzip magic, takes a place as a member when it
inflates to a WARC header with a usable length, and owns the records that start inside its range, also when they end
beyond it. Inside a run of members the next one starts where the last ended; when that place holds no member the scan goes
on behind the start of the last. A task holds one record at a time. Headers may have any length. Before records are handed
out they are counted once, and a file that does not hold as many as its manifest says is an error.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import store
from ledgerflow.settings import scratch_dir

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
STEP = 1 << 20
MOST_TASKS = 20_000
DATE = "2024-01-01T00:00:00Z"

MANIFEST = T.StructType([T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("records", T.LongType())])
RECORDS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def open_folder(url: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URL or path, and the path in it."""
    if "://" not in url and not url.startswith("file:"):
        return pafs.LocalFileSystem(), url
    if url.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", url)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", url))


def one_line(value: str) -> str:
    """Header values hold no control characters."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, name: str, uri: str | None, payload: bytes, digest: str, size: int, refers: str | None) -> bytes:
    """A WARC record; a revisit holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {one_line(uri)}")
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, html, digest, size, refers): ``refers`` is the page whose equal payload is kept, null for responses.

    Winners are found on digests alone, combined before the shuffle. Equal rows of one page id refer to nothing. A payload
    shared by a third of all pages is one row of the winners; the texts then move once, by page id.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    marks = pages.select("page_id", F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    large = marks.filter((F.col("size") >= least) & F.col("page_id").isNotNull())
    kept = large.groupBy("digest", "size").agg(F.max("page_id").alias("refers"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    links = large.join(kept, ["digest", "size"]).filter("page_id <> refers").select("page_id", "refers", "digest").distinct()
    full = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    return full.join(links, ["page_id", "digest"], "left")


def write_archives(records: DataFrame, folder: str, level: int = 3, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the rows of ``with_revisits`` as archives below ``folder``; returns the stored manifest.

    Null urls are left out of the header, null page ids are written as ``null``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        found: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            page, url, html, digest, length, refers = (batch.column(i) for i in range(6))
            for i in range(batch.num_rows):
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                to = refers[i].as_py()
                kind, own = ("response" if to is None else "revisit"), page[i].as_py()
                data = record(
                    kind, "null" if own is None else str(own), url[i].as_py(), html[i].as_py().encode(), digest[i].as_py(), length[i].as_py(), None if to is None else str(to)
                )
                packed = member(data, level)
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= file_bytes:
                    out.close()
                    found.append((f"{folder}/{name}", size, count))
                    out = None
        if out is not None:
            out.close()
            found.append((f"{folder}/{name}", size, count))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=MANIFEST.names)

    rows = records.select("page_id", "url", "html", "digest", "size", "refers")
    return store(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class _Window:
    """Bytes of a file from a moving start on, read in steps."""

    def __init__(self, source: pa.NativeFile, at: int, size: int):
        self.source, self.start, self.size, self.data = source, at, size, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on."""
        end = min(self.size, at + n)
        if at < self.start or at > self.start + len(self.data):
            self.start, self.data = at, b""
        if end > self.start + len(self.data):
            self.data = self.data[at - self.start :]
            self.start = at
            self.source.seek(self.start + len(self.data))
            self.data += self.source.read(max(STEP, end - self.start - len(self.data)))
        return self.data[at - self.start : end - self.start]


def parse_header(head: bytes) -> dict[str, str] | None:
    """The named fields of a WARC header, in lower case; None when it is none."""
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/\d\.\d", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def read_member(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """The record whose gzip member starts at ``at``: header, block, end of the member. None when there is no such member.

    The header is decoded first; a place that does not inflate to one is given up before its body is read. The member
    must end with a right checksum and hold as many bytes as its header says.
    """
    if window.get(at, 3) != MAGIC:
        return None
    unpacker, head, pieces, place, fields = zlib.decompressobj(31), bytearray(), [], at, None
    while not unpacker.eof:
        data = window.get(place, 1 << 12 if fields is None else STEP)
        if not data:
            return None
        try:
            piece = unpacker.decompress(data)
        except zlib.error:
            return None
        place += len(data)
        if fields is not None:
            pieces.append(piece)
            continue
        head += piece
        if not b"WARC/".startswith(head[:5]):
            return None
        split = head.find(b"\r\n\r\n", max(0, len(head) - len(piece) - 3))
        if split >= 0:
            fields = parse_header(bytes(head[:split]))
            if fields is None:
                return None
            pieces.append(bytes(head[split + 4 :]))
    if fields is None:
        return None
    body = b"".join(pieces)
    length = int(fields["content-length"])
    if len(body) != length + 4:
        return None
    return fields, body[:length], place - len(unpacker.unused_data)


def read_range(source: pa.NativeFile, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, block) of the records that start in [start, end)."""
    window, at = _Window(source, start, size), start
    while at < end:
        data = window.get(at, min(STEP, end - at) + len(MAGIC) - 1)
        hit = data.find(MAGIC)
        if hit < 0 or at + hit >= end:
            at += max(1, min(STEP, end - at))
            continue
        at += hit
        found = read_member(window, at)
        if found is None:
            at += 1
            continue
        fields, block, after = found
        if after < size and window.get(after, 3) != MAGIC:
            at += 1  # a member inside another one's stored bytes
            continue
        yield at, fields, block
        at = after


def bare(name: str | None) -> str | None:
    return None if name is None else re.sub(r"^<urn:page:(.*)>$", r"\1", name)


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the files in a manifest (file, bytes), whatever their size, one task per byte range.

    Digests are hex. For a response the payload is what follows the HTTP header; a digest that does not fit it is an error.
    Where the manifest has ``records``, files are read once more before, to count them, and a file with others is an error.
    """
    ranges = manifest.filter("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    count = ranges.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                fs, path = open_folder(part["file"])
                rows, held = [], 0
                with fs.open_input_file(path) as source:
                    for at, fields, block in read_range(source, part["bytes"], part["start"], part["start"] + split_bytes):
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        if fields["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{part['file']} at {at}: the payload does not fit its digest")
                        length = int(fields.get("x-payload-length", len(payload)))
                        rows.append(
                            (part["file"], at, fields["warc-type"], bare(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                             bare(fields.get("warc-refers-to")), digest, length, payload if fields["warc-type"] == "response" else None)
                        )
                        held += len(payload)
                        if held > 4 * STEP or len(rows) >= 2000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                fs, path = open_folder(part["file"])
                with fs.open_input_file(path) as source:
                    n = sum(1 for _ in read_range(source, part["bytes"], part["start"], part["start"] + split_bytes))
                yield pa.RecordBatch.from_arrays([pa.array([part["file"]]), pa.array([n], pa.int64())], names=["file", "n"])

    spread = ranges.repartition(max(1, min(count, MOST_TASKS)), "file", "start")
    if "records" in manifest.columns:
        held = spread.mapInArrow(tally, "file string, n long").groupBy("file").agg(F.sum("n").alias("n"))
        both = manifest.select("file", "records").join(held, "file", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        wrong = both.filter("n <> records").first()
        if wrong is not None:
            raise ValueError(f"{wrong['file']}: {wrong['n']} records can be read, the manifest has {wrong['records']}")
    return spread.mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=RECORDS.names)


def round_trip(pages: DataFrame, least: int = 1000, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html; null html is empty) to archives and reads them back: one row per page row."""
    folder = scratch_dir(pages.sparkSession, "warc")
    manifest = write_archives(with_revisits(pages, least), folder)
    return read_archives(manifest, split_bytes)
