"""WARC archives as seekable Zstandard bundles.

A bundle is a sequence of independent frames, each of whole records, and a
skippable frame at the end with the size of every frame (the seek table of the
seekable Zstandard format). The index names for each record its bundle, frame and
offset inside the decompressed frame, so one record costs one frame to read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import small_batches
from snapflow.session import cut

# fixed values of the seekable format
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")  # frames, descriptor, magic number
_ENTRY = struct.Struct("<II")  # compressed and decompressed size of a frame

#: A frame is closed at the record that takes it past so many bytes, a bundle likewise.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX = "page_id long, bundle string, frame int, offset int, length int"
_INDEX = pa.schema([
    ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32()),
])
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)
_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def as_uri(path: str) -> str:
    """A folder path as URI; a path without scheme is one of the shared file system."""
    return path if re.match(r"[a-z0-9]+:", path) else f"file://{path}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    value = record_id[len("<urn:page:"):-1]
    return None if value == "none" else int(value)


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """Bytes of a record; a revisit keeps the HTTP head and leaves the payload out."""
    head = _HTTP.format(len(payload)).encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:  # a header is one line
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _headers(raw: bytes, at: int) -> tuple[dict[str, str], int]:
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}, end + 4


def parse_records(raw: bytes) -> Iterator[tuple]:
    """Rows of RECORDS for the records of a decompressed frame; a damaged payload raises."""
    at = 0
    while at < len(raw):
        head, body = _headers(raw, at)
        end = body + int(head["content-length"])
        http, start = _headers(raw, body)
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        size, kind = int(http["content-length"]), head["warc-type"]
        payload = raw[start:end] if kind == "response" else None
        if payload is not None and (len(payload) != size or payload_digest(payload) != digest):
            raise ValueError(f"damaged record {head['warc-record-id']}")
        refers = _page_id(head["warc-refers-to"]) if kind == "revisit" else None
        yield _page_id(head["warc-record-id"]), head.get("warc-target-uri"), size, digest, kind, refers, payload
        at = end + 4


def _folder(root: str):
    # "file:/x" and "file:///x" name the same folder
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root))


class BundleWriter:
    """One bundle, frame by frame; only the open frame is in memory."""

    def __init__(self, root: str):
        fs, path = _folder(root)
        fs.create_dir(path, recursive=True)
        # a new name each time: a repeated task leaves a file that no index names
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.pack = zstandard.ZstdCompressor()
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        place = len(self.sizes), self.filled
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self._close_frame()
        return place

    def _close_frame(self) -> None:
        if self.open:
            data = self.pack.compress(b"".join(self.open))
            self.out.write(data)
            self.sizes.append((len(data), self.filled))
            self.written += len(data)
            self.open, self.filled = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(_ENTRY.pack(*s) for s in self.sizes) + _FOOTER.pack(len(self.sizes), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through the seek table."""

    def __init__(self, root: str, name: str):
        fs, path = _folder(root)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        frames, _, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != _SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        table = self.file.read_at(frames * _ENTRY.size, size - _FOOTER.size - frames * _ENTRY.size)
        self.frames, at = [], 0
        for packed, plain in _ENTRY.iter_unpack(table):
            self.frames.append((at, packed, plain))
            at += packed
        self.unpack = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return self.unpack.decompress(self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> tuple:
        return next(parse_records(self.frame(frame)[offset:offset + length]))


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, keeper): keeper is the largest page_id of an equal payload, null if too small.

    Payloads are compared by SHA-256. The minima per payload are combined before
    the shuffle, the narrow rows of a very common payload are split by the adaptive
    join, and the payloads themselves move by page_id, which is spread evenly.
    """
    whole = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn(
        "key", F.unhex(F.sha2("payload", 256))
    )
    marks = cut(whole.select("page_id", "key", F.octet_length("payload").alias("size")).distinct())
    keepers = marks.filter(F.col("size") >= least_bytes).groupBy("key").agg(F.max("page_id").alias("keeper"))
    roles = marks.join(keepers, "key", "left").select(F.col("page_id").alias("p"), F.col("key").alias("k"), "keeper")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("key") == F.col("k"))
    return whole.join(roles, same, "left").select("page_id", "url", "payload", "keeper")


def write_archives(pages: DataFrame, root: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of pages (page_id, url, html) under ``root``; the index, itself written once.

    Of equal payloads of at least ``least_bytes`` bytes the largest page_id is the
    response and the others revisit it; repeated rows are alike. A null html is an
    empty payload, a null url leaves its header out, and a null page_id is smaller
    than any other and never referred to (rows of null ids only are responses).
    ``root`` is a URI of a file system that every executor reaches.
    """
    small_batches(pages.sparkSession)

    def write(batches):
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, payload, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                bundle = bundle or BundleWriter(root)
                revisit = keeper is not None and keeper != page_id
                record = warc_record(page_id, url, payload, payload_digest(payload), keeper, revisit, date)
                frame, offset = bundle.add(record)
                rows.append((page_id, bundle.name, frame, offset, len(record)))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)
        if bundle:
            bundle.close()

    return cut(with_roles(pages, least_bytes).mapInArrow(write, INDEX))


def read_archives(index: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """Every record of the bundles that the index names, payloads checked against their digests.

    One task reads a bundle frame by frame. Payloads are returned on request only.
    """
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # in turn, as names are too few bytes for the adaptive plan to keep them apart
    bundles = index.select("bundle").distinct().repartition(tasks)

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                bundle = BundleReader(root, name)
                for number in range(len(bundle.frames)):
                    rows = list(parse_records(bundle.frame(number)))
                    if not payloads:
                        rows = [(*r[:-1], None) for r in rows]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)

    return bundles.mapInArrow(read, RECORDS)


def read_record(spark: SparkSession, index: DataFrame, root: str, page_id: int) -> tuple | None:
    """One record by its identifier: one index row and one frame are read."""
    row = index.filter(F.col("page_id") == page_id).first()
    return row and BundleReader(root, row.bundle).record(row.frame, row.offset, row.length)
