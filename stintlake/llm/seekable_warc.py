"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with whole records up to some size, and a seek table in a
skippable frame at its end (the public seekable format). Any tool that reads Zstandard reads a bundle from front to end; a
reader that wants one record reads the table, one frame and the record's span inside the frame. The index maps record
identifiers to (bundle, frame, offset in the frame, length) and is an ordinary table.

Tasks write their bundles straight to the shared folder under a name of their own attempt. The index names only the
bundles of attempts that ended well, so a lost executor leaves at worst a file that nothing points to.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import small_batches
from stintlake.session import stage, staging_dir

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEAST_REVISIT_BYTES = 100
# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_HEAD = struct.Struct("<II")
_ENTRY = struct.Struct("<II")

DATE = "1970-01-01T00:00:00Z"
INDEX = "record_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, digest string, payload binary"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder URI or plain path; an error where the store is not one that tasks can open."""
    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of these (compressed, plain) sizes."""
    entries = b"".join(_ENTRY.pack(*s) for s in sizes)
    return _HEAD.pack(SKIPPABLE_MAGIC, len(entries) + _FOOTER.size) + entries + _FOOTER.pack(len(sizes), 0, SEEKABLE_MAGIC)


class BundleWriter:
    """Appends records to one bundle."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES):
        system, path = file_system(uri)
        system.create_dir(os.path.dirname(path), recursive=True)
        self.uri, self.written, self._frame_bytes = uri, 0, frame_bytes
        self._out = system.open_output_stream(path, compression=None)  # by default the name would choose one
        self._pack = zstandard.ZstdCompressor(level=3).compress
        self._sizes: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._filled = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Place of the record: its frame and its offset there."""
        if self._filled and self._filled + len(record) > self._frame_bytes:
            self._close_frame()
        place = len(self._sizes), self._filled
        self._open.append(record)
        self._filled += len(record)
        return place

    def _close_frame(self) -> None:
        if self._open:
            frame = self._pack(b"".join(self._open))
            self._out.write(frame)
            self._sizes.append((len(frame), self._filled))
            self.written += len(frame)
            self._open, self._filled = [], 0

    def close(self) -> None:
        self._close_frame()
        self._out.write(seek_table(self._sizes))
        self._out.close()


class BundleReader:
    """Reads records of one bundle by frame and offset; the last frame is kept."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self._in = system.open_input_file(path)
        end = self._in.size()
        count, flags, magic = _FOOTER.unpack(self._in.read_at(_FOOTER.size, end - _FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        each = _ENTRY.size + (4 if flags & 0x80 else 0)
        table = self._in.read_at(count * each, end - _FOOTER.size - count * each)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = _ENTRY.unpack_from(table, i * each)
            self.frames.append((at, packed, plain))
            at += packed
        self._unpack, self._held = zstandard.ZstdDecompressor(), (-1, b"")

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if self._held[0] != frame:
            at, packed, plain = self.frames[frame]
            self._held = frame, self._unpack.decompress(self._in.read_at(packed, at), max_output_size=plain) if plain else b""
        return self._held[1][offset : offset + length]

    def close(self) -> None:
        self._in.close()


def _urn(record_id: int | None) -> str:
    return f"<urn:page:{'none' if record_id is None else record_id}>"


def _from_urn(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[%\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%25", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[int | None, str | None, str, int | None, str, bytes]:
    """``(page_id, url, type, refers_to, digest, payload)`` of a record."""
    head, _, body = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or body[size:] != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {lines[:3]}")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return _from_urn(fields["WARC-Record-ID"]), url, fields["WARC-Type"], _from_urn(fields.get("WARC-Refers-To")), digest, body[:size]


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, first_id``; first_id is set for records that revisit another.

    Digests are counted without the payloads, and only repeats are joined back, by page, so that a payload shared by many
    pages gathers nowhere.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    keys = rows.where(F.octet_length("payload") >= LEAST_REVISIT_BYTES).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    repeats = keys.join(first, "digest").where("page_id is null or page_id <> first_id").select("page_id", "digest", "first_id")
    repeats = repeats.where("first_id is not null").groupBy("page_id", "digest").agg(F.min("first_id").alias("first_id"))
    marked = repeats.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "first_id")
    on = F.coalesce("page_id", F.lit(-1)).eqNullSafe(F.coalesce("_p", F.lit(-1))) & F.isnull("page_id").eqNullSafe(F.isnull("_p")) & (F.col("digest") == F.col("_d"))
    return rows.join(marked, on, "left").drop("_p", "_d")


def write_archives(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``with_revisits`` rows to bundles in ``folder``; the index, as a staged table in the order written.

    ``folder`` is where Spark would put it: without a scheme it lies in Spark's default store, not on a task's own disk.
    """
    spark = records.sparkSession
    small_batches(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    file_system(folder)  # fails here rather than in every task

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, bundle, number = TaskContext.get(), None, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, first_id in batch.itertuples(index=False):
                page_id, first_id = (None if pd.isna(x) else int(x) for x in (page_id, first_id))
                if bundle is None:
                    name = f"part-{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.warc.zst"
                    bundle, number = BundleWriter(f"{folder}/{name}", frame_bytes), number + 1
                record = record_bytes(page_id, url, digest, bytes(payload), first_id, first_id is not None)
                frame, offset = bundle.add(record)
                rows.append((page_id, bundle.uri, frame, offset, len(record)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            yield pd.DataFrame(rows, columns=["record_id", "bundle", "frame", "offset", "length"]).astype({"record_id": "Int64"})
        if bundle is not None:
            bundle.close()

    cols = records.select("page_id", "url", "payload", "digest", "first_id")
    return stage(cols.mapInPandas(run, INDEX), "warc-index")


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[list[bytes]]:
    reader, uri = None, None
    for batch in batches:
        found = []
        for bundle, frame, offset, length in zip(batch["bundle"], batch["frame"], batch["offset"], batch["length"]):
            if bundle != uri:
                if reader:
                    reader.close()
                reader, uri = BundleReader(bundle), bundle
            found.append(reader.record(frame, offset, length))
        yield found
    if reader:
        reader.close()


def read_archives(index: DataFrame) -> DataFrame:
    """The records that index rows point to: ``page_id, url, record_type, refers_to, digest, payload``."""
    small_batches(index.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for records in _spans(batches):
            rows = [parse_record(r) for r in records]
            names = ["page_id", "url", "record_type", "refers_to", "digest", "payload"]
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return index.mapInPandas(run, RECORD)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages to bundles, read every record back and describe it.

    Per row: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. Sizes and digests are worked
    out anew from what was read; a revisit takes those of the response that it refers to. A null page is empty. Of rows
    that repeat both the smallest id and the payload all are responses; a null id never is a smallest one unless a payload
    has no other, whose records are all responses. Other columns of ``pages`` are not looked at.
    """
    folder = f"{staging_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    index = write_archives(with_revisits(pages, id_col, url_col, html_col), folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for records in _spans(batches):
            rows = []
            for page_id, _, kind, refers_to, digest, payload in map(parse_record, records):
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record {page_id} was not read as it was written")
                rows.append((page_id, kind, refers_to, digest, len(payload)))
            names = ["page_id", "record_type", "refers_to", "payload_digest", "n"]
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    small_batches(index.sparkSession)
    read = stage(index.mapInPandas(run, "page_id long, record_type string, refers_to long, payload_digest string, n long"), "warc-read")
    responses = read.where("record_type = 'response'")
    targets = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("n").alias("payload_bytes"))
    revisits = read.where("record_type = 'revisit'").join(targets, ["refers_to", "payload_digest"])
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("payload_bytes", F.col("n")).select(cols).unionByName(revisits.select(cols))
