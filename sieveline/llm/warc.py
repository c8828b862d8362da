"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own. A skippable frame at the
end of a bundle holds the seek table (compressed and full size of every frame), and an
index maps each record to its bundle, frame and place in the frame, so that one
record costs one frame. Payloads of some size that are equal are stored once; the
others are revisit records that name the stored one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches
from sieveline.llm.files import make_folder, spread, store_of, task_file
from sieveline.shared import new_folder, written

#: Full bytes of a frame before the next one begins, and of a bundle.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
#: Digests (with an id each) up to which all that repeat are broadcast.
BROADCAST_ROWS = 1_000_000
#: Payloads below this size are always stored.
REVISIT_BYTES = 1000
# Fixed values of the seekable format: skippable frame, footer, and their layouts.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
HEAD, ENTRY, FOOT = struct.Struct("<II"), struct.Struct("<II"), struct.Struct("<IBI")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

INDEX = "page_id bigint, bundle string, frame int, place int, bytes int"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


class Record(NamedTuple):
    page_id: int | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None
    url: str | None
    payload: bytes


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, size: int, digest: str, date: str) -> bytes:
    """One WARC record; a revisit has the HTTP head of its page but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[Record]:
    """The records of a frame. A stored payload must have the digest of its head."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(head["Content-Length"])
        block = frame[start : start + size]
        http, payload = block.split(b"\r\n\r\n", 1)
        digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        full = int(re.search(rb"Content-Length: (\d+)", http).group(1))
        if head["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != full):
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        page, target = head.get("Page-Id"), head.get("Refers-To-Page-Id")
        yield Record(
            int(page) if page else None, full, digest, head["WARC-Type"], int(target) if target else None,
            head.get("WARC-Target-URI"), payload,
        )
        at = start + size + 4


class Bundle:
    """Writes frames and, when closed, the seek table."""

    def __init__(self, file: BinaryIO, frame_bytes: int = FRAME_BYTES):
        self.file, self.frame_bytes = file, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.held, self.held_bytes, self.frames, self.total = [], 0, [], 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, place in the frame, and size of the record."""
        where = (len(self.frames), self.held_bytes, len(record))
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= self.frame_bytes:
            self._end_frame()
        return where

    def _end_frame(self) -> None:
        if self.held:
            packed = self.compressor.compress(b"".join(self.held))
            self.file.write(packed)
            self.frames.append((len(packed), self.held_bytes))
            self.total += len(packed)
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self._end_frame()
        table = b"".join(ENTRY.pack(*f) for f in self.frames) + FOOT.pack(len(self.frames), 0, SEEKABLE)
        self.file.write(HEAD.pack(SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(file: BinaryIO) -> list[tuple[int, int]]:
    """Start and compressed size of every frame, from the end of the bundle."""
    size = file.seek(0, 2)
    file.seek(size - FOOT.size)
    frames, _, magic = FOOT.unpack(file.read(FOOT.size))
    if magic != SEEKABLE:
        raise ValueError("bundle has no seek table")
    file.seek(size - FOOT.size - frames * ENTRY.size)
    raw, starts, at = file.read(frames * ENTRY.size), [], 0
    for packed, _ in ENTRY.iter_unpack(raw):
        starts.append((at, packed))
        at += packed
    return starts


def read_frame(file: BinaryIO, table: list[tuple[int, int]], frame: int) -> bytes:
    start, packed = table[frame]
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed))


def read_record(bundle: str, frame: int, place: int, size: int) -> Record:
    """One record by its index entry; reads and decompresses one frame."""
    store, path = store_of(bundle)
    with store.open_input_file(path) as file:
        whole = read_frame(file, seek_table(file), frame)
    return next(parse_records(whole[place : place + size]))


def with_targets(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)``.

    Equal payloads are found by digest in a pre-aggregated count. Up to
    ``BROADCAST_ROWS`` digests that several pages have are broadcast, and no payload
    moves. Of more, the few that hold over a thousandth of the pages (under a thousand,
    whatever the data) are, and their rows and small ones stay in place too; only the
    other rows are joined. So no task gets a hot group.
    """
    payload = F.coalesce(F.encode(quoted("html").cast("string"), "UTF-8"), F.lit(b""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), quoted("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = keyed.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    large = F.col("payload_bytes") >= revisit_bytes
    groups = keyed.where(large).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("top")).where("n > 1")
    groups = written(groups, "payloads")
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    few = count <= BROADCAST_ROWS
    hot = F.lit(True) if few else F.col("n") > max(64, total // 1000)
    marked = keyed.join(F.broadcast(groups.where(hot).select("payload_digest", "top")), "payload_digest", "left")
    if not few:
        decided = F.col("top").isNotNull() | ~large
        others = groups.where(~hot).select("payload_digest", F.col("top").alias("other"))
        joined = marked.where(~decided).join(others, "payload_digest", "left").withColumn("top", F.col("other")).drop("other")
        marked = marked.where(decided).unionByName(joined)
    # A page without an id revisits the others' response too.
    target = F.when(large & ~F.col("top").eqNullSafe(F.col("page_id")), F.col("top"))
    return marked.select("page_id", "url", "payload", "payload_bytes", "payload_digest", target.alias("refers_to"))


def write_bundles(
    pages: DataFrame, folder: str, date: str = "2025-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES, revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write a record for each row of ``(page_id, url, html)`` and return the index
    ``(page_id, bundle, frame, place, bytes)``, itself stored in the folder.

    Null html is an empty payload; a null url has no target header; a page without
    id is never referred to, but revisits a page with one. Rows with one id and payload are both responses. Other
    columns are left behind.
    """
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, name, n = None, "", 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if bundle is None:
                    name, n = task_file(folder, n, ".warc.zst"), n + 1
                    store, path = store_of(name)
                    bundle = Bundle(store.open_output_stream(path, compression=None), frame_bytes)
                record = build_record(r["page_id"], r["url"], r["payload"], r["refers_to"], r["payload_bytes"], r["payload_digest"], date)
                rows.append((r["page_id"], name, *bundle.add(record)))
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["page_id", "bundle", "frame", "place", "bytes"]
                )
        if bundle is not None:
            bundle.close()

    index = map_batches(with_targets(pages, revisit_bytes), run, INDEX)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the index's bundles, read frame by frame through the seek
    tables: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""

    def rows(bundles: Iterable[str]) -> Iterator[list[tuple]]:
        for name in bundles:
            store, path = store_of(name)
            with store.open_input_file(path) as file:
                table = seek_table(file)
                for frame in range(len(table)):
                    yield [r[:5] for r in parse_records(read_frame(file, table, frame))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for found in rows(b for batch in batches for b in batch.column("bundle").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    return map_batches(spread(index.select("bundle").distinct(), "bundle"), run, READ)


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to a new folder and read them back."""
    return read_bundles(write_bundles(pages, new_folder(spark, "warc")))
