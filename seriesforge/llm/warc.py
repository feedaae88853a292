"""WARC records in seekable Zstandard bundles (operator 7).

Records are grouped into independent Zstandard frames; a bundle is a file of
frames and, as its footer, the seek table of the seekable Zstandard format (a
skippable frame with the compressed and decompressed size of each frame). An
index maps each record to its bundle, frame and the place inside the frame, so
one record is read by decompressing one frame. Records are plain WARC/1.1, and a
bundle without its index is still a valid .warc.zst file.

Each Spark task writes its bundles to the shared folder through the file system
of the folder's own URI, first under a draft name, then renamed to a name with
the task attempt in it. The index is committed by Spark, so it names the files of
the attempts that counted; a task that ran again after its executor was lost
leaves at most a bundle that no index names. A task holds one frame in memory.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm.common import read_table, shared_folder, stored, utf8

FRAME_BYTES = 1 << 20  # of records in a frame, but for a larger record, which has its own
BUNDLE_BYTES = 256 << 20  # of compressed frames in a bundle
MIN_REVISIT = 0  # smallest payload that may be a revisit
DATE = "1970-01-01T00:00:00Z"  # of captures that come without one
LEVEL = 3
#: Fixed values of the formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id bigint, bundle string, frame bigint, frame_at bigint, at bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _escaped(value: str) -> str:
    """A header value on one line: % and control characters as %XX."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 32 or ord(c) == 127 else c for c in value)


def _unescaped(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record with the HTTP response; a revisit ends after the HTTP header."""
    name = "null" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + name)}>", f"WARC-Date: {DATE}"]
    head += [] if url is None else [f"WARC-Target-URI: {_escaped(url)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {name}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` of a decompressed frame, and where the next begins."""
    body = data.index(b"\r\n\r\n", at) + 4
    lines = data[at:body - 4].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(head["Content-Length"])
    http = data.index(b"\r\n\r\n", body, end) + 4
    size = int(data[body:http].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    revisit = head["WARC-Type"] == "revisit"
    payload, digest = None if revisit else data[http:end], head["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and (len(payload) != size or digest32(payload) != digest):
        raise ValueError(f"record {head['X-Page-ID']} is damaged")
    return {"page_id": None if head["X-Page-ID"] == "null" else int(head["X-Page-ID"]), "url": _unescaped(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
            "record_type": head["WARC-Type"], "refers_to": int(head["X-Refers-To-Page-ID"]) if revisit else None, "payload_bytes": size, "payload_digest": digest, "payload": payload}, end + 4


class Bundle:
    """Writes one file of frames and its seek table."""

    def __init__(self, folder: str, name: str):
        self.store, root = open_store(folder)
        self.store.create_dir(root, recursive=True)
        self.name, self.final = name, f"{root}/{name}"
        self.draft = f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.at = 0

    def frame(self, content: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress(content)
        self.out.write(packed)
        self.sizes.append((len(packed), len(content)))
        self.at += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.store.move(self.draft, self.final)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed) of each frame, from the footer of an open file."""
    size = file.size()
    file.seek(size - 9)
    frames, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags & 0x7C:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    start = size - 9 - frames * entry - 8
    file.seek(start)
    if struct.unpack("<II", file.read(8)) != (SKIPPABLE, frames * entry + 9):
        raise ValueError("damaged seek table")
    table, out, at = file.read(frames * entry), [], 0
    for i in range(frames):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file, frame: tuple[int, int, int]) -> bytes:
    file.seek(frame[0])
    return zstandard.ZstdDecompressor().decompress(file.read(frame[1]), max_output_size=frame[2])


def read_record(uri: str, frame_number: int, at: int) -> dict:
    """One record by its index entry: the footer, one frame, one record."""
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        return parse(read_frame(file, seek_table(file)[frame_number]), at)[0]


def _writer(folder: str, frame_bytes: int, bundle_bytes: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, bundle, made = TaskContext.get(), None, 0
        buffer, entries = io.BytesIO(), []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal bundle, made, buffer, entries
            if not entries:
                return
            if bundle is None:
                bundle = Bundle(folder, f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst")
                made += 1
            number, where = len(bundle.sizes), bundle.at
            bundle.frame(buffer.getvalue())
            yield pa.RecordBatch.from_pylist([{"page_id": p, "bundle": bundle.name, "frame": number, "frame_at": where, "at": at, "length": n} for p, at, n in entries], schema=INDEX_SCHEMA)
            buffer, entries = io.BytesIO(), []
            if bundle.at >= bundle_bytes:
                bundle.close()
                bundle = None

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(i) for i in range(5))):
                page_id, refers_to = page_id.as_py(), refers_to.as_py()
                one = record(page_id, url.as_py(), payload.as_py(), base64.b32encode(bytes.fromhex(digest.as_py())).decode(), refers_to)
                if buffer.tell() and buffer.tell() + len(one) > frame_bytes:
                    yield from flush()
                entries.append((page_id, buffer.tell(), len(one)))
                buffer.write(one)
        yield from flush()
        if bundle is not None:
            bundle.close()

    return run


INDEX_SCHEMA = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), *((c, pa.int64()) for c in ("frame", "frame_at", "at", "length"))])
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def classified(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1) and refers_to (null: response).

    Of equal payloads of at least ``min_revisit`` bytes the smallest page_id is
    the response; all rows that have it are. Rows with a null page_id are always
    responses, and none refers to them. A null html is an empty payload."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html").alias("payload"))
    keys = stored(base.where("page_id is not null").where(F.octet_length("payload") >= min_revisit).select("page_id", F.sha2("payload", 256).alias("key")), "warc-keys")
    first = stored(keys.groupBy("key").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last").drop("last"), "warc-first")
    revisits = stored(keys.join(first, "key").where("page_id <> first").select("page_id", "key", F.col("first").alias("refers_to")).distinct(), "warc-revisits")
    # a page_id may come with several payloads: the key decides which row revisits
    named = base.withColumn("own", F.sha2("payload", 256))
    joined = named.join(revisits.withColumnRenamed("page_id", "p"), F.expr("page_id = p and own = key"), "left")
    return joined.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), "refers_to")


def write_bundles(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, html) and returns
    the index: page_id, bundle (file name), frame, frame_at (byte of the file), at
    (byte of the decompressed frame), length. Writing happens now."""
    rows = classified(pages, min_revisit)
    return stored(rows.mapInArrow(_writer(folder, frame_bytes, bundle_bytes), INDEX), "warc-index")


def _reader(folder: str) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for name, frames in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{root}/{name}") as file:
                    table = seek_table(file)
                    for number in sorted(frames):
                        content, at, rows = read_frame(file, table[number]), 0, []
                        while at < len(content):
                            one, at = parse(content, at)
                            rows.append(one)
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    return run


def read_bundles(index: DataFrame, folder: str, frames_each: int = 16) -> DataFrame:
    """All records of the bundles of an index, read back frame by frame: payload
    and both sizes are checked against the headers; a revisit's payload is null."""
    runs = index.select("bundle", "frame").distinct().groupBy("bundle", F.floor(F.col("frame") / frames_each).alias("run")).agg(F.collect_list("frame").alias("frames"))
    dealt = runs.select("bundle", "frames").repartition(max(1, min(4096, index.sparkSession.sparkContext.defaultParallelism * 4)), "bundle", "frames")
    return dealt.mapInArrow(_reader(folder), RECORD)


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    index = write_bundles(read_table(spark, sf_dir, "pages"), folder)
    return read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: SHA-1 as base32: five bits at a time from the hexadecimal digits.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, encode(coalesce(html, '')) AS bytes FROM pages),
h AS (SELECT page_id, payload, octet_length(bytes)::bigint AS payload_bytes, sha1(bytes) AS x FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(x, ''), lambda c: right(bin(strpos('0123456789abcdef', c) - 1 + 16), 4)), '') AS bits FROM h),
d AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: (substr(bits, 5 * i + j + 1, 1)::int) * (16 // (2 ** j)::int)))::int, 1)), '') AS payload_digest FROM b),
f AS (SELECT payload, min(page_id) AS first FROM h GROUP BY payload)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN f USING (payload)
"""
