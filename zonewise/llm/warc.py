"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames followed by the seek table of the public seekable format
(a skippable frame with the packed and unpacked size of every frame, and a footer).  Any Zstandard tool can
unpack a whole bundle; a reader of one record needs only its frame.  The index maps a record id to bundle,
frame and the place within the unpacked frame.

Tasks write bundles of their own, under a name of their attempt, into a folder that every executor can reach
(a URI of any file system that Arrow knows); a lost task leaves a file that no index row names.

Of records with equal payloads of at least ``least`` bytes, the one with the largest id is a response and the
others are revisits of it; smaller ones, and records without an id, are responses.  A null payload is empty, a null
url is written as an empty field.  A repeated id with an equal payload gives two equal records.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.llm import bloom
from zonewise.llm.common import as_text, field, materialize
from zonewise.session import shared_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEVEL = 3
# Fixed values of the public seekable format and of WARC.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = "record_id string, bundle string, frame_start long, frame_bytes long, start long, bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def record(key, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One WARC record with its HTTP head; a revisit has the head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(key)}"]
    head += [f"WARC-Date: {WRITTEN}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = http + payload if refers_to is None else http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record, and its payload.  A response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def key(name):
        value = fields.get(name, "<urn:page:none>")[10:-1]
        return None if value == "none" else value

    return {
        "page_id": key("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI", ""),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": key("WARC-Refers-To"),
        "payload": payload,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The last frame of a bundle: packed and unpacked sizes of the others."""
    body = b"".join(struct.pack("<II", packed, full) for packed, full in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int]]:
    """``(start, packed size)`` of every frame, from the end of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    sizes = [struct.unpack("<II", file.read(8))[0] for _ in range(count)]
    starts = [0, *itertools.accumulate(sizes)][:-1]
    return list(zip(starts, sizes))


class BundleWriter:
    """Fills frames and bundles, and yields the index rows of each frame as it is written."""

    def __init__(self, folder: str, name: str, frame_bytes: int, bundle_bytes: int):
        import zstandard
        from pyarrow import fs

        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.name, self.frame_bytes, self.bundle_bytes = folder, name, frame_bytes, bundle_bytes
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.number, self.file, self.frames, self.at = 0, None, [], 0
        self.waiting: list[tuple[str, bytes]] = []
        self.size = 0

    def add(self, key, data: bytes) -> list[tuple]:
        self.waiting.append((record_id(key), data))
        self.size += len(data)
        return self.end_frame() if self.size >= self.frame_bytes else []

    def end_frame(self) -> list[tuple]:
        if not self.waiting:
            return []
        if self.file is None:
            self.bundle = f"{self.name}-{self.number:04d}.warc.zst"
            self.file = self.files.open_output_stream(f"{self.folder}/{self.bundle}.part")
        packed = self.pack(b"".join(d for _, d in self.waiting))
        self.file.write(packed)
        rows, start = [], 0
        for name, data in self.waiting:
            rows.append((name, self.bundle, self.at, len(packed), start, len(data)))
            start += len(data)
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.waiting, self.size = [], 0
        if self.at >= self.bundle_bytes:
            self.end_bundle()
        return rows

    def end_bundle(self) -> None:
        if self.file is not None:
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.files.move(f"{self.folder}/{self.bundle}.part", f"{self.folder}/{self.bundle}")
            self.file, self.frames, self.at, self.number = None, [], 0, self.number + 1


def _writer(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        writer = BundleWriter(folder, name, frame_bytes, bundle_bytes)
        names = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                rows += writer.add(r["x_id"], record(r["x_id"], r["x_url"], r["x_payload"], r["x_refers"]))
            if rows:
                yield table(rows)
        rows = writer.end_frame()
        writer.end_bundle()
        if rows:
            yield table(rows)

    return run


def roles(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """``x_id, x_url, x_payload, x_refers``.  Payloads that occur once pass straight through; only
    possible repetitions shuffle."""
    text = as_text(payload_col)
    sized = F.octet_length(text)
    narrow = pages.select(field(id_col).alias("x_id"), F.sha1(text).alias("x_sha"), sized.alias("x_size"))
    groups = narrow.filter(F.col("x_size") >= least).groupBy("x_sha").agg(F.count(F.lit(1)).alias("x_n"), F.max("x_id").alias("x_last"))
    groups = materialize(groups.filter("x_n > 1").select(F.col("x_sha").alias("x_of"), "x_last"))
    words = bloom.words_for(groups.count())
    table = materialize(bloom.members(groups, F.xxhash64("x_of"), words))
    rows = pages.select(
        field(id_col).alias("x_id"),
        field(url_col).alias("x_url"),
        text.cast("binary").alias("x_payload"),
        F.sha1(text).alias("x_sha"),
    )
    flagged = bloom.probe(rows, F.xxhash64("x_sha"), table, words, "x_maybe")
    none = F.lit(None).cast(dict(narrow.dtypes)["x_id"])
    alone = flagged.filter("NOT x_maybe").select("x_id", "x_url", "x_payload", none.alias("x_refers"))
    joined = flagged.filter("x_maybe").join(groups, F.col("x_sha") == F.col("x_of"), "left")
    refers = F.when(F.col("x_id") < F.col("x_last"), F.col("x_last")).otherwise(none)
    return alone.unionByName(joined.select("x_id", "x_url", "x_payload", refers.alias("x_refers")))


def write(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> tuple[str, DataFrame]:
    """Write the bundles; the folder, and the stored index of all records."""
    from pyarrow import fs

    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    rows = roles(pages, id_col, url_col, payload_col, least)
    return folder, materialize(rows.mapInArrow(_writer(folder, frame_bytes, bundle_bytes), INDEX_SCHEMA))


def _reader(folder: str, columns: list[str], types: list):
    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for frame in batch.to_pylist():
                with files.open_input_file(f"{path}/{frame['bundle']}") as file:
                    if (frame["frame_start"], frame["frame_bytes"]) not in read_seek_table(file):
                        raise ValueError(f"{frame['bundle']}: no frame at {frame['frame_start']}")
                    file.seek(frame["frame_start"])
                    data = unpack(file.read(frame["frame_bytes"]))
                rows = [parse(data[p["start"] : p["start"] + p["bytes"]]) for p in frame["places"]]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(columns, types)], names=columns)

    return run


def read_records(spark: SparkSession, folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, read from their frames (each frame once)."""
    import pyarrow as pa

    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    if payloads:
        columns, types, schema = [*columns, "payload"], [*types, pa.binary()], schema + ", payload binary"
    # A frame holds about FRAME_BYTES of records, which bounds the list.
    frames = index.groupBy("bundle", "frame_start", "frame_bytes").agg(F.collect_list(F.struct("start", "bytes")).alias("places"))
    return frames.mapInArrow(_reader(folder, columns, types), schema)


def fetch(spark: SparkSession, folder: str, index: DataFrame, keys: list) -> DataFrame:
    """The records of some ids: only the frames that hold them are read."""
    return read_records(spark, folder, index.filter(F.col("record_id").isin([record_id(k) for k in keys])))
