"""WARC archives in seekable Zstandard bundles.

A bundle is a file in the shared folder: independent frames, each of some whole records, and a seek table as a last skippable
frame (public seekable format: sizes of each frame packed and unpacked, number of frames, magic). The index maps a record
identifier to bundle, frame, the frame's place in the file and the record's place in the frame, so one record costs one frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import batch, materialize, shared_dir, sliced

#: Bytes of records gathered in a frame; a longer record has a frame to itself.
FRAME = 1 << 18
#: Bytes of payloads in a bundle, and in one of a small table, which is spread over all cores.
BUNDLE, SPREAD = 1 << 30, 4 << 20
#: Smaller payloads are all stored; 0 lets every repeated payload be a revisit.
LEAST = 0
LEVEL, DATE = 3, "2000-01-01T00:00:00Z"
#: Fixed values of the seekable format and of the WARC standard.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()), ("frame_offset", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
INDEX_TYPE = "record_id string, page_id long, bundle string, frame long, frame_offset long, offset long, length long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def identifier(page_id: int | None, number: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{number}').urn}>"


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with the payload, or a revisit record with its HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record that starts there, and where the next starts."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    stop = end + 4 + int(head["Content-Length"])
    return head, raw[end + 4 : stop], stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(place, packed size, unpacked size) of each frame of a bundle."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_MAGIC or flags:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    raw, out, at = file.read(8 * n), [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


class Bundle:
    """Writes one bundle; records go to frames in the order given."""

    def __init__(self, file):
        self.file, self.packer = file, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.sizes, self.parts, self.held, self.at = [], [], 0, 0

    def add(self, raw: bytes) -> tuple[int, int, int]:
        """Frame, the frame's place in the file and the record's place in the frame."""
        if self.held and self.held + len(raw) > FRAME:
            self.flush()
        where = (len(self.sizes), self.at, self.held)
        self.parts.append(raw)
        self.held += len(raw)
        return where

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.parts))
            self.file.write(packed)
            self.sizes.append((len(packed), self.held))
            self.at += len(packed)
            self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        self.file.write(seek_table(self.sizes))


def named(number: int) -> str:
    return f"bundle-{number:06d}.warc.zst"


def _write(folder: str):
    def run(batches):
        there, root = fs.FileSystem.from_uri(folder)
        there.create_dir(root)
        task = TaskContext.get()
        name = named(task.partitionId())
        own = f"{root}/.{name}.{task.taskAttemptId()}"
        used, earlier = False, (None, None)
        with there.open_output_stream(own) as file:
            bundle = Bundle(file)
            for x in sliced(batches):
                rows = []
                for page_id, number, url, html, digest, refers_to in zip(*(c.to_pylist() for c in x.columns)):
                    if digest is None:  # says where the next record's payload stands
                        earlier = number, refers_to
                        continue
                    refers_to = earlier[1] if earlier[0] == number else None
                    record_id = identifier(page_id, number)
                    raw = record(record_id, page_id, url, (html or "").encode("utf-8"), base64.b32encode(bytes.fromhex(digest)).decode(), refers_to)
                    rows.append((record_id, page_id, name, *bundle.add(raw), len(raw)))
                if rows:
                    used = True
                    yield batch(dict(zip(INDEX.names, zip(*rows))), INDEX)
            bundle.close()
        there.move(own, f"{root}/{name}") if used else there.delete_file(own)

    return run


def write(pages: DataFrame, folder: str | None = None, bundles: int | None = None, least: int = LEAST) -> tuple[str, DataFrame]:
    """Write a record per page; returns the folder and the index of the records.

    A bundle is written under its attempt's name and renamed when it is whole, and depends on its rows alone, so a task that
    runs again gives the same file. Null html is an empty payload, a null url has no target, control characters
    of a url are percent-encoded. Of records with equal payloads of `least` bytes or more the smallest page_id is the
    response (a null page_id comes last; of repeated rows one). An empty table gives an empty index.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    own = own.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))).withColumn("size", F.coalesce(F.octet_length("html"), F.lit(0)))
    own = materialize(own.withColumn("number", F.monotonically_increasing_id()), "pages", "zstd")
    narrow = own.where(F.col("size") >= least).select("number", "page_id", "digest")
    order = F.struct(F.col("page_id").isNull(), "page_id", "number")
    first = materialize(narrow.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.number").alias("kept")), "first")
    again = narrow.join(first, "digest").where(F.col("number") != F.col("kept")).select("number", "refers_to")
    total = own.agg(F.sum("size")).first()[0] or 0
    bundles = bundles or max(1, -(-total // BUNDLE), min(2 * spark.sparkContext.defaultParallelism, -(-total // SPREAD)))
    none = F.lit(None)
    columns = ("page_id", "number", "url", "html", "digest", "refers_to")
    rows = own.select(*columns[:5], none.cast("long").alias("refers_to")).union(again.select(none, "number", none, none, none, "refers_to"))  # not joined: pages move once
    rows = rows.repartition(bundles, "number").sortWithinPartitions("number", F.asc_nulls_first("digest")).select(*columns)
    return folder, materialize(rows.mapInArrow(_write(folder), INDEX_TYPE), "index")


def _read(folder: str):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        there, root = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for x in batches:
            for name in map(named, x.column(0).to_pylist()):
                if there.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:  # a task without rows left none
                    continue
                size = there.get_file_info(f"{root}/{name}").size
                with there.open_input_file(f"{root}/{name}") as file:
                    for at, packed, plain in read_seek_table(file, size):
                        file.seek(at)
                        raw, k, rows = unpack.decompress(file.read(packed), max_output_size=plain), 0, []
                        while k < len(raw):
                            head, block, k = parse(raw, k)
                            http, payload = block.split(b"\r\n\r\n", 1)
                            length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                            if head["WARC-Type"] == "response" and (len(payload) != length or base32_sha1(payload) != digest):
                                raise ValueError(f"{name}: the payload of {head['WARC-Record-ID']} is damaged")
                            number = lambda key: int(head[key]) if key in head else None  # noqa: B023, E731
                            rows.append((number("X-Page-ID"), length, digest, head["WARC-Type"], number("X-Refers-To-Page-ID")))
                        yield batch(dict(zip(schema.names, zip(*rows))), schema)

    return run


def read(folder: str, index: DataFrame) -> DataFrame:
    """All records of the bundles that an index names, with payloads checked against their digests; a task for each bundle, and no shuffle."""
    last = index.agg(F.max(F.regexp_extract("bundle", r"-(\d+)\.", 1).cast("long"))).first()[0]
    n = 0 if last is None else last + 1
    return index.sparkSession.range(0, n, 1, max(1, n)).mapInArrow(_read(folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def fetch(folder: str, where: dict) -> tuple[dict[str, str], bytes]:
    """One record by its row of the index: reads and unpacks its frame alone."""
    there, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{where['bundle']}"
    with there.open_input_file(path) as file:
        at, packed, plain = read_seek_table(file, there.get_file_info(path).size)[where["frame"]]
        assert at == where["frame_offset"]
        file.seek(at)
        raw = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
    return parse(raw, where["offset"])[:2]


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages, then read the archives back: a row per page."""
    return read(*write(pages))
