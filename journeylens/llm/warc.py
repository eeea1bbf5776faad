"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with whole records, followed by a skippable frame that holds
the seek table (compressed and decompressed size of each frame, then the footer of the seekable format). An index row
maps each record to its bundle, its frame and its place in that frame, so one record is read by decompressing
one frame. Tasks write their bundles to a shared folder, under names that no other attempt uses; only those named in the
written index exist for readers, so lost or repeated tasks leave nothing wrong behind.

Equal payloads of at least MIN_REVISIT bytes are stored once: by the largest page_id; the others are revisit records.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, scratch_path

MIN_REVISIT = 1000
#: Decompressed bytes from which on a frame is closed, and compressed bytes or records from which on a bundle is.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES, BUNDLE_RECORDS = 64 << 20, 200_000
LEVEL = 3
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, bundle string, frame int, start long, length long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit has no block, but the digest and length of the payload it stands for."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    name = uuid.uuid5(uuid.NAMESPACE_OID, f"page {page_id} {url}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.encode("unicode_escape").decode("ascii"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at `start`."""
    split = data.index(b"\r\n\r\n", start)
    version, *lines = data[start:split].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines)
    end = split + 4 + int(headers["Content-Length"])
    return headers, data[split + 4 : end], end + 4


class BundleWriter:
    """Records into frames of a file; `close` appends the seek table."""

    def __init__(self, sink):
        self.sink, self.frames, self.held, self.size, self.records = sink, [], bytearray(), 0, 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame, place in it and length of the record."""
        if self.held and len(self.held) + len(data) > FRAME_BYTES:
            self.flush()
        place = len(self.held)
        self.held += data
        self.records += 1
        return len(self.frames), place, len(data)

    def flush(self) -> None:
        if self.held:
            packed = self.compressor.compress(bytes(self.held))
            self.sink.write(packed)
            self.frames.append((len(packed), len(self.held)))
            self.size += len(packed)
            self.held.clear()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.sink.close()


def seek_table(file) -> list[tuple[int, int]]:
    """(place in the file, compressed bytes) of each frame, read from the end of the file."""
    size = file.size()
    file.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * frames)
    table, at, out = file.read(8 * frames), 0, []
    for packed, _ in struct.iter_unpack("<II", table):
        out.append((at, packed))
        at += packed
    return out


def _frame(file, place: tuple[int, int]) -> bytes:
    file.seek(place[0])
    return zstandard.ZstdDecompressor().decompress(file.read(place[1]))


def assign(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload, digest and refers_to (null unless the record is a revisit).

    Of rows that repeat the largest page_id of a payload all are responses; a row without an id is one too.
    """
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= MIN_REVISIT
    first = materialize(
        hashed.filter(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    return hashed.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to")
    )


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the bundles to `folder`, a URI that tasks can write to, and returns the index, itself a written table."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer = name = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                index: list[tuple] = []
                for page_id, url, payload, digest, refers_to in zip(*(c.slice(at, 256) for c in batch.columns)):
                    if writer is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        writer = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None))
                    data = record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py())
                    index.append((page_id.as_py(), name, *writer.add(data)))
                    if writer.size >= BUNDLE_BYTES or writer.records >= BUNDLE_RECORDS:
                        writer.close()
                        writer = None
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*index), kinds)], ["page_id", "bundle", "frame", "start", "length"]
                )
        if writer is not None:
            writer.close()

    return materialize(assign(pages).mapInArrow(apply, INDEX))


def _read(folder: str, with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def row(headers: dict[str, str], block: bytes) -> tuple:
        number = lambda name: int(headers[name]) if name in headers else None
        url, kind = headers.get("WARC-Target-URI"), headers["WARC-Type"]
        digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
        if kind == "response" and (hashlib.sha1(block).hexdigest() != digest or len(block) != size):
            raise ValueError(f"record of page {headers.get('X-Page-ID')} is damaged")
        return (
            number("X-Page-ID"), url and url.encode("ascii").decode("unicode_escape"), kind, size, digest,
            number("X-Refers-To-Page"), block if with_payload and kind == "response" else None,
        )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, frames in zip(batch.column(0), batch.column(1)):
                with store.open_input_file(f"{root}/{name.as_py()}") as file:
                    table = seek_table(file)
                    for number, places in sorted((f["frame"], f["places"]) for f in frames.as_py()):
                        data = _frame(file, table[number])
                        rows = [row(*parse(data, start)[:2]) for start in sorted(places)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return apply


def read(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of index rows, read from their bundles: a frame is decompressed only if the index asks for it.

    The payload of a revisit is null; that of its response is in the record of page refers_to.
    """
    frames = index.groupBy("bundle", "frame").agg(F.collect_list("start").alias("places"))
    bundles = frames.groupBy("bundle").agg(F.collect_list(F.struct("frame", "places")).alias("frames"))
    return bundles.mapInArrow(_read(folder, with_payload), RECORDS)


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Writes all pages to a new shared folder; gives the index and the folder."""
    folder = scratch_path(pages.sparkSession)
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    return write(pages, folder), folder
