"""Web archives of records in seekable Zstandard files.

Records are grouped into frames that are compressed independently. A skippable frame at the
end of the file holds the seek table (sizes of every frame), so a reader finds any frame without
reading the rest. The record index is a table: record id, file, frame, offset in the frame
before compression, size.

Records with equal payloads are stored once: that with the largest page_id is the response and
holds the payload, the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.files import attempt_name, create, reopen
from docketworks.llm.tables import through
from docketworks.sources.scratch import Scratch

# Fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")

FRAME_BYTES = 256_000
FILE_BYTES = 256_000_000
#: Smallest payload of which repeats become revisits.
LEAST_BYTES = 0
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("record_id string, page_id long, path string, frame int, offset long, size long")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long, payload binary")


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}"


def _line(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32_digest(payload)}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record_id(refers_to)}>"]
        if refers_to is not None:
            head.append(f"Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """The values of RECORD; the digest of a response is taken from its payload and compared."""
    head, _, block = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if version != "WARC/1.1" or kind == "response" and (
        base32_digest(payload) != digest or len(payload) != size
    ):
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    return (number("Page-ID"), fields.get("WARC-Target-URI"), size, digest, kind,
            number("Refers-To-Page-ID"), payload if kind == "response" else None)


class Bundle:
    """One file of frames; ``add`` tells frame and offset of a record."""

    def __init__(self, path: str, frame_bytes: int):
        import zstandard

        self.path, self.frame_bytes = path, frame_bytes
        self._out, self._zstd = create(path), zstandard.ZstdCompressor(level=3)
        self._frames: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._size = 0
        self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self._open and self._size + len(record) > self.frame_bytes:
            self._close_frame()
        place = len(self._frames), self._size
        self._open.append(record)
        self._size += len(record)
        self.total += len(record)
        return place

    def _close_frame(self) -> None:
        packed = self._zstd.compress(b"".join(self._open))
        self._out.write(packed)
        self._frames.append((len(packed), self._size))
        self._open, self._size = [], 0

    def close(self) -> None:
        if self._open:
            self._close_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self._frames)
        self._out.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER.size) + table)
        self._out.write(FOOTER.pack(len(self._frames), 0, SEEKABLE))
        self._out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, packed size, size) of every frame, from the end of the file."""
    end = source.size()
    count, _, magic = FOOTER.unpack(source.read_at(FOOTER.size, end - FOOTER.size))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    table = source.read_at(8 * count, end - FOOTER.size - 8 * count)
    found, at = [], 0
    for packed, size in struct.iter_unpack("<II", table):
        found.append((at, packed, size))
        at += packed
    return found


def read_frame(source, place: tuple[int, int, int]) -> bytes:
    import zstandard

    at, packed, size = place
    return zstandard.ZstdDecompressor().decompress(source.read_at(packed, at), max_output_size=size)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows), fields)],
        names=[name for name, _ in fields],
    )


def _writer(folder: str, date: str, frame_bytes: int, file_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []
        for batch in batches:
            page_ids, urls, payloads, refers, revisits = (c.to_pylist() for c in batch.columns)
            for page_id, url, payload, refers_to, revisit in zip(
                page_ids, urls, payloads, refers, revisits
            ):
                if bundle is None:
                    bundle = Bundle(attempt_name(folder, ".warc.zst"), frame_bytes)
                record = build_record(page_id, url, payload, refers_to, revisit, date)
                number, offset = bundle.add(record)
                rows.append((record_id(page_id), page_id, bundle.path, number, offset, len(record)))
                if bundle.total > file_bytes:
                    bundle.close()
                    bundle = None
            if rows:
                yield _batch(rows, INDEX)
                rows = []
        if bundle is not None:
            bundle.close()

    return work


def with_references(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and, of repeated payloads, which page holds it.

    Only ids and digests are compared; the payloads are not shuffled by their digest, so a
    payload that a third of all pages share is no burden for one task.
    """
    source = pages.select(
        F.col("page_id").cast("long"), "url",
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"),
    )
    keyed = source.select("page_id", F.sha1("payload").alias("_digest"),
                          F.octet_length("payload").alias("_bytes"))
    keyed = keyed.filter(F.col("_bytes") >= least_bytes).drop("_bytes")
    holders = keyed.groupBy("_digest").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_copies")
    ).filter("_copies > 1").drop("_copies")
    revisits = (
        keyed.join(holders, "_digest")
        .filter("page_id < refers_to OR (page_id IS NULL AND refers_to IS NOT NULL)")
        .distinct()
    )
    on = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (
        F.sha1("p.payload") == F.col("r._digest")
    )
    return source.alias("p").join(revisits.alias("r"), on, "left").select(
        "p.page_id", "p.url", "p.payload", "r.refers_to",
        F.col("r._digest").isNotNull().alias("revisit"),
    )


def write_archives(
    pages: DataFrame, scratch: Scratch, date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Archive ``pages`` (page_id, url, html); the stored index has a row per record.

    A null html is an empty payload, a null url leaves the target out. Of equal payloads the
    rows with the largest page_id are responses (all of them, if rows repeat it); null ids
    count as smallest. Control characters in a url are percent-encoded.
    An empty table gives no archive.
    """
    rows = with_references(pages)
    return scratch.stage(
        through(rows, INDEX, _writer(scratch.path("warc"), date, frame_bytes, file_bytes)), "warc-index"
    )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of (path, frame, places) rows; each frame is unpacked once."""
    path = source = table = None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["path"] != path:
                if source is not None:
                    source.close()
                path, source = row["path"], reopen(row["path"])
                table = seek_table(source)
            data = read_frame(source, table[row["frame"]])
            for place in row["places"]:
                rows.append(parse_record(data[place["offset"]:place["offset"] + place["size"]]))
            if sum(len(r[6] or b"") for r in rows) > 4_000_000:
                yield _batch(rows, RECORD)
                rows = []
        if rows:
            yield _batch(rows, RECORD)
    if source is not None:
        source.close()


def read_archives(index: DataFrame) -> DataFrame:
    """Every record that the index names; columns as in RECORD, ``payload`` null for revisits.

    A frame holds a bounded number of bytes, hence of records, and is read by one task.
    """
    frames = (
        index.groupBy("path", "frame").agg(F.collect_list(F.struct("offset", "size")).alias("places"))
        .sortWithinPartitions("path", "frame")
    )
    return through(frames, RECORD, _reader)
