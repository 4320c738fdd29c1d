"""Token ids as length-delimited binary records with checksums and an offset index.

File: one frame per document, in order of doc_id. Frame: payload length (unsigned 64-bit),
its masked checksum, payload, masked checksum of the payload; all little-endian. A checksum
is CRC-32, rotated right by 15 bits plus a constant, so that data holding checksums
does not look like a checksum of itself. Payload: 1 byte (1 if the document has an id), id
(signed 64-bit), then the token ids as unsigned numbers of 2 or 4 bytes.

Index: a file of its own beside each record file with 24 bytes per record: doc_id, offset
of the frame, size of the frame. Training jobs that read in random order load the indexes only.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketworks.llm.files import attempt_name, create, reopen
from docketworks.llm.tables import through
from docketworks.llm.tokens import chunk_encoder
from docketworks.sources.scratch import Scratch

MASK_DELTA = 0xA282EAD8
LENGTH, CHECK, HEAD, ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<Bq"), struct.Struct("<qQQ")
READ_BYTES = 4_000_000
#: Bytes of record files that one task reads, but for a file that has more.
TASK_BYTES = 32_000_000

MANIFEST = "part int, path string, index_path string, records long, tokens long"
RECORD = "doc_id long, start long, n_tokens long, ids binary"


class BrokenRecord(ValueError):
    """A length or a checksum does not fit the data."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def unframe(take) -> bytes | None:
    """The next payload; ``take(n)`` gives the next n bytes, fewer only at the end."""
    head = take(12)
    if not head:
        return None
    if len(head) < 12 or CHECK.unpack(head[8:])[0] != masked(head[:8]):
        raise BrokenRecord("length")
    size = LENGTH.unpack(head[:8])[0]
    body = take(size + 4)
    if len(body) < size + 4 or CHECK.unpack(body[size:])[0] != masked(body[:size]):
        raise BrokenRecord("payload")
    return body[:size]


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return HEAD.pack(doc_id is not None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def parse_payload(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    known, doc_id = HEAD.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=HEAD.size)


def entry(doc_id: int | None, at: int, size: int) -> bytes:
    return ENTRY.pack(doc_id or 0, at, size)


def _writer(path: str, end_id: int, width: int, folder: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = chunk_encoder(path), np.array([end_id], np.uint32)
        out = index = None
        records = tokens = at = 0
        for batch in batches:
            if out is None:
                name = attempt_name(folder, "")
                out, index = create(f"{name}.rec"), create(f"{name}.idx")
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, encoder.encode(batch.column(1).to_pylist())):
                ids = np.concatenate([ids, end])
                data = frame(payload_of(doc_id, ids, width))
                out.write(data)
                index.write(entry(doc_id, at, len(data)))
                records, tokens, at = records + 1, tokens + len(ids), at + len(data)
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "path": f"{name}.rec",
                "index_path": f"{name}.idx", "records": records, "tokens": tokens,
            }], schema=pa.schema([("part", pa.int32()), ("path", pa.string()),
                                  ("index_path", pa.string()), ("records", pa.int64()),
                                  ("tokens", pa.int64())]))

    return work


def write_records(
    docs: DataFrame, tokenizer_path: str, end_id: int, scratch: Scratch, width: int = 2
) -> DataFrame:
    """Write ``docs`` (doc_id, text) in order of doc_id; the manifest has a row per file.

    Files hold ascending ranges of doc_id and are numbered by ``part``. A null text counts as
    empty and gives a record of the end id only; null ids come first; rows with the same id keep
    one order by their text. An empty table gives no file. ``width`` is the bytes of an id and
    must be 4 for a vocabulary of more than 65,536 ids.
    """
    if width not in (2, 4):
        raise ValueError("width must be 2 or 4")
    folder = scratch.path("records")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    return scratch.stage(
        through(ordered, MANIFEST, _writer(tokenizer_path, end_id, width, folder)), "manifest"
    )


def _reader(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids", pa.binary())])
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size = [], 0
                with reopen(path) as source:
                    stream = pa.BufferedInputStream(source, 1 << 20)
                    while (payload := unframe(lambda n: _exactly(stream, n))) is not None:
                        doc_id, ids = parse_payload(payload, width)
                        rows.append((doc_id, before, len(ids), ids.astype("<u4").tobytes()))
                        before, size = before + len(ids), size + 4 * len(ids)
                        if size > READ_BYTES:
                            yield _columns(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield _columns(rows, schema)

    return work


def _exactly(stream, count: int) -> bytes:
    found = stream.read(count)
    while len(found) < count and (more := stream.read(count - len(found))):
        found += more
    return found


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), schema.types)], schema=schema
    )


def read_records(manifest: DataFrame, width: int = 2) -> DataFrame:
    """All documents of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (unsigned 32-bit).

    ``start`` counts the ids of all documents before; totals of the files come from the manifest.
    """
    # a row per file, as in the manifest
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "path", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("_before"))
    tokens = manifest.agg(F.sum("tokens")).first()[0] or 0
    # the manifest is tiny whatever its files hold, so adaptive execution would read them all in one task
    tasks = max(1, -(-tokens * width // TASK_BYTES))
    spread = files.repartitionByRange(tasks, "part").select("path", "_before")
    return through(spread, RECORD, _reader(width))


def fetch(manifest_rows: list, doc_ids: list[int], width: int = 2) -> dict[int, list[np.ndarray]]:
    """Single documents through the index files, as a shuffled training reader takes them."""
    wanted, found = set(doc_ids), {d: [] for d in doc_ids}
    for row in manifest_rows:
        with reopen(row["index_path"]) as index:
            entries = ENTRY.iter_unpack(index.read())
            hits = [(d, at, size) for d, at, size in entries if d in wanted]
        if hits:
            with reopen(row["path"]) as source:
                for doc_id, at, size in hits:
                    data = source.read_at(size, at)
                    ends = list(accumulate((12, size - 12)))
                    parts = iter((data[:ends[0]], data[ends[0]:]))
                    known, ids = parse_payload(unframe(lambda n: next(parts)[:n]), width)
                    if known is not None:
                        found[doc_id].append(ids)
    return found
