"""Packing of token ids into windows of fixed size, with a bounded number of open windows.

Every task packs its own rows in one pass. A document is cut into full windows; its rest
goes into the open window that it fills best. When it fits none and no further window may
be opened, the fullest is topped up with a piece of it and emitted. What is left open at
the end of the tasks is packed again in rounds, many tasks into one, until one group is left;
there the remaining windows are merged, so that at most one window of all is far from full.

Open windows are the only state of a task: ``open_windows * window`` ids.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import through
from docketworks.llm.tokens import chunk_encoder
from docketworks.sources.scratch import Scratch

WINDOW = 2048
OPEN_WINDOWS = 32
MERGED_TASKS = 32
#: A gap below this many ids is padded: no document gets a piece that short only to fill it.
SHORTEST_CUT = 8

PIECE = ("doc_id long, start long, doc_tokens long, sequence_id long, offset long, "
         "length long, ids binary, open boolean")


@dataclass
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    used: int = 0


class Packer:
    """Best fit with at most ``open_windows`` open; full windows come out of ``add``."""

    def __init__(self, window: int, open_windows: int, shortest_cut: int = SHORTEST_CUT):
        self.window, self.most, self.shortest_cut = window, open_windows, shortest_cut
        self.gaps: list[tuple[int, int]] = []  # (free ids, number of the window), ascending
        self.open: dict[int, Window] = {}
        self._next = 0

    def _put(self, number: int, piece: Piece) -> Window | None:
        target = self.open[number]
        target.pieces.append(piece)
        target.used += len(piece.ids)
        if target.used == self.window:
            return self.open.pop(number)
        insort(self.gaps, (self.window - target.used, number))
        return None

    def add(self, piece: Piece) -> Iterator[Window]:
        ids, at = piece.ids, 0
        while at < len(ids):
            size = min(self.window, len(ids) - at)
            place = bisect_left(self.gaps, (size, -1))
            if size == self.window:
                done = Window([Piece(piece.doc_id, piece.start + at, piece.doc_tokens,
                                     ids[at:at + size])], size)
            elif place < len(self.gaps):
                _, number = self.gaps.pop(place)
                done = self._put(number, Piece(piece.doc_id, piece.start + at, piece.doc_tokens,
                                               ids[at:at + size]))
            elif len(self.open) < self.most:
                self._next += 1
                self.open[self._next] = Window()
                done = self._put(self._next, Piece(piece.doc_id, piece.start + at,
                                                   piece.doc_tokens, ids[at:at + size]))
            else:
                gap, number = self.gaps.pop(0)
                if gap < self.shortest_cut:
                    yield self.open.pop(number)
                    continue
                size = gap
                done = self._put(number, Piece(piece.doc_id, piece.start + at, piece.doc_tokens,
                                               ids[at:at + size]))
            if done is not None:
                yield done
            at += size

    def rest(self) -> list[Window]:
        windows = [self.open[n] for n in sorted(self.open)]
        self.open, self.gaps = {}, []
        return windows


class _Rows:
    """Windows as rows, numbered within one task of one round."""

    def __init__(self, round_number: int, task: int):
        self.first = (round_number << 56) | (task << 32)
        self.count = 0
        self.rows: list[tuple] = []
        self.bytes = 0

    def put(self, window: Window, still_open: bool) -> None:
        number, offset = self.first + self.count, 0
        self.count += 1
        for p in window.pieces:
            blob = np.ascontiguousarray(p.ids, dtype="<u4").tobytes()
            self.rows.append((p.doc_id, p.start, p.doc_tokens, number, offset, len(p.ids),
                              blob, still_open))
            offset += len(p.ids)
            self.bytes += len(blob)

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.rows and self.bytes >= least:
            kinds = (pa.int64(),) * 6 + (pa.binary(), pa.bool_())
            names = [part.split()[0] for part in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*self.rows), kinds)], names=names
            )
            self.rows, self.bytes = [], 0


def _pack_texts(path: str, end_id: int, window: int, open_windows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = chunk_encoder(path), Packer(window, open_windows)
        out = _Rows(0, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            end = np.array([end_id], np.uint32)
            for doc_id, ids in zip(doc_ids, encoder.encode(batch.column(1).to_pylist())):
                ids = np.concatenate([ids, end])
                for done in packer.add(Piece(doc_id, 0, len(ids), ids)):
                    out.put(done, False)
                yield from out.take(2_000_000)
        for left in packer.rest():
            out.put(left, True)
        yield from out.take()

    return work


def _pack_again(rows: pa.Table, round_number: int, group: int, window: int, open_windows: int,
                last: bool) -> pa.Table:
    """The open pieces of one group, longest first; ``last`` leaves nothing open."""
    pieces = [
        Piece(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))
        for r in rows.to_pylist()
    ]
    pieces.sort(key=lambda p: (-len(p.ids), p.doc_id is None, p.doc_id or 0, p.start))
    out, packer = _Rows(round_number, group), Packer(window, open_windows)
    for p in pieces:
        for done in packer.add(p):
            out.put(done, False)
    left = packer.rest()
    if last:
        merged = Packer(window, 1, 1)
        for p in [p for w in sorted(left, key=lambda w: -w.used) for p in w.pieces]:
            for done in merged.add(p):
                out.put(done, False)
        left = merged.rest()
    for w in left:
        out.put(w, not last)
    return pa.Table.from_batches(out.take(), rows.schema) if out.rows else rows.slice(0, 0)


def _pack_group(round_number: int, window: int, open_windows: int, last: bool):
    def work(key, rows):
        return _pack_again(rows.drop_columns(["_group"]), round_number, key[0].as_py(), window,
                           open_windows, last)

    return work


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, scratch: Scratch, window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place in a sequence.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``doc_tokens``,
    ``sequence_id``, ``offset`` (ids of the sequence before it), ``length`` and ``ids``
    (little-endian unsigned 32-bit). A null text counts as empty and so has the end id only;
    rows with a null or repeated ``doc_id`` are packed like others. Other columns are not
    looked at. An empty table gives no pieces.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    staged = scratch.stage(
        through(source, PIECE, _pack_texts(tokenizer_path, end_id, window, open_windows)), "packed"
    )
    done, rest = [staged.filter("NOT open")], staged.filter("open")
    tasks = rest.agg(F.max(F.shiftright("sequence_id", 32))).first()[0]
    groups, round_number = (tasks + 1 if tasks is not None else 0), 0
    while groups:
        groups = -(-groups // MERGED_TASKS) if groups > 1 else 1
        round_number += 1
        last = groups == 1
        task = F.shiftright("sequence_id", 32).bitwiseAND(F.lit((1 << 24) - 1))
        group = F.floor(task / MERGED_TASKS)

        # a group holds the open windows of a fixed number of tasks
        merged = scratch.stage(
            rest.withColumn("_group", group.cast("long")).groupBy("_group")
            .applyInArrow(_pack_group(round_number, window, open_windows, last), PIECE),
            f"merged-{round_number}",
        )
        done.append(merged.filter("NOT open"))
        rest = merged.filter("open")
        if last:
            break
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("open")
