"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Benchmark items are normalised to words and cut into windows of consecutive words. All
windows go into one automaton; a document is normalised once, scanned once, and every
match is mapped back to words and to characters of the original text. Words are joined by single
blanks with one at either end, so a match always covers whole words.

An automaton holds at most ``BLOCK_CHARS`` characters of windows. A benchmark beyond that is cut
into blocks, each with an automaton of its own, and all documents are scanned against every
block; nothing is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import ddl, through
from docketworks.sources.scratch import Scratch

# Fixed values of the rules: letters, digits and everything beyond ASCII make words
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
WINDOW = 10

BLOCK_CHARS = 8_000_000

FOUND = "doc_id long, n_words long, hit_words array<int>, items array<string>"
HITS = f"{FOUND}, spans array<struct<start: int, end: int>>"
PASSED = f"{FOUND}, text string"


def words(text: str | None) -> list[str]:
    return re.findall(WORD, (text or "").translate(LOWER))


def windows(text: str | None, size: int) -> Iterator[str]:
    """The windows of an item, ready for the automaton; a shorter item is one window."""
    found = words(text)
    for i in range(max(1, len(found) - size + 1) if found else 0):
        yield f" {' '.join(found[i:i + size])} "


def blocks(items: Iterable[tuple[str | None, str | None]], size: int, most: int
           ) -> Iterator[list[tuple[str | None, str]]]:
    """(item, text) pairs in blocks of bounded length of their windows."""
    block, used = [], 0
    for item, text in items:
        need = len(text or "") * size
        if block and used + need > most:
            yield block
            block, used = [], 0
        block.append((item, text or ""))
        used += need
    if block:
        yield block


class Scanner:
    """Items as an automaton."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        import ahocorasick

        self.names: list[str | None] = []
        owners: dict[str, set[int]] = {}
        numbers: dict[str | None, int] = {}
        for item, text in items:
            if item not in numbers:
                numbers[item] = len(self.names)
                self.names.append(item)
            for window in windows(text, size):
                owners.setdefault(window, set()).add(numbers[item])
        self.automaton = ahocorasick.Automaton()
        for window, who in owners.items():
            self.automaton.add_word(window, (window.count(" ") - 1, tuple(who)))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, np.ndarray, set[int]]:
        """Number of words, positions of hit words, numbers of items."""
        found = words(text)
        if self.empty or not found:
            return len(found), np.zeros(0, np.int64), set()
        line = f" {' '.join(found)} "
        matches = list(self.automaton.iter(line))
        if not matches:
            return len(found), np.zeros(0, np.int64), set()
        ends = np.cumsum([1 + len(w) for w in found])  # the blank behind each word
        marks = np.zeros(len(found) + 1, np.int64)
        last = np.searchsorted(ends, [end for end, _ in matches])
        first = last - np.array([size for _, (size, _) in matches]) + 1
        np.add.at(marks, first, 1)
        np.add.at(marks, last + 1, -1)
        return len(found), np.flatnonzero(np.cumsum(marks[:-1]) > 0), {
            n for _, (_, who) in matches for n in who
        }


def spans_of(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as places in the original text."""
    if not len(hit):
        return []
    places = [m.span() for m in re.finditer(WORD, text.translate(LOWER))]
    breaks = np.flatnonzero(np.diff(hit) > 1)
    firsts, lasts = np.r_[hit[0], hit[breaks + 1]], np.r_[hit[breaks], hit[-1]]
    return [{"start": places[a][0], "end": places[b][1]} for a, b in zip(firsts, lasts)]


@lru_cache(maxsize=2)
def _scanner(items: tuple[tuple[str | None, str], ...], size: int) -> Scanner:
    return Scanner(list(items), size)


def _scan(shared, size: int, last: bool):
    """One pass; from the second on, rows bring what earlier passes found."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(shared.value, size)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            rows = batch.to_pydict()
            texts = rows["text"]
            counts, hits, items = [], [], []
            for i, text in enumerate(texts):
                count, hit, who = scanner.scan(text)
                names = {scanner.names[n] for n in who} - {None}
                if "items" in rows:
                    hit = np.union1d(hit, np.array(rows["hit_words"][i], np.int64))
                    names |= set(rows["items"][i])
                counts.append(count)
                hits.append(hit)
                items.append(sorted(names))
            columns = {
                "doc_id": batch.column(0), "n_words": pa.array(counts, pa.int64()),
                "hit_words": pa.array([h.tolist() for h in hits], pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            if last:
                columns["spans"] = pa.array(
                    [spans_of(text or "", hit) for text, hit in zip(texts, hits)], pa.list_(span)
                )
            else:
                columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return work


def _clean(shared, size: int, at: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(shared.value, size)
        for batch in batches:
            clean = [not len(scanner.scan(text)[1]) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return work


def _shared_blocks(benchmark: DataFrame, size: int, most: int) -> Iterator[tuple]:
    """Every block of items as a broadcast of bounded size, and whether it is the last."""
    context = benchmark.sparkSession.sparkContext
    ahead = blocks(_items(benchmark), size, most)
    block = next(ahead, [])
    while block is not None:
        following = next(ahead, None)
        yield context.broadcast(tuple(block)), following is None
        block = following


def _items(benchmark: DataFrame) -> Iterator[tuple[str | None, str | None]]:
    """Items in one order, a partition at a time on the driver."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text")
    return (tuple(r) for r in rows.orderBy("item_id", "text").toLocalIterator())


def scan(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``hit_words`` (places of words), ``items`` and ``spans`` (characters).

    A document word is hit if it lies in any occurrence of a window of an item; ``items`` are
    the ids, as strings in order, of the items with such windows, and ``spans`` the runs of hit
    words in the original text. Null or empty texts have no words. An item without words has no
    window; one without an id marks words but is not among ``items``; repeated ids count as one
    item. With an empty benchmark nothing is hit. Rows are handled one by one, so null and repeated
    document ids pass through.
    """
    frame = docs.select(F.col("doc_id").cast("long"), "text")
    for shared, last in _shared_blocks(benchmark, window, block_chars):
        frame = through(frame, HITS if last else PASSED, _scan(shared, window, last))
        if not last:
            frame = scratch.stage(frame, "scanned")
    return frame


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` in which ``scan`` finds no hit, with all their columns."""
    frame, at = docs, docs.columns.index("text")
    for shared, last in _shared_blocks(benchmark, window, block_chars):
        frame = through(frame, ddl(docs), _clean(shared, window, at))
        if not last:
            frame = scratch.stage(frame, "cleaned")
    return frame


def report(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """``scan`` with ``n_hit``, ``n_items``, ``items_sha256`` (of the ids, comma-joined) and ``contaminated``."""
    return scan(docs, benchmark, scratch, window).withColumns({
        "n_hit": F.size("hit_words").cast("long"),
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
    }).withColumn("contaminated", F.col("n_hit") > 0)
