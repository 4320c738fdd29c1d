"""Main text of web pages, with a suffix array over the pages of each host.

Every page becomes blocks of words; a block stands in an article, in chrome (menus, footers,
forms and the like, by tag, role, class or id) or in neither. The word streams of the pages of a host are put
one after another and their suffixes sorted as deep as the shortest run of interest; neighbours
in that order that agree so far and come from different pages are repeated runs.

What the runs decide:
* words in neither article nor chrome go where runs cover them, and stay elsewhere;
* a container of chrome goes as a whole if runs cover at least ``SHARE`` of its words, the unique rest (a
  date, a name) with it;
* words in an article never go, for a passage that several articles share is text of each.
Only a container of which the host gives less evidence (a single page, words of one page's own) is
decided by its markup, which drops it too. ``run_words`` and ``markup_words`` tell how many words went by
which; without ``by_markup`` such containers keep what no run covers.

A host of many or large pages is cut into groups of bounded size. Runs with text in neither article nor
chrome are compared across the groups by a hash of each run, counted over the whole host; containers are
compared within a group. The parsed pages are shuffled once and nothing is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.markup import CHROME, PLAIN, contained_blocks
from docketworks.llm.tables import through

#: Words of the shortest repeated run; a power of two, as sorting doubles its depth.
RUN = 8
#: Share of a container's words that runs must cover for it to go as a whole.
SHARE = 0.5
PAGES_PER_GROUP = 1024
#: Bytes of html per group, but for a page that has more.
GROUP_BYTES = 64_000_000
#: Most large hosts whose table is broadcast; beyond, Spark joins it as it sees fit.
BROADCAST_HOSTS = 100_000

PARSED = ("page_id long, url string, host string, part long, lines string, zones array<int>, stream long, "
          "containers array<int>")
TEXTS = "page_id long, url string, text string, run_words long, markup_words long"
RUNS = "host string, part long, stream long, run long"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(hashes: np.ndarray, run: int) -> np.ndarray:
    """A hash of every ``run`` neighbouring words; empty for fewer words."""
    if len(hashes) < run:
        return np.zeros(0, np.uint64)
    mixed = np.zeros(len(hashes) - run + 1, np.uint64)
    for i in range(run):
        mixed = mixed * FACTOR + hashes[i:len(hashes) - run + 1 + i]
        mixed ^= mixed >> np.uint64(31)
    return mixed


def _word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _stream(lines: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(lines)).astype(np.int64))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A line of words per block."""
    for batch in batches:
        found = [list(contained_blocks(page)) for page in batch.column(4).to_pylist()]
        lines = ["\n".join(" ".join(words) for *_, words in mine) for mine in found]
        yield pa.RecordBatch.from_arrays([
            *batch.columns[:4], pa.array(lines, pa.string()),
            pa.array([[zone for zone, *_ in mine] for mine in found], pa.list_(pa.int32())),
            pa.array([_stream(x) for x in lines], pa.int64()),
            pa.array([[container for _, container, _ in mine] for mine in found], pa.list_(pa.int32())),
        ], names=["page_id", "url", "host", "part", "lines", "zones", "stream", "containers"])


def _words_of(lines: str, zones: list[int]) -> tuple[list[str], list[int], np.ndarray]:
    """All words, the words of each block, and the zone of each word."""
    by_block = [line.split(" ") for line in lines.split("\n")] if zones else []
    sizes = [len(b) for b in by_block]
    return [w for b in by_block for w in b], sizes, np.repeat(np.array(zones, np.int64), sizes)


def _undecided(zone: np.ndarray, run: int) -> np.ndarray:
    """Starts of runs with a word that its markup leaves undecided; no other run changes a text."""
    if len(zone) < run:
        return np.zeros(0, np.int64)
    plain = np.concatenate([[0], np.cumsum(zone == PLAIN)])
    return np.flatnonzero(plain[run:] > plain[:-run])


def _runs(run: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parse(batches):
            host, part, stream, hashes = [], [], [], []
            for h, g, lines, zones, s in zip(*(batch.column(i).to_pylist() for i in range(2, 7))):
                words, _, zone = _words_of(lines, zones)
                starts = _undecided(zone, run)
                if len(starts):
                    mine = np.unique(window_hashes(_word_hashes(words), run)[starts]).astype(np.int64)
                    hashes.append(mine)
                    for column, value in ((host, h), (part, g), (stream, s)):
                        column += [value] * len(mine)
            if hashes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(host, pa.string()), pa.array(part, pa.int64()), pa.array(stream, pa.int64()),
                     pa.array(np.concatenate(hashes))], names=["host", "part", "stream", "run"])

    return work


def suffix_order(symbols: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``run`` symbols, and the rank of each suffix so far.

    Prefix doubling: ranks of length h and of the suffix h further on give ranks of length 2h.
    """
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    depth = 1
    while depth < run:
        behind = np.full(len(rank), -1, np.int64)
        behind[:-depth] = rank[depth:]
        _, rank = np.unique(rank * (len(rank) + 1) + behind + 1, return_inverse=True)
        rank = rank.astype(np.int64)
        depth *= 2
    return np.argsort(rank, kind="stable"), rank


def repeated(symbols: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """Starts of runs that pages of at least two different ``page`` numbers hold.

    Pages are separated by symbols of their own, so no run crosses a border.
    """
    if not len(symbols):
        return np.zeros(0, np.int64)
    order, rank = suffix_order(symbols, run)
    same = rank[order][1:] == rank[order][:-1]  # neighbours that agree in all their first symbols
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    low = np.minimum.reduceat(page[order], first)
    high = np.maximum.reduceat(page[order], first)
    sizes = np.diff(np.concatenate([first, [len(order)]]))
    return order[np.repeat(low < high, sizes)]


def cover(starts: np.ndarray, length: int, run: int) -> np.ndarray:
    marks = np.zeros(length + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + run, length), -1)
    return np.cumsum(marks[:-1]) > 0


def _went(zone: np.ndarray, container: np.ndarray, covered: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Words that runs remove, and words of chrome that they leave to the markup."""
    chrome = zone == CHROME
    words = np.bincount(container[chrome])
    hit = np.bincount(container[chrome], weights=covered[chrome], minlength=len(words))
    whole = np.zeros(len(zone), bool)
    whole[chrome] = (hit >= share * words)[container[chrome]]
    by_runs = whole | (zone == PLAIN) & covered
    return by_runs, chrome & ~whole


def _group(run: int, share: float, by_markup: bool):
    """Texts of the pages of one group; ``shared`` has the runs that other groups have too."""
    def work(rows, shared):
        pages = [_words_of(lines, zones) for lines, zones in
                 zip(rows.column("lines").to_pylist(), rows.column("zones").to_pylist())]
        numbers: dict[str, int] = {}
        symbols, owner = [], []
        for i, ((words, _, _), stream) in enumerate(zip(pages, rows.column("stream").to_pylist())):
            symbols += [numbers.setdefault(w, len(numbers)) for w in words] + [-1 - i]
            owner.append(np.full(len(words) + 1, stream, np.int64))
        starts = repeated(np.array(symbols, np.int64), np.concatenate([*owner, np.zeros(0, np.int64)]), run)
        covered = cover(starts, len(symbols), run)
        known = shared.column("run").to_numpy().astype(np.uint64)
        texts, by_run, by_mark, at = [], [], [], 0
        for (words, sizes, zone), containers in zip(pages, rows.column("containers").to_pylist()):
            mine = covered[at:at + len(zone)]
            at += len(zone) + 1
            if len(known) and (zone == PLAIN).any():
                found = np.isin(window_hashes(_word_hashes(words), run), known)
                mine = mine | cover(np.flatnonzero(found), len(zone), run)
            container = np.repeat(np.array(containers, np.int64), sizes)
            gone, left = _went(zone, container, mine, share)
            keep = ~gone & ~(left if by_markup else left & mine)
            by_run.append(int(gone.sum()))
            by_mark.append(int((left & ~keep).sum()))
            lines, place = [], 0
            for size in sizes:
                line = " ".join(w for w, k in zip(words[place:place + size], keep[place:place + size]) if k)
                place += size
                if line:
                    lines.append(line)
            texts.append("\n".join(lines))
        return pa.table({"page_id": rows.column("page_id"), "url": rows.column("url"),
                         "text": pa.array(texts, pa.string()), "run_words": pa.array(by_run, pa.int64()),
                         "markup_words": pa.array(by_mark, pa.int64())})

    return work


def _shared_runs(source: DataFrame, run: int) -> DataFrame:
    """Per group of the hosts with several groups, its undecided runs that another group has as well."""
    runs = through(source.filter("part IS NOT NULL"), RUNS, _runs(run))
    # one aggregate serves both sides of the join, so the pages are parsed once for it
    by_group = runs.groupBy("host", "part", "run").agg(
        F.min("stream").alias("_low"), F.max("stream").alias("_high")
    )
    known = by_group.groupBy("host", "run").agg(
        F.min("_low").alias("_least"), F.max("_high").alias("_most"),
        F.min("part").alias("_first"), F.max("part").alias("_last"),
    ).filter("_least < _most AND _first < _last").select("host", "run")
    return by_group.join(known, ["host", "run"])


def extract(
    pages: DataFrame, run: int = RUN, pages_per_group: int = PAGES_PER_GROUP, share: float = SHARE,
    by_markup: bool = True,
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``run_words`` and ``markup_words`` of every row of ``pages`` (page_id, url, html).

    Blocks are joined by line feeds in page order, white space inside a block is one blank.
    A null or empty html has the empty text. A url without a host, or null, belongs to the host "".
    Pages with equal words count as one page when runs are counted, so copies of a page do not
    empty each other. Rows with null or repeated ids are handled one by one; an empty table gives
    an empty result.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")))
    counts = pages.select(host.alias("host"), F.octet_length("html").alias("_size")).groupBy("host").agg(
        F.count(F.lit(1)).alias("_pages"), F.sum("_size").alias("_bytes")
    )
    needed = F.greatest(F.ceil(F.col("_pages") / pages_per_group), F.ceil(F.col("_bytes") / GROUP_BYTES))
    large = counts.select("host", needed.alias("_groups")).filter("_groups > 1")
    # counted first: a join by shuffles would move every page once more
    small = large.count() <= BROADCAST_HOSTS
    source = pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), "html").join(
        F.broadcast(large) if small else large, "host", "left"
    ).select(
        "page_id", "url", "host", F.pmod(F.xxhash64("page_id", "url"), F.col("_groups")).alias("part"), "html"
    )
    rows = through(source, PARSED, _parse).withColumn("part", F.coalesce("part", F.lit(-1).cast("long")))
    shared = _shared_runs(source, run)
    return rows.groupBy("host", "part").cogroup(shared.groupBy("host", "part")).applyInArrow(
        _group(run, share, by_markup), TEXTS
    )
