"""Phrases whose words attract each other, by relational mining of occurrences (SETM).

The texts of a task become segments, one per language and ``SEGMENT_BYTES`` of text. A segment is a sorted
relation of occurrences: its pieces one after another, a border between them, so that places
p and p + 1 are neighbours in one piece. It is stored with the phrases that occur in it, by numbers of its own;
the larger a segment, the fewer phrases it shares with others.

Length by length:
* group-count: the counts of all segments are added up per phrase; those found often enough are
  stored and numbered;
* semi-join: each segment learns the numbers of its frequent phrases and drops all other
  occurrences;
* merge-join: occurrences of frequent phrases at neighbouring places of a piece make those that are one word longer.
  They are named by the phrases without their last and without their first word.

Phrases of two words and more are nearly as many as words, so a segment hands them on packed: dealt by a hash of
the phrase to parts of about ``PART_WORDS`` words of the corpus, in order, as columns of numbers. A part holds all
counts of its phrases; one that every segment has is one number per segment there. The packed relations are
shuffled once per length, single occurrences never. No table of phrases is broadcast or collected, for
they grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import through
from docketworks.operators.ranking import top_per_group
from docketworks.sources.scratch import Scratch

LONGEST = 3
LEAST = 10
#: A phrase goes if a longer one has at least this share of its occurrences.
COVERED_PERCENT = 50
REPORTED = 2000
MILLION = 1_000_000
#: Text of one segment, and text that a task holds for segments to come.
SEGMENT_BYTES, HELD_BYTES = 16_000_000, 48_000_000
#: Words of the corpus per part in which longer phrases are counted.
PART_WORDS = 3_000_000
UNKNOWN = "und"

# Fixed by the contract: what ends a piece, and what separates words
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
BORDER = PIECE_ENDS[:1]
_TABLE = bytes.maketrans(PIECE_ENDS + WORD_ENDS, BORDER * len(PIECE_ENDS) + b" " * len(WORD_ENDS))

WORDS = "segment long, lang string, places binary, codes binary, words array<string>, counts array<long>"
#: A row with the places of a segment (no part), and one per part with phrases of it.
LONGER = "segment long, part int, places binary, codes binary, own binary, lefts binary, rights binary, counts binary"
#: Per segment the numbers of frequent phrases, and (no segment) the frequent phrases of the part.
COUNTED = "segment long, own binary, given binary, lefts array<long>, rights array<long>, counts array<long>"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def occurrences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Places and numbers of all words, ascending by place, and the words by number.

    Letters A-Z are lower-cased. A border takes a place of its own, between pieces and texts.
    """
    numbers = _Numbers({BORDER: 0})
    tokens = BORDER.join(texts).lower().translate(_TABLE).replace(BORDER, b" " + BORDER + b" ").split()
    codes = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
    places = np.flatnonzero(codes).astype(np.int32)
    return places, codes[places] - 1, list(numbers)[1:]


def packed(numbers: np.ndarray, kind=np.int32) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype(kind).tobytes())


def unpacked(data: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed_steps(numbers: np.ndarray, kind=np.int32) -> bytes:
    """Ascending numbers as steps, which are small and much alike."""
    return packed(np.diff(numbers, prepend=numbers.dtype.type(0)), kind)


def unpacked_steps(data: bytes, kind=np.int32) -> np.ndarray:
    return np.cumsum(unpacked(data, kind), dtype=kind)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text as bytes) to segments, numbered within the task."""
    number = TaskContext.get().partitionId() << 32
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))
    names = [part.split()[0] for part in WORDS.split(", ")]
    texts: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def segment(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal number
        del sizes[lang]
        places, codes, words = occurrences(texts.pop(lang))
        if len(places):
            counts = np.bincount(codes, minlength=len(words))
            number += 1
            row = (number, lang, packed_steps(places), packed(codes), [w.decode() for w in words], counts)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] >= SEGMENT_BYTES:
                yield from segment(lang)
        while sum(sizes.values()) >= HELD_BYTES:
            yield from segment(max(sizes, key=sizes.get))
    for lang in sorted(texts):
        yield from segment(lang)


def joined(places: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a sorted relation with itself at the next place of the same piece.

    Gives the places, the left codes and the right codes of the pairs.
    """
    here = np.flatnonzero(np.diff(places) == 1)
    return places[here], codes[here], codes[here + 1]


def _part_of(lefts: np.ndarray, rights: np.ndarray, parts: int) -> np.ndarray:
    mixed = lefts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rights.astype(np.uint64)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[kind]) for values, kind in zip(zip(*rows), types)], names=list(names)
    )


def _lengthened(segment: int, places, codes, number, last: bool, parts: int) -> list[tuple]:
    """Rows of LONGER for one segment; ``number`` has the number of each of its phrases, or -1."""
    frequent = number[codes] >= 0
    places, left, right = joined(places[frequent], codes[frequent])
    if not len(places):
        return []
    pairs, codes, counts = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True, return_counts=True)
    rows = [] if last else [(segment, None, packed_steps(places), packed(codes), None, None, None, None)]
    lefts, rights = number[pairs >> 32], number[pairs & 0xFFFFFFFF]
    part = _part_of(lefts, rights, parts)
    order = np.lexsort((rights, lefts, part))
    chosen, begins = np.unique(part[order], return_index=True)
    for p, own in zip(chosen, np.split(order, begins[1:])):
        rows.append((segment, int(p), None, None, packed(own), packed_steps(lefts[own], np.int64),
                     packed(rights[own], np.int64), packed(counts[own])))
    return rows


def _lengthen(last: bool, parts: int):
    """Cogroup of a segment with the numbers of its frequent phrases, in one row or several."""
    def work(occurrences, known):
        rows = []
        if occurrences.num_rows and known.num_rows:
            places = unpacked_steps(occurrences.column("places")[0].as_py())
            codes = unpacked(occurrences.column("codes")[0].as_py())
            number = np.full(int(codes.max()) + 1, -1, np.int64)
            for own, given in zip(known.column("own").to_pylist(), known.column("given").to_pylist()):
                number[unpacked(own)] = unpacked(given, np.int64)
            rows = _lengthened(occurrences.column("segment")[0].as_py(), places, codes, number, last, parts)
        found = [_rows(LONGER, [row]) for row in rows] or [_rows(LONGER, [(0, *[None] * 7)]).slice(0, 0)]
        return pa.Table.from_batches(found)

    return work


def _count(least: int):
    """Group-count of one part over all segments; frequent phrases are numbered within it."""
    def work(key, rows):
        segments = rows.column("segment").to_pylist()
        lefts, rights, counts, owns = [], [], [], []
        for i in range(len(segments)):
            lefts.append(unpacked_steps(rows.column("lefts")[i].as_py(), np.int64))
            rights.append(unpacked(rows.column("rights")[i].as_py(), np.int64))
            counts.append(unpacked(rows.column("counts")[i].as_py()).astype(np.int64))
            owns.append(unpacked(rows.column("own")[i].as_py()))
        sizes = [len(x) for x in owns]
        lefts, rights, counts = (np.concatenate(x) for x in (lefts, rights, counts))
        order = np.lexsort((rights, lefts))
        lefts, rights = lefts[order], rights[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(lefts) != 0) | (np.diff(rights) != 0)]))
        totals = np.add.reduceat(counts[order], first)
        chosen = totals >= least
        given = np.where(chosen, (key[0].as_py() << 40) + np.cumsum(chosen), -1)
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(given, np.diff(np.append(first, len(order))))
        out = [_rows(COUNTED, [(None, None, packed(given[chosen], np.int64), lefts[first][chosen],
                                rights[first][chosen], totals[chosen])])]
        for segment, own, mine in zip(segments, owns, np.split(number, np.cumsum(sizes)[:-1])):
            if (mine >= 0).any():
                out.append(_rows(COUNTED, [
                    (segment, packed(own[mine >= 0]), packed(mine[mine >= 0], np.int64), None, None, None)]))
        return pa.Table.from_batches(out)

    return work


def _frequent_words(entries: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    counted = entries.groupBy("lang", "word").agg(F.sum("count").alias("a"))
    none = F.array().cast("array<long>")
    frequent = counted.filter(F.col("a") >= least).select(
        F.monotonically_increasing_id().alias("phrase_id"), "lang", F.array("word").alias("words"), "a",
        none.alias("heads"), none.alias("tails"),
        F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"),
    )
    return scratch.stage(frequent, "frequent-1")  # written once, so that the numbers stay


def _numbers_of_words(entries: DataFrame, frequent: DataFrame) -> DataFrame:
    """Semi-join of the words of segments with the frequent ones: a row per segment, packed."""
    known = frequent.select("lang", F.col("words")[0].alias("word"), "phrase_id")
    found = entries.join(known, ["lang", "word"]).select("segment", "own", "phrase_id")

    def pack(rows):
        own, given = rows.column("own").to_numpy(), rows.column("phrase_id").to_numpy()
        return pa.table({"segment": rows.column("segment").slice(0, 1), "own": [packed(own)],
                         "given": [packed(given, np.int64)]},
                        schema=pa.schema([("segment", pa.int64()), ("own", pa.binary()), ("given", pa.binary())]))

    return found.groupBy("segment").applyInArrow(pack, "segment long, own binary, given binary")


def _frequent_longer(counted: DataFrame, shorter: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    """Frequent phrases of ``length`` words with the counts of what stands before and behind each cut.

    ``heads`` and ``tails`` hold the counts of the first and last 1, 2, ... words.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, given in enumerate(batch.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unpacked(given, np.int64)), *(batch.column(c)[i].values for c in (1, 2, 3))],
                    names=["phrase_id", "left", "right", "a"])

    frequent = through(
        counted.filter("segment IS NULL").select("given", "lefts", "rights", "counts"),
        "phrase_id long, left long, right long, a long", listed,
    )
    left = shorter.select(F.col("phrase_id").alias("left"), "lang", F.col("words").alias("_first"),
                          F.concat("heads", F.array("a")).alias("heads"))
    right = shorter.select(F.col("phrase_id").alias("right"), F.element_at("words", -1).alias("_last"),
                           F.concat("tails", F.array("a")).alias("tails"))
    return scratch.stage(frequent.join(left, "left").join(right, "right").select(
        "phrase_id", "lang", F.concat("_first", F.array("_last")).alias("words"), "a", "heads", "tails", "left", "right",
    ), f"frequent-{length}")


def candidates(
    docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``longest`` words found ``least`` times, and the word counts ``n`` per ``lang``."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    segments = scratch.stage(through(source, WORDS, _segments), "occurrences-1")
    totals = segments.groupBy("lang").agg(F.sum(F.aggregate(
        "counts", F.lit(0).cast("long"), lambda total, x: total + x)).alias("n"))
    words = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-words // PART_WORDS))
    each = F.posexplode(F.arrays_zip("words", "counts")).alias("own", "_one")
    entries = segments.select("segment", "lang", each).select(
        "segment", "lang", "own", F.col("_one.words").alias("word"), F.col("_one.counts").alias("count"))
    shorter = _frequent_words(entries, least, scratch)
    known = _numbers_of_words(entries, shorter)
    found = None
    for length in range(2, longest + 1):
        last = length == longest
        places = segments.select("segment", "places", "codes").filter("places IS NOT NULL")
        segments = scratch.stage(
            places.groupBy("segment").cogroup(known.groupBy("segment")).applyInArrow(_lengthen(last, parts), LONGER),
            f"occurrences-{length}",
        )
        # as many parts as the words of the corpus ask for, each a bounded group
        dealt = segments.filter("part IS NOT NULL").select("segment", "part", "own", "lefts", "rights", "counts")
        counted = scratch.stage(
            dealt.groupBy("part").applyInArrow(_count(least), COUNTED), f"counted-{length}"
        )
        shorter = _frequent_longer(counted, shorter, scratch, length)
        known = counted.filter("segment IS NOT NULL").select("segment", "own", "given")
        found = shorter if found is None else found.unionByName(shorter)
    return found, totals


def _cuts() -> Column:
    """Every cut with its score, as (score, words before it, l, r). The products are decimals of 38 digits."""
    def wide(value: Column) -> Column:
        return value.cast("decimal(19,0)")

    def cut(l: Column, i: Column) -> Column:
        r = F.element_at("tails", -(i + 1))
        both = (wide(F.col("a")) * wide(F.col("a"))).cast("decimal(31,0)") * F.lit(MILLION).cast("decimal(7,0)")
        score = F.call_function("div", both, wide(l) * wide(r))
        return F.struct(score.cast("long").alias("score"), i.alias("k"), l.alias("l"), r.alias("r"))

    return F.transform("heads", cut)


def collocations(
    docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST,
    covered_percent: int = COVERED_PERCENT, reported: int = REPORTED,
) -> DataFrame:
    """The phrases with the highest scores of every language of ``docs`` (lang, text).

    Columns: ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences, overlaps included), ``l`` and ``r``
    (those of the parts before and behind its weakest cut), ``n`` (words of the language) and ``score``
    = floor(1,000,000 a a / (l r)). Phrases are contiguous words of a piece. One that a longer candidate
    covers to ``covered_percent`` or more is dropped. A null language is ``und``, a null text empty; equal rows
    count each; other columns are not looked at; an empty table gives an empty result.
    """
    found, totals = candidates(docs, scratch, least, longest)
    found = found.withColumn("_size", F.size("words"))
    # a phrase inside one two words longer lies inside one a word longer, found at least as often
    longer = found.select((F.col("_size") - 1).alias("_size"), "a", F.explode(F.array("left", "right")).alias("phrase_id"))
    most = longer.groupBy("_size", "phrase_id").agg(F.max("a").alias("_longer"))  # numbers are those of a length
    judged = found.join(most, ["_size", "phrase_id"], "left").filter(
        F.coalesce(100 * F.col("_longer") < covered_percent * F.col("a"), F.lit(True))
    )
    weakest = F.array_min(_cuts())
    scored = judged.select("lang", F.array_join("words", " ").alias("phrase"), "a", weakest.alias("_cut"))
    scored = scored.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    best = top_per_group(scored, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], reported, "rank")
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
