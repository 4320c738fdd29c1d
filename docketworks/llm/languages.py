"""Language of texts by multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; every stretch of characters that are neither letters nor marks becomes one
blank. Its n-grams of ``ORDERS`` characters are hashed into ``BUCKETS`` buckets. Training counts buckets
per language over all training texts: a task adds up its own, Spark adds up the tasks.

The logarithms of the bucket probabilities are stored as integers, so the sum over a text is exact
and the same however texts are batched. The matrix (buckets x languages) is broadcast, for at most
``LANGUAGES`` languages at a time; with more, texts pass once per so many languages and carry along
the best so far. Texts are scored in batches: rows of the matrix are gathered for all their
n-grams and summed between the borders of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import through
from docketworks.sources.scratch import Scratch

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
#: Languages whose matrix is held and broadcast at once: 64 x 65,536 numbers of 4 bytes are 16 MB.
LANGUAGES = 64
#: N-grams that are gathered at once.
GATHERED = 1 << 18
SMOOTHING = 0.5
#: Units of a logarithm.
UNIT = 1 << 20
UNKNOWN = "und"
#: Row of the counts that holds the number of texts.
TEXTS = -1

SEPARATOR, MARK, LETTER = 0, 1, 2
COUNTS = "lang string, bucket int, found long"
SCORED = "doc_id long, text string, lang_pred string, best long, mass double"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """SEPARATOR, MARK or LETTER for every code point."""
    import unicodedata

    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        kinds[code] = LETTER if first == "L" else MARK if first == "M" else SEPARATOR
    return kinds


def characters(text: str | None) -> np.ndarray:
    """Code points of the text in lower case, blanks for what stands between words and at both ends.

    Empty if no letter is in it.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[codes]
    if not (kinds == LETTER).any():
        return np.zeros(0, np.uint32)
    blank = kinds == SEPARATOR
    padded = np.concatenate([[32], np.where(blank, 32, codes), [32]]).astype(np.uint32)
    between = np.concatenate([[True], blank, [True]])
    return padded[~between | np.concatenate([[True], ~between[:-1]])]


def buckets(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, ``GATHERED`` at a time at most."""
    for order in ORDERS:
        step = GATHERED
        for at in range(0, len(codes) - order + 1, step):
            count = min(step, len(codes) - order + 1 - at)
            mixed = np.full(count, order, np.uint64)
            for i in range(order):
                mixed = (mixed ^ codes[at + i:at + i + count].astype(np.uint64)) * FACTOR
                mixed ^= mixed >> np.uint64(29)
            yield (mixed * FACTOR >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, text), the texts of a task added up; many languages are handed on in between."""
    held: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(used) + 1), pa.string()),
                pa.array(np.append(used, TEXTS).astype(np.int32)),
                pa.array(np.append(counts[used], texts[lang])),
            ], names=["lang", "bucket", "found"])
        held.clear()
        texts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = characters(text)
            if not len(codes):
                continue
            if lang not in held:
                if len(held) >= LANGUAGES:
                    yield from out()
                held[lang], texts[lang] = np.zeros(BUCKETS, np.int64), 0
            texts[lang] += 1
            for some in buckets(codes):
                np.add.at(held[lang], some, 1)
    yield from out()


def held_out() -> Column:
    """Rows that are never learnt from; false without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``lang``, ``bucket`` and ``found`` over every text with a language that is not held out.

    The number of texts of a language stands under the bucket ``TEXTS``. Rows without an id, text,
    language or letter teach nothing.
    """
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out())
    counts = through(known.select("lang", "text"), COUNTS, _count)
    return scratch.stage(counts.groupBy("lang", "bucket").agg(F.sum("found").alias("found")), "counts")


def matrix(counts: DataFrame, names: list[str], texts: int) -> np.ndarray:
    """Logarithms in ``UNIT``: a column per language; the last row has the logarithms of its share of texts."""
    found = counts.filter(F.col("lang").isin(names)).toArrow()  # bounded by LANGUAGES x (BUCKETS + 1)
    place = {name: i for i, name in enumerate(names)}
    table = np.zeros((BUCKETS + 1, len(names)))
    column = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    table[found.column("bucket").to_numpy(), column] = found.column("found").to_numpy()
    grams = table[:BUCKETS].sum(axis=0)
    table[:BUCKETS] = np.log((table[:BUCKETS] + SMOOTHING) / (grams + SMOOTHING * BUCKETS))
    table[TEXTS] = np.log(table[TEXTS] / texts) * len(ORDERS)  # every character counts once per order
    return np.rint(table * UNIT).astype(np.int32)


def evidence(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed logarithms (texts x languages) and whether a text has a letter."""
    sums = np.tile(table[TEXTS].astype(np.int64), (len(texts), 1))
    lettered = np.zeros(len(texts), bool)
    waiting: list[np.ndarray] = []
    owners: list[int] = []

    def gather() -> None:
        if waiting:
            sizes = np.array([len(w) for w in waiting])
            found = np.add.reduceat(table[np.concatenate(waiting)], np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
            np.add.at(sums, owners, found)
        waiting.clear()
        owners.clear()

    held = 0
    for i, text in enumerate(texts):
        codes = characters(text)
        lettered[i] = len(codes) > 0
        for some in buckets(codes):
            waiting.append(some)
            owners.append(i)
            held += len(some)
            if held >= GATHERED:
                gather()
                held = 0
    gather()
    return sums, lettered


def _score(shared, names: list[str]):
    """The best of these languages and those before; ``mass`` is the sum of odds against the best."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = UNIT * len(ORDERS)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sums, lettered = evidence(texts, shared.value)
            which = sums.argmax(axis=1)
            best = sums[np.arange(len(texts)), which]
            mass = np.exp((sums - best[:, None]) / scale).sum(axis=1)
            rows = []
            for i, (lang, before, held) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("lang_pred", "best", "mass")))
            ):
                mine = (names[which[i]], int(best[i]), float(mass[i])) if lettered[i] else (None, None, None)
                if lang is not None and lettered[i]:
                    gap = np.exp(-abs(mine[1] - before) / scale)
                    # languages come in ascending order, so the earlier one wins a tie
                    mine = ((lang, before, held + mine[2] * gap) if before >= mine[1]
                            else (mine[0], mine[1], mine[2] + held * gap))
                rows.append(mine)
            langs, bests, masses = zip(*rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text"), pa.array(langs, pa.string()),
                pa.array(bests, pa.int64()), pa.array(masses, pa.float64()),
            ], names=["doc_id", "text", "lang_pred", "best", "mass"])

    return work


def identify(docs: DataFrame, counts: DataFrame, scratch: Scratch, at_once: int = LANGUAGES) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs`` (doc_id, text).

    ``score`` is the probability of the predicted language under the model. A null text, one
    without a letter, and any text if nothing was learnt, is ``und`` with score 0. Ties go to the language that sorts
    first. Whole texts of any length are read in stretches of bounded size; rows with a null or repeated
    id are handled like others, other columns are not looked at, an empty table gives none.
    """
    spark = docs.sparkSession
    totals = counts.filter(F.col("bucket") == TEXTS).agg(F.sum("found"), F.count(F.lit(1))).first()
    texts, languages = totals[0] or 0, totals[1]
    nothing = F.lit(None)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", nothing.cast("string").alias("lang_pred"),
        nothing.cast("long").alias("best"), nothing.cast("double").alias("mass"),
    )
    after = None
    for done in range(0, languages, at_once):
        named = counts.filter(F.col("bucket") == TEXTS)
        if after is not None:
            named = named.filter(F.col("lang") > after)
        names = [r["lang"] for r in named.select("lang").orderBy("lang").limit(at_once).collect()]
        after = names[-1]
        shared = spark.sparkContext.broadcast(matrix(counts, names, texts))
        rows = through(rows, SCORED, _score(shared, names))
        if done + at_once < languages:
            rows = scratch.stage(rows, "scored")
            shared.unpersist()
    return rows.select(
        "doc_id", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(1 / F.col("mass"), F.lit(0.0)).alias("score"),
    )
