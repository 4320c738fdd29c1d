"""A factorisation machine that scores the quality of texts.

Inputs of a score: hashed words (their share of the text), statistics of its structure, and the
recorded length. Every input has a weight and ``RANK`` factors; each pair of inputs counts with
the product of their factors. The sum over all pairs is half of the squared sum minus the sum
of squares, so a score takes time linear in the inputs that are not zero.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of their ids; it has a
fixed size whatever the corpus. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import ddl, through

WORD_BUCKETS = 1 << 14
RANK = 8
#: Bound of the labelled sample.
TRAIN_ROWS = 2000
STEPS = 40
RATE = 0.1
#: Scores from here on count as good.
GOOD = 0.5
SHRINK = 1e-4
KEPT_WORDS = 500_000
SYMBOLS = re.compile(r"[#*$%&|<>]")

STRUCTURE = ("one", "length", "recorded_length", "word_length", "distinct_words", "repeated_pairs",
             "upper", "digits", "symbols", "punctuation", "marks", "long_words", "dup_lines",
             "line_length", "capital_words")
INPUTS = WORD_BUCKETS + len(STRUCTURE)


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        value = self[word] = xxhash.xxh32_intdigest(word) % WORD_BUCKETS
        return value


_BUCKETS = _Buckets()


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def structure(text: str, words: list[str], recorded: int | None) -> list[float]:
    """Values of STRUCTURE, each between 0 and about 1."""
    chars, count = len(text), len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:])))
    upper = sum(map(str.isupper, words))
    return [
        1.0,
        math.log1p(chars) / 12,
        math.log1p(max(recorded if recorded is not None else chars, 0)) / 12,
        min(_share(sum(map(len, words)), count) / 20, 2.0),
        _share(len(set(words)), count),
        1 - _share(pairs, count - 1) if count > 1 else 0.0,
        _share(upper, count),
        _share(len(re.findall(r"[0-9]", text)), chars) * 4,
        _share(len(SYMBOLS.findall(text)), chars) * 10,
        _share(text.count(".") + text.count(","), chars) * 10,
        _share(text.count("!") + text.count("?"), chars) * 10,
        _share(sum(len(w) > 20 for w in words), count) * 4,
        1 - _share(len(set(lines)), len(lines)) if lines else 0.0,
        min(_share(chars, len(lines)) / 1000, 2.0),
        _share(sum(w[:1].isupper() for w in words), count),
    ]


def inputs(text: str | None, recorded: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the inputs that are not zero. The words have length 1 together."""
    text = text or ""
    words = text.split()
    if len(_BUCKETS) > KEPT_WORDS:
        _BUCKETS.clear()
    which = np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words))
    counts = np.bincount(which, minlength=1)
    used = np.flatnonzero(counts)
    values = counts[used] / (math.sqrt(float((counts[used] ** 2).sum())) or 1.0)
    extra = np.array(structure(text, words, recorded))
    return (np.concatenate([used, WORD_BUCKETS + np.arange(len(extra))]).astype(np.int32),
            np.concatenate([values, extra]).astype(np.float32))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one per input
    factors: np.ndarray  # inputs x RANK

    def margins(self, which: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds of rows given one after another; ``starts`` are their first places."""
        linear = np.add.reduceat(self.weights[which] * values, starts)
        scaled = self.factors[which] * values[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled * scaled, starts)
        return linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def scores(self, texts: list[str | None], recorded: list[int | None]) -> np.ndarray:
        rows = [inputs(t, n) for t, n in zip(texts, recorded)]
        sizes = np.array([len(w) for w, _ in rows])
        margins = self.margins(
            np.concatenate([w for w, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.float64),
            np.cumsum(sizes) - sizes,
        )
        return 1 / (1 + np.exp(-np.clip(margins, -500, 500)))


EMPTY = Model(np.zeros(INPUTS), np.zeros((INPUTS, RANK)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> Model:
    """Logistic loss by Adam over all rows at once. Without rows every score is one half."""
    if not rows:
        return EMPTY
    sizes = np.array([len(w) for w, _ in rows])
    which = np.concatenate([w for w, _ in rows]).astype(np.int64)
    values = np.concatenate([v for _, v in rows]).astype(np.float64)
    starts, row_of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(which, kind="stable")  # entries by input, for the gradients
    used, first = np.unique(which[order], return_index=True)
    table = np.zeros((INPUTS, 1 + RANK))
    table[used, 1:] = np.random.default_rng(seed).normal(0, 0.05, (len(used), RANK))
    mean, spread = np.zeros((len(used), 1 + RANK)), np.zeros((len(used), 1 + RANK))
    by_input, ordered = row_of[order], values[order]
    for step in range(1, STEPS + 1):
        model = Model(table[:, 0], table[:, 1:])
        error = 1 / (1 + np.exp(-np.clip(model.margins(which, values, starts), -500, 500))) - labels
        sums = np.add.reduceat(table[which, 1:] * values[:, None], starts)
        pull = (error[by_input] * ordered)[:, None]
        own = table[which[order], 1:] * ordered[:, None]
        slope = np.add.reduceat(np.hstack([pull, pull * (sums[by_input] - own)]), first) / len(rows)
        slope += SHRINK * table[used]
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope * slope
        table[used] -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
    return Model(table[:, 0].copy(), table[:, 1:].copy())


def held_out() -> Column:
    """Rows whose labels are never learnt from; false without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Fit on the ``most`` labelled documents whose ids have the smallest hashes.

    A document labelled in several ways counts with its lowest quality. Nulls are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg((F.min("quality") >= 1).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    recorded = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), "text", recorded.alias("_recorded")).join(
        F.broadcast(chosen), "doc_id"  # at most ``most`` rows
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [inputs(t, n) for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array([w.tobytes() for w, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())],
                names=["doc_id", "label", "which", "vals"],
            )

    sample = through(rows, "doc_id long, label int, which binary, vals binary", work).toArrow()
    sample = sorted(sample.to_pylist(), key=lambda r: (r["doc_id"], r["which"], r["vals"]))
    return fit(
        [(np.frombuffer(r["which"], np.int32), np.frombuffer(r["vals"], np.float32)) for r in sample],
        np.array([r["label"] for r in sample], np.float64),
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) in front; its columns must not be called so.

    Every row is scored by its whole text and ``n_chars``; a null or empty text has the
    score of its structure alone. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    at = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            recorded = [None] * len(texts) if length is None else batch.column(length).to_pylist()
            found = shared.value.scores(texts, recorded)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), *batch.columns], names=["score", *batch.schema.names]
            )

    return through(docs, f"score double, {ddl(docs)}", work)
