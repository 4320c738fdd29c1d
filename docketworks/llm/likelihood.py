"""Quality rules: counts of a text, and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets
are counted, one over trusted documents and one over the whole corpus; a document's score is the
mean log ratio of its n-grams. The threshold is the score that all but a stated share of the
trusted documents reach, found from a histogram, so every document gets the same fixed
verdict whatever the partitioning: log ratios are rounded to integers and sums are exact.

Columns and SQL functions only. What is collected has a fixed size: a weight per bucket and
a count per score step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.sources.scratch import Scratch

# Fixed values of the rules
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BUCKETS = 1 << 14
#: Log ratios are multiples of 1 / SCALE; scores are multiples of 1 / STEPS.
SCALE = 1000
STEPS = 1000
#: Share of the trusted documents that may fall below the threshold.
LOST_SHARE = 0.002


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` and ``_text`` (never null) and ``_words``."""
    return docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn(
        "_words", _words(F.col("_text"))
    )


def with_counts(docs: DataFrame, place_bits: int = 0) -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Windows of three words are compared by 64-bit hashes, in a text of any length. In a first sort, of plain
    numbers, the hash shares its 64 bits with the place of the window (``place_bits`` at least); what
    agrees there is a candidate. If candidates differ in their full hashes, they are sorted by these.
    """
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD_CHARACTER))
    frame = with_words(docs).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long"),
        "_lines": lines,
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    frame = frame.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_bits": F.greatest(F.length(F.bin("n_words")), F.lit(place_bits)),
        "_windows": F.expr(
            "transform(slice(_hashes, 3, greatest(size(_hashes) - 2, 0)),"
            " (h, i) -> xxhash64(h, get(_hashes, i), get(_hashes, i + 1)))"
        ),
    })
    frame = frame.withColumn("_sorted", F.expr(
        "sort_array(transform(_windows, (h, i) -> shiftleft(h, _bits) | i))"
    ))
    frame = frame.withColumn("_repeated", F.expr(
        "filter(_sorted, (v, i) -> shiftright(v, _bits) = shiftright(get(_sorted, i - 1), _bits)"
        " OR shiftright(v, _bits) = shiftright(get(_sorted, i + 1), _bits))"
    ))
    frame = frame.withColumn("_places", F.expr(
        "transform(_repeated, v -> int(v & (shiftleft(1L, _bits) - 1)))"
    ))
    # neighbours that agree in the short hash only; without any, equal short hashes are equal hashes
    frame = frame.withColumn("_false", F.expr(
        "exists(transform(_places, (p, i) -> i > 0"
        " AND shiftright(get(_repeated, i), _bits) = shiftright(get(_repeated, i - 1), _bits)"
        " AND get(_windows, p) <> get(_windows, get(_places, i - 1))), x -> x)"
    ))
    frame = frame.withColumn("_full", F.expr(
        "CASE WHEN _false THEN sort_array(transform(_places, p -> struct(get(_windows, p) AS h, p AS p))) END"
    ))
    frame = frame.withColumn("_at", F.expr(
        "sort_array(CASE WHEN _false THEN transform(filter(_full, (v, i) -> v.h = get(_full, i - 1).h"
        " OR v.h = get(_full, i + 1).h), v -> v.p) ELSE _places END)"
    ))
    # a window adds its three words but for those that the window before it has; least() skips null
    frame = frame.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(_at, (v, i) -> least(3L, cast(v - get(_at, i - 1) AS bigint))), 0L, (a, x) -> a + x)"
    ))
    return frame.drop("_lines", "_hashes", "_bits", "_windows", "_sorted", "_repeated",
                      "_places", "_false", "_full", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )


def buckets(words: str, size: int) -> Column:
    """The bucket of every word and of every pair of neighbouring words."""
    return F.expr(
        f"concat(transform({words}, w -> cast(pmod(xxhash64(w), {size}) AS int)),"
        f" transform(slice({words}, 2, greatest(size({words}) - 1, 0)),"
        f" (w, i) -> cast(pmod(xxhash64(w, get({words}, i)), {size}) AS int)))"
    )


def log_ratios(docs: DataFrame, size: int = BUCKETS) -> list[int]:
    """Per bucket, log(trusted share / corpus share) times SCALE, with one added to every count.

    ``docs`` has the column ``_trusted`` beside the text. One row per bucket and task is shuffled.
    """
    # an outer explode: for a plain one Spark would infer a filter on its input and push the
    # n-grams below the projection of the words, which then are split once per n-gram
    grams = with_words(docs).select(
        "_trusted", F.explode_outer(buckets("_words", size)).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(
        F.count("bucket").alias("all"), F.count_if("_trusted").alias("good")
    ).collect()  # at most one row per bucket
    counts = [r for r in counts if r["bucket"] is not None]
    good = {r["bucket"]: r["good"] for r in counts}
    raw = {r["bucket"]: r["all"] for r in counts}
    all_good, all_raw = sum(good.values()) + size, sum(raw.values()) + size
    return [
        round(SCALE * (math.log((good.get(b, 0) + 1) / all_good) - math.log((raw.get(b, 0) + 1) / all_raw)))
        for b in range(size)
    ]


def with_score(frame: DataFrame, weights: list[int], name: str = "score_steps") -> DataFrame:
    """Add the mean log ratio of the n-grams of ``_words``, in steps; null without words."""
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    frame = frame.withColumn("_buckets", buckets("_words", len(weights)))
    frame = frame.withColumns({
        "_sum": F.aggregate("_buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(table, b)),
        "_grams": F.size("_buckets"),
    })
    steps = F.floor(F.col("_sum") * (STEPS // SCALE) / F.nullif(F.col("_grams"), F.lit(0)))
    return frame.withColumn(name, steps.cast("long")).drop("_buckets", "_sum", "_grams")


def threshold(scored: DataFrame, lost_share: float = LOST_SHARE) -> int | None:
    """The largest step that all but ``lost_share`` of the (trusted) documents reach."""
    rows = scored.groupBy("score_steps").count().collect()  # their range is that of the weights
    steps = sorted((r["score_steps"], r["count"]) for r in rows if r["score_steps"] is not None)
    allowed, below = math.floor(lost_share * sum(n for _, n in steps)), 0
    for step, count in steps:
        if below + count > allowed:
            return step
        below += count
    return None


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents that are labelled, and never with a quality other than 1."""
    return labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("_low"), F.max("quality").alias("_high")
    ).filter("_low = 1 AND _high = 1").select("doc_id")


def judge(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, keep: Sequence[str] = ("doc_id",),
    size: int = BUCKETS, lost_share: float = LOST_SHARE,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, the counts of ``with_counts``, ``score_steps``, ``base_failed``, ``kept``.

    A document is kept if it passes the base rules and its score reaches the threshold. A null
    or empty text has no words and fails. Without any trusted document there is no
    threshold and the base rules decide alone. Rows with null or repeated ids are judged one by
    one by their texts. Names beginning with an underscore and the added names are taken by this operator,
    but for ``_rest``.

    Scores are stored once. The texts meet the labels in one shuffle, for the counts of the trusted
    documents; the threshold needs ids and scores only. The stored table also keeps Spark from pushing a
    filter on ``kept`` below the projections, where it would split the words anew for every n-gram.
    """
    known = trusted_ids(labels)
    # one plan at every size: labels of a large corpus never fit a broadcast
    pair = docs.select("doc_id", "text").join(
        known.withColumn("_trusted", F.lit(True)).hint("merge"), "doc_id", "left"
    ).withColumn("_trusted", F.coalesce("_trusted", F.lit(False)))
    weights = log_ratios(pair, size)
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score_steps")
    scored = with_score(with_counts(docs), weights)
    chosen = scored.select("doc_id", *[c for c in keep if c != "doc_id"], *added)
    stored = scratch.stage(chosen, "scored")
    least = threshold(stored.select("doc_id", "score_steps").join(known, "doc_id", "left_semi"), lost_share)
    reached = F.lit(True) if least is None else F.coalesce(F.col("score_steps") >= least, F.lit(False))
    return stored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & reached
    )
