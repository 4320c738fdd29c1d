"""Overlap join: spans of one table meet all spans of another of the same key that they overlap.

Time is cut into buckets and every span is listed under those that it touches, so spans meet by
key and bucket. A pair that shares several buckets is taken in the first of them only. Buckets have levels, each
``most_buckets`` times as wide as the one before, and a span is listed on the level where it touches
few of them. Spans of two levels meet in the buckets of the wider one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.sources.scratch import Scratch

#: Microseconds beyond any time that Spark holds; an open span lasts so long.
FOREVER = 400_000_000_000_000_000


def level_widths(bucket_seconds: int, most_buckets: int) -> list[int]:
    """Microseconds of a bucket on every level; one of the last level holds all of time."""
    widths = [bucket_seconds * 1_000_000]
    while widths[-1] < 2 * FOREVER:
        widths.append(min(widths[-1] * most_buckets, 4 * FOREVER))
    return widths


def _bucket(at: Column, width: int) -> Column:
    """Number of the bucket that holds ``at``, also before 1970."""
    wide = F.lit(width).cast("long")
    return F.call_function("div", at - F.pmod(at, wide), wide)


def _spans(frame: DataFrame, keys: Sequence[str], span: tuple[str, str], side: str) -> DataFrame:
    """The row as one column, its keys, and its span in microseconds; empty spans are left out."""
    begin, end = (F.unix_micros(F.col(c).cast("timestamp")) for c in span)
    named = frame.select(
        *[F.col(k).alias(f"_{side}_key_{i}") for i, k in enumerate(keys)],
        F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias(f"_{side}"),
        F.coalesce(begin, F.lit(-FOREVER)).alias(f"_{side}_low"),
        F.coalesce(end, F.lit(FOREVER)).alias(f"_{side}_high"),
    )
    known = reduce(lambda a, b: a & b, [F.col(f"_{side}_key_{i}").isNotNull() for i in range(len(keys))])
    return named.filter(known & (F.col(f"_{side}_low") < F.col(f"_{side}_high")))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    scratch: Scratch,
    bucket_seconds: int = 7 * 86_400,
    most_buckets: int = 16,
) -> DataFrame:
    """``left`` and ``right`` (two structs) of every pair with equal ``keys`` and overlapping spans.

    A span holds its begin and not its end; a null end is open, a null begin lies before everything. Equal
    rows pair each; a null key meets nothing. Spans are first clipped to the time that both tables
    cover, so an open one is listed no more often than the data need. No span is listed more than
    ``most_buckets`` + 1 times per level of the other table, and the rows of a busy key lie in different buckets;
    a bucket that still is hot is split by adaptive execution.
    """
    widths = level_widths(bucket_seconds, most_buckets)
    spans = {"l": _spans(left, keys, left_span, "l"), "r": _spans(right, keys, right_span, "r")}
    spans = {side: scratch.stage(frame, f"spans-{side}") for side, frame in spans.items()}
    range_of = {side: frame.agg(F.min(f"_{side}_low"), F.max(f"_{side}_high")).first() for side, frame in spans.items()}
    if any(found[0] is None for found in range_of.values()):
        return _nothing(left, right, spans["l"])
    low, high = max(r[0] for r in range_of.values()), min(r[1] for r in range_of.values())
    clipped, levels = {}, {}
    for side, frame in spans.items():
        begin, end = F.greatest(F.col(f"_{side}_low"), F.lit(low)), F.least(F.col(f"_{side}_high"), F.lit(high))
        frame = frame.withColumns({f"_{side}_low": begin, f"_{side}_high": end}).filter(
            F.col(f"_{side}_low") < F.col(f"_{side}_high")
        )
        length, level = F.col(f"_{side}_high") - F.col(f"_{side}_low"), F.lit(len(widths) - 1)
        for i in range(len(widths) - 2, -1, -1):
            level = F.when(length <= F.lit(widths[i + 1]), F.lit(i)).otherwise(level)
        clipped[side] = frame.withColumn(f"_{side}_level", level)
        levels[side] = sorted(r[0] for r in clipped[side].select(f"_{side}_level").distinct().collect())  # a few

    def listed(side: str, level: int, width: int) -> DataFrame:
        first, last = _bucket(F.col(f"_{side}_low"), width), _bucket(F.col(f"_{side}_high") - 1, width)
        chosen = clipped[side].filter(F.col(f"_{side}_level") == level).drop(f"_{side}_level")
        return chosen.withColumn(f"_{side}_bucket", F.explode(F.sequence(first, last)))

    parts = []
    for one in levels["l"]:
        for other in levels["r"]:
            width = widths[max(one, other)]
            a, b = listed("l", one, width), listed("r", other, width)
            match = reduce(lambda x, y: x & y, [
                *[a[f"_l_key_{i}"] == b[f"_r_key_{i}"] for i in range(len(keys))],
                a["_l_bucket"] == b["_r_bucket"],
                a["_l_low"] < b["_r_high"], b["_r_low"] < a["_l_high"],
                a["_l_bucket"] == _bucket(F.greatest(a["_l_low"], b["_r_low"]), width),
            ])
            parts.append(a.join(b, match).select(F.col("_l").alias("left"), F.col("_r").alias("right")))
    return reduce(DataFrame.unionByName, parts) if parts else _nothing(left, right, spans["l"])


def _nothing(left: DataFrame, right: DataFrame, spans: DataFrame) -> DataFrame:
    return spans.limit(0).select(F.col("_l").alias("left"), F.lit(None).cast(right.schema).alias("right"))
