"""The overlap join against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from docketworks.operators.overlap import level_widths, overlap_join

START = datetime(2024, 1, 1)
SPAN = "id int, key string, begins timestamp, ends timestamp, left string"


def spans(seed: int, count: int):
    """Short and very long spans, open ends, empty spans, copies, null keys and a busy key."""
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        begin = None if draw.random() < 0.05 else START + timedelta(hours=draw.randrange(-2000, 2000))
        length = draw.choice([0, 1, 5, 24, 24 * 40, 24 * 4000, -3])
        end = None if draw.random() < 0.1 else (begin or START) + timedelta(hours=length)
        rows.append((i, draw.choice(["a", "a", "a", "b", "c", None]), begin, end, "x"))
    return rows + rows[:5]


def plain(left, right):
    low, high = datetime.min, datetime.max
    found = []
    for a in left:
        for b in right:
            if a[1] is None or a[1] != b[1]:
                continue
            (s, e), (t, f) = ((r[2] or low, r[3] or high) for r in (a, b))
            if s < e and t < f and s < f and t < e:
                found.append((a[0], b[0]))
    return sorted(found)


def joined(spark, scratch, left, right, **settings):
    one, other = (spark.createDataFrame(rows, SPAN).repartition(3) for rows in (left, right))
    found = overlap_join(one, other, ["key"], ("begins", "ends"), ("begins", "ends"), scratch, **settings)
    return sorted((r[0], r[1]) for r in found.select("left.id", "right.id").collect())


@pytest.mark.parametrize("seed,settings", [(1, {}), (2, {"bucket_seconds": 3600, "most_buckets": 2})])
def test_all_overlaps_once(spark, scratch, seed, settings):
    left, right = spans(seed, 60), spans(seed + 10, 50)
    assert joined(spark, scratch, left, right, **settings) == plain(left, right)


def test_tables_without_overlap(spark, scratch):
    early = [(1, "a", START, START + timedelta(hours=1), "")]
    late = [(2, "a", START + timedelta(hours=1), None, "")]
    assert joined(spark, scratch, early, late) == []  # an end is not part of a span
    assert joined(spark, scratch, early, []) == joined(spark, scratch, [], late) == joined(spark, scratch, [], []) == []


def test_a_span_is_listed_few_times():
    widths = level_widths(3600, 4)
    assert widths == sorted(widths) and widths[0] == 3_600_000_000
    for length in (1, 10**9, 10**13, 10**17):
        level = next(i for i, w in enumerate(widths) if length <= w * 4)
        assert length // widths[level] + 2 <= 6
