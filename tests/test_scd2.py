"""Histories and merges against a direct replay of the events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from docketworks.operators import scd2
from docketworks.operators.dense_keys import add_dense_key
from docketworks.session import Sizing

DAY0 = datetime(2024, 1, 1)
TINY = Sizing(single_task_rows=20, numbering_rows=20, rows_per_partition=15)
SCHEMA = "k string, t timestamp_ntz, n int, v string, w int"
COLUMNS = ("k", "v", "w", scd2.EFFECTIVE, scd2.END, scd2.CURRENT, scd2.VERSION)


def at(day):
    return DAY0 + timedelta(days=day)


def frame_of(spark, events):
    return spark.createDataFrame([(k, at(d), n, v, w) for k, d, n, v, w in events], SCHEMA)


def replay(events):
    """Versions per key by walking the events in order."""
    by_key = {}
    for k, d, n, v, w in sorted(events, key=lambda e: (e[1], e[2])):
        versions = by_key.setdefault(k, [])
        if not versions or versions[-1][1:] != (v, w):
            versions.append((d, v, w))
    out = []
    for k, versions in by_key.items():
        for i, (d, v, w) in enumerate(versions):
            end = at(versions[i + 1][0]) if i + 1 < len(versions) else None
            out.append((k, v, w, at(d), end, end is None, i + 1))
    return sorted(out, key=lambda t: [(x is not None, x) for x in t])


def random_events(seed, count, first_day, last_day):
    rng = random.Random(seed)
    keys = ["hot"] * 12 + [None] * 2 + [f"k{i}" for i in range(8)]
    return [(rng.choice(keys), rng.randrange(first_day, last_day), n,
             rng.choice(["a", "b", None]), rng.choice([1, None])) for n in range(count)]


def build(spark, scratch, events, sizing=None):
    return scd2.history(frame_of(spark, events), ["k"], ["v", "w"], "t", ["n"], scratch,
                        sizing=sizing)


def merged(spark, scratch, stored, events, sizing=None):
    return scratch.stage(
        scd2.merge(stored, frame_of(spark, events), "sk", ["k"], ["v", "w"], "t", ["n"], scratch,
                   sizing=sizing), "merged")


def with_keys(spark, scratch, events):
    keyed = add_dense_key(build(spark, scratch, events), "sk", ["k", scd2.VERSION], scratch)
    return scratch.stage(keyed, "stored")


CASES = {
    "no change": [("a", 1, 0, "x", 1), ("a", 2, 1, "x", 1)],
    "there and back": [("a", 1, 0, "x", 1), ("a", 2, 1, "y", 1), ("a", 3, 2, "x", 1)],
    "null to value": [("a", 1, 0, None, None), ("a", 2, 1, "x", None), ("a", 3, 2, None, None)],
    "same moment": [("a", 1, 0, "x", 1), ("a", 1, 1, "y", 1), ("a", 1, 2, "z", 1)],
    "second column": [("a", 1, 0, "x", 1), ("a", 2, 1, "x", 2), ("b", 1, 2, "x", 2)],
}


@pytest.mark.parametrize("name", CASES)
def test_history_cases(spark, scratch, name):
    assert rows_of(build(spark, scratch, CASES[name]), *COLUMNS) == replay(CASES[name])


@pytest.mark.parametrize("sizing", [None, TINY])
def test_random_history(spark, scratch, sizing):
    events = random_events(5, 300, 0, 120)
    assert rows_of(build(spark, scratch, events, sizing), *COLUMNS) == replay(events)


@pytest.mark.parametrize("sizing", [None, TINY])
def test_merge_equals_history_of_everything(spark, scratch, sizing):
    first, second = random_events(1, 150, 0, 60), random_events(2, 150, 60, 120)
    second = [(k, d, n + 1000, v, w) for k, d, n, v, w in second]
    second += [("new", 80, 2000, "a", 1), ("new", 90, 2001, "b", 1)]
    first += [("only-old", 5, 3000, "a", 1)]
    stored = with_keys(spark, scratch, first)
    result = merged(spark, scratch, stored, second, sizing)
    assert rows_of(result, *COLUMNS) == replay(first + second)

    # keys of stored versions stay, new ones continue without gaps
    before = {(k, v): sk for k, v, sk in rows_of(stored, "k", scd2.VERSION, "sk")}
    after = {(k, v): sk for k, v, sk in rows_of(result, "k", scd2.VERSION, "sk")}
    assert all(after[key] == sk for key, sk in before.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))

    # exactly one current version per key
    current = result.groupBy("k").agg(F.count_if(scd2.CURRENT).alias("c"))
    assert current.filter("c <> 1").count() == 0


def test_merging_the_same_batch_again_changes_nothing(spark, scratch):
    first = [("a", 1, 0, "x", 1)]
    batch = [("a", 5, 1, "y", 1)]
    once = merged(spark, scratch, with_keys(spark, scratch, first), batch)
    twice = merged(spark, scratch, once, batch)
    assert rows_of(once) == rows_of(twice)


def test_late_event_splits_a_closed_version(spark, scratch):
    stored = with_keys(spark, scratch, [("a", 1, 0, "x", 1), ("a", 9, 1, "z", 1), ("b", 1, 2, "x", 1)])
    result = merged(spark, scratch, stored, [("a", 5, 3, "y", 1)])
    assert rows_of(result, "k", "v", scd2.VERSION, scd2.EFFECTIVE, scd2.END, "sk") == [
        ("a", "x", 1, at(1), at(5), 1), ("a", "y", 2, at(5), at(9), 4),
        ("a", "z", 3, at(9), None, 2), ("b", "x", 1, at(1), None, 3)]


def test_late_event_before_everything(spark, scratch):
    stored = with_keys(spark, scratch, [("a", 5, 0, "x", 1)])
    result = merged(spark, scratch, stored, [("a", 1, 1, "w", 1)])
    assert rows_of(result, "v", scd2.VERSION, "sk") == [("w", 1, 2), ("x", 2, 1)]


def test_empty_batch_and_empty_store(spark, scratch):
    stored = with_keys(spark, scratch, [("a", 1, 0, "x", 1)])
    assert rows_of(merged(spark, scratch, stored, [])) == rows_of(stored)
    fresh = merged(spark, scratch, scratch.stage(stored.filter("false"), "none"),
                   [("a", 1, 0, "x", 1)])
    assert rows_of(fresh, "sk", "k", scd2.VERSION) == [(1, "a", 1)]


# --- batches in any order ---------------------------------------------------------

def merged_by_log(spark, scratch, loads, sizing=None):
    """The dimension after all loads, and after each its surrogate key per opening event."""
    stored = scratch.stage(add_dense_key(
        scd2.history(frame_of(spark, loads[0]), ["k"], ["v", "w"], "t", ["n"], scratch, sizing=sizing,
                     with_ties=True), "sk", ["k", scd2.VERSION], scratch), "first")
    log = list(loads[0])
    for events in loads[1:]:
        stored = scratch.stage(scd2.merge_log(
            stored, frame_of(spark, log), frame_of(spark, events), "sk", ["k"], ["v", "w"], "t", ["n"],
            scratch, sizing=sizing), "log")
        log += events
    return stored


def test_late_event_against_a_confirmed_version(spark, scratch):
    loads = [[("a", 1, 0, "A", 1), ("a", 4, 1, "A", 1), ("a", 5, 2, "A", 1)], [("a", 3, 3, "C", 1)]]
    result = merged_by_log(spark, scratch, loads)
    assert rows_of(result, "v", scd2.EFFECTIVE, scd2.END, "sk") == [
        ("A", at(1), at(3), 1), ("A", at(4), None, 3), ("C", at(3), at(4), 2)]


def test_a_late_confirmation_moves_the_beginning_and_keeps_the_key(spark, scratch):
    loads = [[("a", 1, 0, "A", 1), ("a", 5, 1, "B", 1)], [("a", 3, 2, "B", 1)]]
    result = merged_by_log(spark, scratch, loads)
    assert rows_of(result, "v", scd2.EFFECTIVE, "sk") == [("A", at(1), 1), ("B", at(3), 2)]


def test_events_of_one_instant_delivered_twice(spark, scratch):
    both = [("a", 1, 0, "A", 1), ("a", 1, 1, "B", 1)]
    result = merged_by_log(spark, scratch, [both, both, both[1:]])
    assert rows_of(result, "v", scd2.VERSION, "sk") == [("A", 1, 1), ("B", 2, 2)]


@pytest.mark.parametrize("seed, sizing", [(1, None), (2, TINY)])
def test_batches_in_any_order_equal_the_history_of_everything(spark, scratch, seed, sizing):
    events = random_events(seed, 240, 0, 25)  # many ties
    rng = random.Random(seed)
    loads = [[], [], []]
    for event in events:
        for i in set(rng.choices(range(3), k=2)):  # some in two loads
            loads[i].append(event)
    result = merged_by_log(spark, scratch, loads, sizing)
    assert rows_of(result, *COLUMNS) == replay(events)
    numbers = [r[0] for r in rows_of(result, "sk")]
    assert numbers == list(range(1, len(numbers) + 1))
    current = result.groupBy("k").agg(F.count_if(scd2.CURRENT).alias("c"))
    assert current.filter("c <> 1").count() == 0
