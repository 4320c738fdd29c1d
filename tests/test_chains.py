"""Versions, stored rows and new rows on one time line."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import AS_OF, rows_of
from test_scale import shuffles
from test_versioned import FACT_TABLE, START, check, check_reports, event, frame

from docketworks.operators.chains import intervals, merge_tail, moved_rows, versions_of
from docketworks.operators.scd2 import CURRENT, EFFECTIVE, END, VERSION
from docketworks.plans.versioned import STORED, VersionedStar
from docketworks.session import Sizing
from docketworks.sources.snapshots import SnapshotStore


class Shuffles:
    """The scratch of a test with the shuffles by key that each stored table took."""

    def __init__(self, scratch):
        self.scratch, self.spark, self.path, self.taken = scratch, scratch.spark, scratch.path, {}

    def stage(self, rows, label):
        self.taken[label] = shuffles(rows)
        return self.scratch.stage(rows, label)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


@pytest.mark.parametrize("sizing", [Sizing(), Sizing(single_task_rows=2, numbering_rows=2, rows_per_partition=2)])
def test_rows_meet_their_versions_on_one_line(spark, scratch, sizing):
    place = f"d string, v string, {EFFECTIVE} timestamp, tie int, sk bigint, {END} timestamp, {CURRENT} boolean"
    stored = spark.createDataFrame([
        ("a", "A", at(1), 0, 1, at(5), False, 1), ("a", "B", at(5), 0, 2, None, True, 2),
        ("c", "A", at(1), None, 3, None, True, 1), ("n", "A", at(0), 0, 4, at(1), False, 1),
        ("n", "B", at(1), 0, 5, None, True, 2)], f"{place}, {VERSION} int")
    # row 2 pointed to another version once; "c" is not touched, and "n" only after its first version
    rows = spark.createDataFrame([
        (1, "a", at(1), 0, 1, 0), (2, "a", at(4), 0, 9, 0), (2, "a", at(4), 0, 1, 1), (3, "a", at(5), 0, 2, 0),
        (7, "c", at(1), None, 3, 0), (8, "n", at(0), 0, 4, 0), (9, "n", at(3), 0, 5, 0)],
        "row bigint, d string, t timestamp, tie int, sk bigint, load int")
    batch = spark.createDataFrame([
        (4, "a", "C", at(2), 0), (5, "b", "A", at(0), None), (6, "b", "A", at(3), 0), (10, "n", "B", at(2), 0)],
        "row bigint, d string, v string, t timestamp, tie int")
    taken = Shuffles(scratch)
    tail = merge_tail(stored, rows, batch, "row", "sk", ["d"], ["v"], "t", ["tie"], taken, 10, sizing=sizing, load="load")
    if sizing == Sizing():
        assert taken.taken["tail-placed"] == 1
    assert rows_of(tail.before, "sk") == [(1,), (2,), (5,)]
    assert rows_of(tail.after, "d", VERSION, "v", "sk", EFFECTIVE, END, CURRENT, "_changed") == [
        ("a", 1, "A", 1, at(1), at(2), False, True), ("a", 2, "C", 11, at(2), at(4), False, True),
        ("a", 3, "A", 12, at(4), at(5), False, True), ("a", 4, "B", 2, at(5), None, True, True),
        ("b", 1, "A", 13, at(0), None, True, True), ("n", 2, "B", 5, at(1), None, True, False)]
    stretches = intervals(tail, "sk", ["d"], ["tie"], scratch, sizing=sizing)
    assert rows_of(moved_rows(stretches), "row", "t", "was", "now") == [(2, at(4), 1, 12)]
    assert rows_of(versions_of(stretches, "row", "sk")) == [(4, 11), (5, 13), (6, 13), (10, 5)]


def test_a_proceeding_that_moved_before_moves_again(spark, scratch):
    parts = [[event(0, 0), event(1, 10), event(2, 12)], [event(3, 5, status="Private Attorney")],
             [event(4, 11, status="Self-Represented")], [event(5, 13, status="Private Attorney"), event(6, 1)]]
    star = VersionedStar(SnapshotStore(spark, scratch.path("star")), AS_OF, scratch, rows=10)
    for part in parts:
        star.load(frame(spark, part))
    stored = star.store.read(FACT_TABLE, STORED[FACT_TABLE])
    assert stored.count() == 7 + 2 + 1  # two rows moved, one of them twice
    check(star, [e for part in parts for e in part])
    check_reports(star)
