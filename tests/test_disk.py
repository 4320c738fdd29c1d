"""What a load leaves on disk: its own tables, no intermediate ones and no shuffle files."""

from __future__ import annotations

import os
import time

import pytest
from conftest import AS_OF, rows_of
from pyspark.sql import functions as F
from test_versioned import check, check_reports, frame, some_events

from docketworks.plans.versioned import VersionedStar
from docketworks.sources.scratch import Scratch, passing
from docketworks.sources.snapshots import SnapshotStore


def test_a_load_deletes_what_it_staged(spark, tmp_path):
    scratch = Scratch(spark, str(tmp_path))
    events = some_events(30, 7)
    kept = scratch.stage(frame(spark, events), "silver")
    star = VersionedStar(SnapshotStore(spark, scratch.path("gold")), AS_OF, scratch, 30)
    for part in (events[::2], events[1::2], events[1::2]):
        star.load(frame(spark, part))
        assert sorted(os.listdir(scratch.base)) == ["000-silver", "001-gold"]
    assert kept.count() == 30
    check(star, events)
    check_reports(star)


def test_a_failed_step_deletes_what_it_staged(spark, tmp_path):
    scratch = Scratch(spark, f"{tmp_path}/a b%20c")
    kept = scratch.stage(spark.range(3), "kept")
    with pytest.raises(ZeroDivisionError), passing(scratch) as step:
        assert rows_of(step.stage(kept, "gone")) == [(0,), (1,), (2,)]
        assert len(os.listdir(scratch.base)) == 2
        1 / 0
    assert [name.rpartition("-")[2] for name in os.listdir(scratch.base)] == ["kept"]


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return files.mkString("\n").count("/shuffle_")


def test_shuffle_files_go_with_their_action(spark, scratch):
    before = shuffle_files(spark)
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    stored = scratch.stage(rows, "sums")
    until = time.time() + 20  # they are removed beside the next steps
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert rows_of(stored) == rows_of(rows)
