"""Restarts, late data, repeated deliveries, and the source options."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from conftest import AS_OF, plan_of, rows_of
from pyspark.sql import functions as F

from docketworks.functions.rules import instant
from docketworks.schemas import BRONZE, HUB_RECORD, ddl
from docketworks.sources import hub
from docketworks.sources.scratch import Scratch, checkpoint_root
from docketworks.streaming import alerts, dedupe, ingest

START = datetime(2024, 3, 1)


class Hub:
    """A landing folder with a stream over it and one sink."""

    def __init__(self, spark, scratch):
        self.spark = spark
        self.landing, self.target, self.checkpoint = (
            scratch.path(n) for n in ("landing", "target", "checkpoint"))

    def deliver(self, *records):
        """Records as (hours after start, offset, payload)."""
        rows = [(bytearray(json.dumps(p).encode()), START + timedelta(hours=h), 0, o)
                for h, o, p in records]
        schema = ddl(HUB_RECORD).replace("timestamp timestamp", "timestamp timestamp_ntz")
        frame = self.spark.createDataFrame(rows, schema)
        frame = frame.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(self.landing)

    def stream(self):
        records = hub.read_hub(self.spark, "parquet", path=self.landing)
        return hub.to_bronze(records, instant(AS_OF))

    def run(self, stream):
        assert ingest.wait(
            ingest.append_stream(stream, self.target, self.checkpoint, every=None), 120)

    def stored(self, schema):
        return self.spark.read.schema(schema).parquet(self.target)


@pytest.fixture
def landing(spark, scratch):
    return Hub(spark, scratch)


def test_restart_adds_only_what_is_new(landing):
    landing.deliver((0, 1, {"case_id": "a"}), (1, 2, {"case_id": "b"}))
    landing.run(landing.stream())
    landing.run(landing.stream())
    assert landing.stored(ddl(BRONZE)).count() == 2
    landing.deliver((2, 3, {"case_id": "c"}))
    landing.run(landing.stream())
    stored = landing.stored(ddl(BRONZE))
    assert rows_of(stored, "eventhub_offset", "raw_json") == [
        (1, '{"case_id": "a"}'), (2, '{"case_id": "b"}'), (3, '{"case_id": "c"}')]


def test_stateful_streams_start_with_the_wanted_width(landing):
    landing.deliver((1, 1, {"case_id": "a"}))
    single = dedupe.drop_repeats(
        landing.stream(), ["eventhub_partition", "eventhub_offset"], "eventhub_timestamp", "1 hour")
    usual = landing.spark.conf.get(ingest.WIDTH)
    query = ingest.append_stream(
        single, landing.target, landing.checkpoint, every=None, partitions=9)
    assert ingest.wait(query, 120)
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 9
    assert landing.spark.conf.get(ingest.WIDTH) == usual


def test_repeats_are_dropped_within_and_across_batches(landing):
    def single():
        return dedupe.drop_repeats(
            landing.stream(), ["eventhub_partition", "eventhub_offset"], "eventhub_timestamp",
            "10 hours", lanes=3)

    same = (1, 7, {"case_id": "hot"})
    for _ in range(5):  # five files, so that copies meet in several lanes
        landing.deliver(*[same] * 40)
    landing.deliver((2, 8, {"case_id": "once"}))
    landing.run(single())
    assert rows_of(landing.stored(ddl(BRONZE)), "eventhub_offset") == [(7,), (8,)]
    landing.deliver(same, (3, 9, {"case_id": "new"}))
    landing.run(single())
    assert rows_of(landing.stored(ddl(BRONZE)), "eventhub_offset") == [(7,), (8,), (9,)]


URGENT = {"defendant_id": "d", "attorney_status": "Self-Represented", "charge_severity": "Felony",
          "court_district": "Queens Criminal Court", "hearing_date": "2024-05-30T00:00:00"}
QUIET = {**URGENT, "attorney_status": "Private Attorney"}


def test_alert_windows_close_by_watermark_and_drop_late_rows(landing):
    def counts():
        return alerts.alert_counts(alerts.scored_stream(landing.stream(), "6 hours", AS_OF))

    landing.deliver((1, 1, URGENT), (2, 2, URGENT), (3, 3, QUIET), (26, 4, URGENT))
    schema = counts().schema
    landing.run(counts())
    assert landing.stored(schema).count() == 0  # day 1 may still get rows until hour 30
    landing.deliver((5, 5, URGENT), (31, 6, QUIET))  # in time; a quiet event moves the watermark
    landing.run(counts())
    day = landing.stored(schema).select(F.col("window_start").cast("timestamp_ntz"), "alerts")
    assert rows_of(day) == [(START, 3)]
    landing.deliver((6, 7, URGENT), (60, 8, QUIET))  # day 1 is closed: the late row is dropped
    landing.run(counts())
    assert rows_of(landing.stored(schema), "alerts") == [(1,), (3,)]


def test_alert_feed_is_a_filter(landing):
    landing.deliver((1, 1, URGENT), (2, 2, QUIET))
    found = alerts.alert_stream(alerts.scored_stream(landing.stream(), "6 hours", AS_OF))
    landing.run(found)
    assert rows_of(landing.stored(found.schema), "alert_priority", "court_district_code") == [
        ("CRITICAL", "QN")]


def test_monitor_takes_every_record(landing):
    landing.deliver((1, 1, URGENT))
    records = hub.read_hub(landing.spark, "parquet", path=landing.landing)
    monitor = ingest.start_monitor(records, every=None)
    assert ingest.wait(monitor, 120)
    assert sum(p["numInputRows"] for p in monitor.recentProgress) == 1


def test_kafka_options():
    options = hub.kafka_options("broker:9093", "cases", login="entry", extra={"maxOffsetsPerTrigger": "9"})
    assert options["subscribe"] == "cases"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("latest", "false")
    assert options["kafka.sasl.jaas.config"] == "entry"
    assert options["maxOffsetsPerTrigger"] == "9"
    assert "kafka.sasl.jaas.config" not in hub.kafka_options("broker:9092", "cases")


def session_like(master, folder):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)


def test_scratch_folder_is_the_one_the_cluster_shares():
    assert checkpoint_root(session_like("yarn", "hdfs://shared/ck/")) == "hdfs://shared/ck"
    assert checkpoint_root(session_like("local[4]", "/shared")) == "/shared"
    with pytest.raises(RuntimeError):
        checkpoint_root(session_like("yarn", None))


def test_staged_tables_are_files_and_can_be_dropped(spark, tmp_path):
    run = Scratch(spark, str(tmp_path))
    stored = run.stage(spark.range(5), "five")
    assert stored.count() == 5 and "FileScan" in plan_of(stored)
    run.close()
    assert list(tmp_path.iterdir()) == []
