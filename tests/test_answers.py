"""Alerts without an answer, episodes, and the sink that stores once; micro-batches, restarts and failures."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import AS_OF, rows_of
from pyspark.sql import functions as F
from test_streams import START, Hub

from docketworks.schemas import BRONZE, ddl
from docketworks.streaming import answers, exactly_once, ingest
from docketworks.streaming.exactly_once import OnceSink

DELAY = "1 day"


@pytest.fixture
def landing(spark, scratch):
    return Hub(spark, scratch)


def alert(who="d1", case="c1", **more):
    return {"case_id": case, "defendant_id": who, "attorney_status": "Self-Represented", "charge_severity": "Felony",
            "court_district": "Bronx Criminal Court", "case_filed_date": "2024-05-01T00:00:00",
            "hearing_date": "2024-05-20T00:00:00", **more}


def lawyer(who="d1"):
    return alert(who, attorney_status="Private Attorney")


def hours(row):
    return int((row - START).total_seconds() // 3600)


def test_only_alerts_without_a_lawyer_in_time(landing):
    def run():
        landing.run(answers.unanswered(landing.stream(), DELAY, AS_OF))
        return sorted((r["defendant_id"], hours(r["eventhub_timestamp"]))
                      for r in landing.stored(answers.unanswered(landing.stream(), DELAY, AS_OF).schema).collect())

    landing.deliver((0, 1, alert("d1")), (0, 2, alert("d2")), (0, 3, alert("d3")), (0, 4, alert("d4")))
    assert run() == []
    # in time, at the last moment, too late; and one before the alert does not count
    landing.deliver((10, 5, lawyer("d1")), (48, 6, lawyer("d2")), (49, 7, lawyer("d3")))
    run()
    landing.deliver((100, 8, alert("d9")), (100, 9, lawyer("d9")), (99, 10, lawyer("d8")), (100, 11, alert("d8")))
    assert run() == [("d3", 0), ("d4", 0)]
    landing.deliver((400, 12, alert("d1")), (400, 13, lawyer("d7")))
    assert run() == [("d3", 0), ("d4", 0), ("d8", 100)]  # nothing comes twice after a restart
    assert run() == [("d3", 0), ("d4", 0), ("d8", 100)]


def test_episodes_are_merged_across_batches(landing):
    def run():
        stream = answers.episodes(landing.stream(), DELAY, AS_OF, quiet="2 days")
        landing.run(stream)
        return sorted((r["defendant_id"], hours(r["episode_begin"]), hours(r["episode_end"]), r["alerts"],
                       r["highest_score"]) for r in landing.stored(stream.schema).collect())

    low = {"hearing_date": "2024-06-08T00:00:00", "case_filed_date": "2024-05-24T00:00:00"}  # a score of 8
    landing.deliver((0, 1, alert("d1", **low)), (60, 2, alert("d1", **low)), (0, 3, alert("d2", **low)))
    assert run() == []
    landing.deliver((40, 4, alert("d1")), (61, 5, lawyer("d1")))  # connects the two runs, which were apart
    assert run() == []
    landing.deliver((200, 6, alert("d1")))
    run()
    landing.deliver((500, 7, alert("d3")))
    assert run() == [("d1", 0, 60, 3, 10), ("d1", 200, 200, 1, 10), ("d2", 0, 0, 1, 8)]


def bronze(spark, *records):
    """(hours, partition, offset, text) as bronze records."""
    rows = [(t, START + timedelta(hours=h), p, o, START) for h, p, o, t in records]
    return spark.createDataFrame(rows, ddl(BRONZE))


def texts(sink):
    return [r[0] for r in rows_of(sink.read(), "raw_json")]


def test_copies_and_replays_are_stored_once(spark, scratch):
    folder = scratch.path("once")
    sink = OnceSink(spark, folder, "w1")
    sink.store(bronze(spark, (0, 0, 1, "a"), (0, 0, 2, "b"), (0, 0, 2, "b"), (0, 1, 1, "c")), 0)
    sink.store(bronze(spark, (0, 0, 1, "never read"), (0, 0, 9, "nor this")), 0)  # a batch that the ledger has
    sink.store(bronze(spark, (9000, 0, 2, "b"), (9000, 0, 3, "d"), (9000, 1, 2, "e")), 1)  # a year later
    assert texts(sink) == ["a", "b", "c", "d", "e"]
    other = OnceSink(spark, folder, "w2")  # a new checkpoint begins with batch 0 again
    other.store(bronze(spark, (0, 0, 1, "a"), (0, 1, 2, "e"), (9999, 1, 3, "f")), 0)
    assert texts(other) == ["a", "b", "c", "d", "e", "f"]
    nameless = bronze(spark, (0, None, None, "g"), (0, None, None, "g"), (0, None, 4, "h"))
    sink.store(nameless, 2)
    sink.store(nameless, 2)
    assert texts(sink) == ["a", "b", "c", "d", "e", "f", "g", "g", "h"]
    sink.store(bronze(spark), 3)
    assert sink.ledger().count() == 5


def test_the_filter_names_the_batches_that_may_hold_a_copy(spark, scratch):
    sink = OnceSink(spark, scratch.path("once"), "w")
    for batch in range(4):  # interleaved offsets, so that ranges tell nothing
        sink.store(bronze(spark, *[(0, 0, 4 * i + batch, f"{batch}-{i}") for i in range(300)]), batch)

    def suspects(*offsets):
        records = bronze(spark, *[(0, 0, o, "") for o in offsets])
        near = sink.near(records)
        sizes = [r[0] for r in near.select("filter_bits").distinct().collect()]
        return {r["batch"] for r in sink.suspects(records, near, sizes).collect()}

    assert sink.near(bronze(spark, (0, 0, 50, ""))).count() == 4
    assert sink.near(bronze(spark, (0, 0, 5000, ""), (0, 1, 50, ""))).count() == 0
    assert suspects(4 * 100 + 2) == {2}
    assert suspects(*range(3, 1200, 4)) >= {3}
    # false alarms are rare: of offsets that no batch holds hardly any is suspected
    sink.store(bronze(spark, (0, 0, 100_000, "far")), 4)
    assert len(suspects(*range(50_000, 50_200))) <= 1


def test_killed_between_write_and_ledger(landing, monkeypatch):
    folder, checkpoint = landing.target, landing.checkpoint
    sink = OnceSink(landing.spark, folder, "any")

    def run():
        query = exactly_once.start_once(landing.stream(), folder, checkpoint, every=None)
        ingest.wait(query, 120)

    landing.deliver((0, 1, {"case_id": "a"}), (1, 2, {"case_id": "b"}))
    with monkeypatch.context() as broken:
        def killed(*_):
            raise RuntimeError("killed")

        broken.setattr(OnceSink, "finish", killed)
        with pytest.raises(Exception, match="killed"):
            run()
    assert sink.read().count() == 0  # written, but not in the ledger
    landing.deliver((2, 3, {"case_id": "c"}), (2, 1, {"case_id": "a"}))
    run()
    run()
    landing.deliver((9000, 2, {"case_id": "b"}), (9000, 4, {"case_id": "d"}))
    run()
    cases = sink.read().select(F.get_json_object("raw_json", "$.case_id").alias("c"))
    assert [r[0] for r in rows_of(cases)] == ["a", "b", "c", "d"]
