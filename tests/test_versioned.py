"""Chains and facts after loads in any order against a plain rebuild; reports against the fact."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import AS_OF, rows_of
from pyspark.sql import functions as F

from docketworks.operators.chains import Tail
from docketworks.plans import serving, upkeep
from docketworks.plans.versioned import TIE, TRACKED, VersionedStar, withdrawn, withdrawn_fields
from docketworks.schemas import CASE_ATTRIBUTES, DEFENDANT_ATTRIBUTES, SILVER, SILVER_TRACE, ddl, names
from docketworks.session import Sizing
from docketworks.sources.snapshots import SnapshotStore

FIELDS = (*SILVER, *SILVER_TRACE)
START = datetime(2024, 3, 1)
TINY = Sizing(single_task_rows=15, numbering_rows=15, rows_per_partition=20)
FACT_TABLE = serving.FACT_TABLE


def event(number: int, hours: float | None, who="d1", case="c1", status="Attorney Pending", **more) -> dict:
    row = dict.fromkeys(names(FIELDS))
    return row | {
        "case_id": case, "defendant_id": who, "attorney_status": status, "case_status": "Filed",
        "court_district": "Bronx Criminal Court", "court_district_code": "BX", "assigned_judge": "Judge Brown",
        "charge_severity": "Felony", "income_level": "Low", "charge_type": "Theft", "defendant_age_group": "26-35",
        "record_timestamp": None if hours is None else START + timedelta(hours=hours),
        "case_filed_date": START + timedelta(days=number % 70), "needs_representation": number % 3 == 0,
        "days_to_hearing": number % 12, "eventhub_partition": number % 4, "eventhub_offset": number // 4,
    } | more


def frame(spark, events):
    return spark.createDataFrame([tuple(e[n] for n in names(FIELDS)) for e in events], ddl(FIELDS))


def some_events(count: int, seed: int) -> list[dict]:
    """Few keys, many changes, ties in time, and a key with most rows."""
    draw = random.Random(seed)
    return [
        event(
            n, draw.randrange(60), draw.choice(["d1", "d1", "d1", "d2", "d3"]), draw.choice(["c1", "c2", "c3", "c4"]),
            draw.choice(["Attorney Pending", "Private Attorney"]), case_status=draw.choice(["Filed", "Active"]),
            defendant_zip_code=draw.choice([10001, 10001, 99999]), court_district=draw.choice(["A", "B"]),
        ) for n in range(count)
    ]


def plain_chain(events, key, tracked):
    """Event number -> (version, begin, end, current) of its run in the history of its key."""
    found = {}
    for value in {e[key] for e in events}:
        mine = sorted((e for e in events if e[key] == value), key=lambda e: (
            e["record_timestamp"] or datetime(1900, 1, 1), e["eventhub_offset"], e["eventhub_partition"]))
        runs = []
        for e in mine:
            if not runs or [e[c] for c in tracked] != [runs[-1][0][c] for c in tracked]:
                runs.append([])
            runs[-1].append(e)
        begins = [run[0]["record_timestamp"] or datetime(1900, 1, 1) for run in runs] + [None]
        for i, run in enumerate(runs):
            for e in run:
                found[e["eventhub_partition"], e["eventhub_offset"]] = (
                    i + 1, begins[i], begins[i + 1], i + 1 == len(runs))
    return found


def found_chain(star, table):
    surrogate, _, _ = TRACKED[table]
    rows = star.rows_in_force(FACT_TABLE).select("eventhub_partition", "eventhub_offset", surrogate).join(
        star.tables()[table], surrogate
    )
    return {(r["eventhub_partition"], r["eventhub_offset"]): (
        r["record_version"], r["record_effective_date"], r["record_end_date"], r["is_current"]) for r in rows.collect()}


def check(star, events):
    kept = [e for e in events if e["case_id"] and e["defendant_id"] and e["court_district"] and e["assigned_judge"]]
    for table, (surrogate, key, tracked) in TRACKED.items():
        assert found_chain(star, table) == plain_chain(kept, key, tracked), table
        dim = star.tables()[table]
        current = {r[key]: r["count"] for r in dim.filter("is_current").groupBy(key).count().collect()}
        assert current == dict.fromkeys({e[key] for e in kept}, 1)
        sizes = dim.agg(F.count(F.lit(1)), F.count_distinct(surrogate)).first()
        assert sizes[0] == sizes[1]
    fact = star.tables()[FACT_TABLE]
    low, high, different = fact.agg(F.min("proceeding_sk"), F.max("proceeding_sk"),
                                    F.count_distinct("proceeding_sk")).first()
    assert (low, high, different, fact.count()) == (1, len(kept), len(kept), len(kept))


def check_reports(star):
    view = serving.analytics_view(serving.with_today(star.tables())).withColumn(
        "month", F.date_trunc("month", "case_filed_date").cast("date"))
    for name, report in star.reports().items():
        keys = names(upkeep.REPORTS[name])
        expected = view.groupBy(*keys).agg(
            F.count(F.lit(1)), F.count_if("needs_representation"), F.count_if("alert_triggered"),
            F.avg("representation_priority_score"), F.sum("estimated_case_cost").cast("decimal(38,2)"))
        assert rows_of(report.drop("gap_rate")) == rows_of(expected), name


def test_loads_in_any_order_equal_a_rebuild(spark, scratch):
    """With limits so small that keys are cut into slices."""
    events = some_events(60, 2)
    draw = random.Random(2)
    parts = [[], []]
    for e in events:
        parts[draw.randrange(2)].append(e)
    star = VersionedStar(SnapshotStore(spark, scratch.path("star")), AS_OF, scratch, sizing=TINY)
    loaded, keys_before, written_again = [], {}, []
    for part in parts:
        star.load(frame(spark, part))
        loaded += part
        check(star, loaded)
        # of the stored facts those were written again that point to another version now, and no other
        gone = star.store.read(withdrawn(FACT_TABLE), withdrawn_fields(FACT_TABLE), star.store.latest())
        keys = {r["proceeding_sk"]: (r["defendant_sk"], r["case_details_sk"])
                for r in star.rows_in_force(FACT_TABLE).collect()}
        written_again += sorted(p for p, k in keys_before.items() if keys[p] != k)
        assert sorted(r["proceeding_sk"] for r in gone.collect()) == sorted(written_again)
        keys_before = keys
    assert written_again
    check_reports(star)
    newest = star.store.latest()
    star.load(frame(spark, parts[1]))
    assert star.store.latest() == newest  # a repeated load adds nothing


def test_late_event_splits_a_version(spark, scratch):
    first = [event(0, 0), event(1, 10), event(2, 20, status="Private Attorney")]
    late = [event(3, 5, status="Public Defender Assigned")]
    star = VersionedStar(SnapshotStore(spark, scratch.path("star")), AS_OF, scratch, rows=10)
    star.load(frame(spark, first))
    keys = {r["eventhub_partition"]: r["defendant_sk"] for r in star.rows_in_force(FACT_TABLE).collect()}
    star.load(frame(spark, late))
    check(star, first + late)
    view = serving.analytics_view(serving.with_recorded(star.tables()))
    assert sorted(r["attorney_status"] for r in view.collect()) == sorted(e["attorney_status"] for e in first + late)
    after = {r["eventhub_partition"]: (r["defendant_sk"], r["load"]) for r in star.rows_in_force(FACT_TABLE).collect()}
    assert after[0] == (keys[0], 0) and after[2] == (keys[2], 0)  # outside the changed stretch
    assert after[1][0] not in keys.values() and after[1][1] == 1
    check_reports(star)


def test_awkward_rows(spark, scratch):
    first = [event(0, None), event(1, 3, case=None), event(2, 4, who=None), event(3, 5, court_district=None),
             event(4, 5, income_level=None, attorney_status=None), event(5, None, status="Private Attorney")]
    second = [event(6, None, status="Self-Represented"), event(7, 1, income_level=None)]
    star = VersionedStar(SnapshotStore(spark, scratch.path("star")), AS_OF, scratch)
    assert [t.count() for t in star.load(frame(spark, [])).values()] == [0, 0, 0, 0]
    for part in (first, second):
        star.load(frame(spark, part))
    check(star, first + second)
    check_reports(star)
    nameless = event(8, 2, eventhub_partition=None, eventhub_offset=None)
    star.load(frame(spark, [nameless, nameless]))  # without a hub position nothing tells a repetition
    assert star.tables()[FACT_TABLE].count() == 7


def test_reports_do_not_read_the_fact(spark, scratch):
    dimension = spark.createDataFrame(
        [("d3", "Attorney Pending", True), ("d4", "Attorney Pending", True)],
        "defendant_id string, attorney_status string, is_current boolean")
    others = [F.lit(None).cast("string").alias(c) for c in DEFENDANT_ATTRIBUTES[1:] if c != "attorney_status"]
    today = dimension.select("*", *others)
    changed = today.filter("defendant_id = 'd3'").withColumn("attorney_status", F.lit("Private Attorney"))
    store = SnapshotStore(spark, scratch.path("star"))
    rows = spark.createDataFrame([(d, "A", "A", "Felony", "Theft", None, 2, 1, 1, 8, 1, None) for d in ("d3", "d4")],
                                 ddl(upkeep.STANDING_FIELDS))
    snapshot = store.publish({upkeep.STANDING: rows})
    stored = store.read(upkeep.STANDING, upkeep.STANDING_FIELDS, snapshot)
    signed = upkeep.changes(stored, stored.limit(0), Tail(today, changed), scratch)
    assert sorted((r["attorney_status"], r["cases"]) for r in signed.collect()) == [
        ("Attorney Pending", -2), ("Private Attorney", 2)]
    assert not any(FACT_TABLE in path for path in signed.inputFiles())


def test_columns_are_those_of_the_star_schema():
    assert TRACKED["dim_defendant"][2] == tuple(DEFENDANT_ATTRIBUTES[1:])
    assert TRACKED["dim_case_details"][2] == tuple(CASE_ATTRIBUTES[1:])
    assert TIE not in names(FIELDS)
