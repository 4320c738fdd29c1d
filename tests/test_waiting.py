"""Waits, capacity, change points, dependencies and schema drift on small rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from conftest import AS_OF, rows_of
from pyspark.sql import functions as F

from docketworks.operators.sequence import arrange
from docketworks.plans import conformity, waiting
from docketworks.schemas import BRONZE, ddl
from docketworks.session import Sizing

TINY = Sizing(single_task_rows=10, numbering_rows=10, rows_per_partition=15)


def test_running_totals_go_on_across_slices(spark, scratch):
    draw = random.Random(4)
    rows = [(draw.choice(["hot", "hot", "hot", "a", None]), i, draw.choice([None, 1, 2, 5])) for i in range(120)]
    frame = spark.createDataFrame(rows, "key string, place long, weight long").repartition(4)
    found = arrange(frame, ["key"], ["place"], scratch, sizing=TINY).running_total({"so_far": "weight"}).frame
    totals, expected = {}, []
    for key, place, weight in rows:
        if weight is not None:
            totals[key] = totals.get(key, 0) + weight
        expected.append((key, place, totals.get(key)))
    assert rows_of(found, "key", "place", "so_far") == sorted(
        expected, key=lambda t: [(v is not None, v) for v in t])


CASE = ("court_district string, case_filed_date timestamp, representation_priority_score int, "
        "charge_severity string, proceeding_sk long, case_id string")


def test_capacity_of_one_busy_district(spark, scratch):
    monday = datetime(2024, 4, 1)
    rows = [("D", monday + timedelta(hours=i % 100), i % 3, ["Felony", "Misdemeanor", "Violation", None][i % 4], i, f"c{i}")
            for i in range(90)]
    cases = spark.createDataFrame(rows, CASE)
    plain, sliced = (
        rows_of(waiting.capacity_cuts(cases, scratch, sizing=sizing, hours=100)) for sizing in (None, TINY)
    )
    assert plain == sliced
    used = 0
    for row in sorted(rows, key=lambda r: (-r[2], r[4])):
        used += waiting.CASE_HOURS.get(row[3], 0)
        assert ("D", date(2024, 4, 1), row[4], row[5], waiting.CASE_HOURS.get(row[3], 0), used, used <= 100) in plain


def test_shares_that_still_wait(spark):
    rows = [("A", 1, True), ("A", 1, False), ("A", 2, True), ("A", 2, True), ("A", 5, False), ("B", 3, False)]
    waits = spark.createDataFrame(rows, "court_district_code string, days long, assigned boolean")
    found = rows_of(waiting.still_waiting(waits), "court_district_code", "days", "at_risk", "waiting_billionths")
    assert found == [("A", 1, 5, 800_000_000), ("A", 2, 3, 266_666_666), ("A", 5, 1, 266_666_666), ("B", 3, 1, 10**9)]
    assert waiting.still_waiting(waits.limit(0)).collect() == []


def test_cases_without_updates_are_censored(spark):
    filed = AS_OF - timedelta(days=10)
    cases = spark.createDataFrame([("c1", "A", filed), ("c2", "A", filed), ("c3", None, filed)],
                                  "case_id string, court_district_code string, case_filed_date timestamp")
    updates = spark.createDataFrame(
        [("c1", filed + timedelta(days=3, hours=5), "Private Attorney"), ("c1", filed + timedelta(days=4), "Private Attorney"),
         ("c2", filed + timedelta(days=1), "Attorney Pending"), ("cx", filed, "Private Attorney")],
        "case_id string, updated_at timestamp, attorney_status string")
    assert rows_of(waiting.time_to_lawyer(cases, updates, AS_OF)) == [
        ("c1", "A", 3, True), ("c2", "A", 10, False), ("c3", None, 10, False)]


def filings(spark, **weeks):
    rows = [(district, datetime(2024, 1, 1) + timedelta(days=7 * week, hours=i))
            for district, counts in weeks.items() for week, count in enumerate(counts) for i in range(count)]
    return spark.createDataFrame(rows, "court_district string, case_filed_date timestamp")


def test_a_planted_shift_is_found(spark):
    found = rows_of(waiting.change_points(filings(
        spark, up=[3, 3, 3, 9, 9, 9, 9], bump=[2, 2, 8, 8, 2, 2, 2], first=[9, 9, 1, 1], flat=[4, 4, 4], gap=[1, 0, 0, 7])))
    weeks = {r[0]: ((r[1] - date(2024, 1, 1)).days // 7, (r[2] - date(2024, 1, 1)).days // 7) for r in found}
    assert weeks == {"up": (3, 6), "bump": (2, 3), "first": (0, 1), "gap": (3, 3)}
    assert {r[0]: round(r[3], 6) for r in found}["gap"] == 5.0
    assert waiting.change_points(filings(spark, a=[1]).limit(0)).collect() == []


def test_dependencies(spark):
    rows = [("c1", "D1", "x"), ("c1", "D1", "x"), ("c1", "D2", "x"), ("c2", None, "y"), ("c2", None, "y"),
            ("c3", "D1", None), ("c3", None, None), (None, "D3", "z")]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    found = conformity.dependency_errors(frame, ((("a",), "b"), (("a",), "c"), (("a", "c"), "b"), (("c",), "a")))
    assert rows_of(found) == [("a -> b", 4, 2, 8, 2), ("a -> c", 4, 0, 8, 0), ("a, c -> b", 4, 2, 8, 2),
                              ("c -> a", 4, 0, 8, 0)]
    assert conformity.dependency_errors(frame.limit(0), ((("a",), "b"),)).collect() == []


def test_types_of_fields(spark):
    day = datetime(2024, 5, 1, 12)
    texts = ['{"a": 1, "b": "x", "c": null, "d": {"e": 1}, "f": [1]}', '{"a": 1.5, "b": true, "c": null}',
             '{"a": null, "b": "y", "g.h": "dotted", "": 0}', "[1]", "broken", None, "5", "{}"]
    rows = [(t, day, 0, i, day) for i, t in enumerate(texts)] + [('{"a": "text"}', day + timedelta(days=1), 0, 99, day)]
    found = {(str(r["day"]), r["field"]): (r["types"], r["records"], r["nulls"], r["conflicts"])
             for r in conformity.schema_drift(spark.createDataFrame(rows, ddl(BRONZE))).collect()}
    first = {field: value for (d, field), value in found.items() if d == "2024-05-01"}
    assert first == {
        "a": ("null,integer,number", 3, 1, False), "b": ("boolean,text", 3, 0, True), "c": ("null", 2, 2, False),
        "d": ("object", 1, 0, False), "f": ("array", 1, 0, False), "g.h": ("text", 1, 0, False),
        "": ("integer", 1, 0, False),
    }
    assert found["2024-05-02", "a"] == ("text", 1, 0, False)


def test_a_case_with_many_updates_is_reduced_first(spark):
    updates = spark.range(1000).select(
        F.lit("c1").alias("case_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("updated_at"),
        F.lit("Private Attorney").alias("attorney_status"))
    cases = spark.createDataFrame([("c1", "A", datetime(2023, 11, 14))],
                                  "case_id string, court_district_code string, case_filed_date timestamp")
    assert waiting.time_to_lawyer(cases, updates, AS_OF).collect()[0]["assigned"]
