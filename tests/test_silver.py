"""Parsing of broken documents and the reports on small and empty input."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import AS_OF, plan_of, rows_of
from pyspark.sql import functions as F

from docketworks.plans import silver
from docketworks.schemas import BRONZE, PAYLOAD, SILVER, SILVER_TRACE, ddl, names

FULL = '{"case_id":"c1","defendant_id":"d1","defendant_age":30}'


def bronze(spark, documents):
    rows = [(d, datetime(2024, 5, 1), 0, i, AS_OF) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, ddl(BRONZE))


def parse_one(spark, document):
    return silver.parse(bronze(spark, [document])).first().asDict()


@pytest.mark.parametrize("age", ['"3"', "3.0", "3.7", "99999999999"])
def test_bad_number_loses_only_its_field(spark, age):
    row = parse_one(spark, f'{{"case_id":"c1","defendant_age":{age},"income_level":"Low"}}')
    assert (row["case_id"], row["defendant_age"], row["income_level"]) == ("c1", None, "Low")


@pytest.mark.parametrize("document", [
    None, "", "not json", '[{"case_id":"c1"},', '{"case_id":"i"', '{"CASE_ID":"c1"}', "{}",
])
def test_unusable_documents_become_null_rows_and_rejects(spark, document):
    row = parse_one(spark, document)
    assert all(row[name] is None for name in names(PAYLOAD))
    rejected = silver.rejects(bronze(spark, [document, FULL])).collect()
    assert [r.raw_json for r in rejected] == [document]


def test_other_shapes(spark):
    assert parse_one(spark, '{"case_id":5}')["case_id"] == "5"
    assert parse_one(spark, '{"case_id":{"a":1}}')["case_id"] == '{"a":1}'
    assert parse_one(spark, '{"case_id":"a","case_id":"b"}')["case_id"] == "b"


def test_unknown_fields_are_kept(spark):
    row = silver.parse_evolving(bronze(spark, ['{"case_id":"c","room":"R1","floor":2}'])).first()
    assert row.case_id == "c"
    assert row.extra_fields == {"room": "R1", "floor": "2"}


@pytest.mark.parametrize("text, expected", [
    ("2024-05-01T10:20:30.123456", datetime(2024, 5, 1, 10, 20, 30, 123456)),
    ("2024-05-01T10:20:30", datetime(2024, 5, 1, 10, 20, 30)),
    ("2024-05-01", datetime(2024, 5, 1)),
    ("2024-05-01T10:20:30+02:00", datetime(2024, 5, 1, 8, 20, 30)),
    ("bad", None), ("", None),
])
def test_dates(spark, text, expected):
    parsed = silver.parse(bronze(spark, [f'{{"hearing_date":"{text}"}}']))
    found = silver.read_dates(parsed).select(F.col("hearing_date").cast("timestamp_ntz")).first()[0]
    assert found == expected


def test_clean_columns_and_null_row(spark):
    cleaned = silver.clean(silver.parse(bronze(spark, ["not json"])), AS_OF)
    assert cleaned.columns == names(SILVER) + names(SILVER_TRACE)
    assert [t for _, t in cleaned.dtypes] == [
        t.replace("string", "string") for _, t in (*SILVER, *SILVER_TRACE)]
    row = cleaned.first()
    assert row.data_quality_flag == "MISSING_ZIP_CODE"
    assert row.needs_representation is False
    assert row.public_defender_eligible is None
    assert (row.defendant_age_group, row.court_district_code) == ("65+", "Unknown")


def test_reports_on_empty_input(spark):
    empty = silver.clean(silver.parse(bronze(spark, [])), AS_OF)
    report = silver.quality_report(empty).first()
    assert (report.total_records, report.needs_representation_pct) == (0, None)
    assert silver.district_summary(empty).count() == 0


def test_date_quality(spark):
    def document(filed, hearing):
        fields = [f'"{k}":"{v}"' for k, v in
                  (("case_filed_date", filed), ("hearing_date", hearing)) if v is not None]
        return "{" + ",".join(fields) + "}"

    documents = [
        document("2024-05-01", "bad"), document("bad", "2024-05-01"), document("2024-05-01", None),
        document("2024-05-02", "2024-05-01"), document("2024-05-01", "2024-06-01T00:00:00.000001"),
        document("2024-05-01", "2024-06-01"),
    ]
    found = silver.date_quality(silver.parse(bronze(spark, documents)), AS_OF).collect()
    assert {r.date_issue: r.records for r in found} == {
        "UNREADABLE_HEARING_DATE": 1, "UNREADABLE_FILED_DATE": 1, "MISSING_DATE": 1,
        "HEARING_BEFORE_FILING": 1, "HEARING_IN_FUTURE": 1, "CONSISTENT": 1,
    }


def test_records_without_position_are_not_copies(spark):
    first, later = datetime(2024, 5, 1), datetime(2024, 5, 2)
    rows = [("a", first, None, None, first), ("b", first, None, None, first), ("b", first, None, None, first),
            ("c", first, 0, None, first), ("z", first, 0, 1, first), ("y", first, 0, 1, first), ("x", first, 0, 1, later)]
    kept = silver.drop_copies(spark.createDataFrame(rows, ddl(BRONZE)).repartition(3))
    assert rows_of(kept, "raw_json") == [("a",), ("b",), ("b",), ("c",), ("y",)]  # ingested first, then smallest
    assert silver.drop_copies(spark.createDataFrame([], ddl(BRONZE))).collect() == []


def test_numbers_are_parsed_once_per_reading(spark):
    bronze = spark.createDataFrame([('{"defendant_age": "x"}', datetime(2024, 5, 1), 0, 1, datetime(2024, 5, 1))], ddl(BRONZE))
    plan = plan_of(silver.unreadable_summary(bronze))
    assert plan.count("from_json") <= 4  # typed and as text, listed once or twice in a printed plan
