"""Truth tables of the rule columns, with null and boundary values."""

from __future__ import annotations

import itertools
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from docketworks import vocab
from docketworks.functions import rules
from docketworks.functions.exact import percent
from docketworks.functions.hashing import key_hash


def evaluate(spark, schema, inputs, column):
    """The column for each input row, in input order."""
    data = [(i, *row) for i, row in enumerate(inputs)]
    frame = spark.createDataFrame(data, f"row_no int, {schema}")
    return [r[0] for r in frame.orderBy("row_no").select(column).collect()]


@pytest.mark.parametrize("age, group", [
    (None, "65+"), (0, "18-25"), (17, "18-25"), (18, "18-25"), (25, "18-25"), (26, "26-35"),
    (35, "26-35"), (36, "36-45"), (45, "36-45"), (46, "46-55"), (55, "46-55"), (56, "56-65"),
    (65, "56-65"), (66, "65+"),
])
def test_age_group(spark, age, group):
    assert evaluate(spark, "a int", [(age,)], rules.age_group(F.col("a"))) == [group]


def test_scores_and_scales(spark):
    days = [None, -83, -1, 0, 2, 3, 4, 7, 8]
    col = rules.priority_score(F.col("need"), F.col("d"))
    needed = evaluate(spark, "need boolean, d int", [(True, d) for d in days], col)
    assert needed == [6, 10, 10, 10, 10, 8, 8, 8, 6]
    assert set(evaluate(spark, "need boolean, d int", [(False, d) for d in days], col)) == {1}
    assert evaluate(spark, "need boolean, d int", [(None, None), (None, 1)], col) == [3, 10]

    scores = [(1,), (6,), (8,), (10,)]
    assert evaluate(spark, "s int", scores, rules.alert_priority(F.col("s"))) == [
        "LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert evaluate(spark, "s int", scores, rules.priority_category(F.col("s"))) == [
        "Low", "High", "Critical", "Critical"]
    assert evaluate(spark, "s int", scores, rules.raises_alert(F.col("s"))) == [
        False, False, True, True]


def test_urgency(spark):
    days = [(None,), (-83,), (0,), (3,), (4,), (7,), (8,)]
    flags = ["SCHEDULED", "URGENT", "URGENT", "URGENT", "SOON", "SOON", "SCHEDULED"]
    assert evaluate(spark, "d int", days, rules.urgency_flag(F.col("d"))) == flags
    assert evaluate(spark, "d int", days, rules.urgency_category(F.col("d"))) == [
        f.capitalize() for f in flags]


def test_need_for_representation(spark):
    """All combinations against a direct reading of the rule."""
    grid = list(itertools.product(
        [*vocab.ATTORNEY_STATUSES, None], [*vocab.SEVERITIES, None],
        [*vocab.INCOME_LEVELS, None], [None, 7, 8],
    ))

    def expected(status, severity, income, days):
        if status in (vocab.PRIVATE, vocab.ASSIGNED) or status is None:
            return False
        alone = status in (vocab.SELF, vocab.PENDING)
        return (
            (severity == "Felony" and alone)
            or income == "Low"
            or (days is not None and days <= 7 and alone)
        )

    col = rules.needs_representation(F.col("st"), F.col("se"), F.col("i"), F.col("d"))
    found = evaluate(spark, "st string, se string, i string, d int", grid, col)
    assert found == [expected(*row) for row in grid]


def test_district_code(spark):
    cases = {f"{b} Criminal Court": c for b, c in vocab.BOROUGH_CODES.items()}
    cases |= {"Nassau County Court": "Unknown", None: "Unknown", "manhattan criminal court": "Unknown"}
    found = evaluate(spark, "d string", [(d,) for d in cases], rules.district_code(F.col("d")))
    assert found == list(cases.values())


def test_repairs(spark):
    now = rules.instant(AS_OF)
    filed = AS_OF - timedelta(days=3)
    tick = timedelta(microseconds=1)
    inputs = [(filed, AS_OF), (filed, AS_OF + tick), (filed, None), (None, AS_OF + tick),
              (filed, AS_OF - tick)]
    schema = "f timestamp_ntz, h timestamp_ntz"
    col = rules.repaired_hearing(
        F.col("h").cast("timestamp"), F.col("f").cast("timestamp"), now
    ).cast("timestamp_ntz")
    assert evaluate(spark, schema, inputs, col) == [
        AS_OF, filed + timedelta(days=14), None, None, AS_OF - tick]

    zips = [(None,), (99999,), (10001,)]
    marked = rules.zip_or_marker(F.col("z"))
    assert evaluate(spark, "z int", zips, marked) == [99999, 99999, 10001]
    assert evaluate(spark, "z int", zips, rules.quality_flag(marked)) == [
        "MISSING_ZIP_CODE", "MISSING_ZIP_CODE", "CLEAN"]


def test_days_are_calendar_days(spark):
    late = datetime(2024, 5, 31, 23, 59)
    early = datetime(2024, 6, 2, 0, 1)
    col = rules.days_until(F.col("t").cast("timestamp"), rules.instant(AS_OF))
    assert evaluate(spark, "t timestamp_ntz", [(late,), (early,), (None,)], col) == [-1, 1, None]


def test_instant_accepts_zones(spark):
    zoned = datetime(2024, 6, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    same = rules.instant(zoned) == rules.instant(AS_OF)
    assert spark.range(1).select(same).first()[0] is True


def test_cost_is_repeatable_and_in_range(spark):
    frame = spark.range(2000).select(
        rules.case_cost(F.col("id"), F.col("id") % 2 == 0).alias("c"), (F.col("id") % 2).alias("odd")
    )
    low, high = frame.filter("odd = 0").agg(F.min("c"), F.max("c")).first()
    assert Decimal(1000) <= low < high < Decimal(4000)
    low, high = frame.filter("odd = 1").agg(F.min("c"), F.max("c")).first()
    assert Decimal(500) <= low < high < Decimal(2000)
    assert dict(frame.dtypes)["c"] == "decimal(10,2)"
    assert frame.exceptAll(frame).count() == 0


def test_weighted_score(spark):
    inputs = [(True, 0, "Felony", "Low"), (True, 8, "Violation", "High"), (True, None, None, None),
              (False, 0, "Felony", "Low"), (None, 0, "Felony", "Low")]
    col = rules.weighted_score(F.col("n"), F.col("d"), F.col("s"), F.col("i"))
    schema = "n boolean, d int, s string, i string"
    assert evaluate(spark, schema, inputs, col) == [10, 2, 1, 1, 1]
    heavier = rules.weighted_score(
        F.col("n"), F.col("d"), F.col("s"), F.col("i"), severity_points={"Felony": 30})
    assert evaluate(spark, schema, inputs[:1], heavier) == [37]


def test_percent_rounds_half_up_exactly(spark):
    pairs = [(77, 193, 39.9), (1, 2000, 0.1), (1, 2001, 0.0), (0, 5, 0.0), (5, 5, 100.0),
             (0, 0, None)]
    col = percent(F.col("p"), F.col("w"))
    found = evaluate(spark, "p bigint, w bigint", [p[:2] for p in pairs], col)
    assert found == [p[2] for p in pairs]


def test_key_hash_is_md5(spark):
    import hashlib

    expected = int(hashlib.md5(b"42:att").hexdigest()[:8], 16)
    assert spark.range(1).select(key_hash(F.lit(42), "att")).first()[0] == expected
