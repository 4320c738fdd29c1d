"""Reports kept up to date by signed changes, without reading the fact.

Reports group proceedings by the court, by the case as it was recorded, and by what is known of the
defendant today. ``standing`` holds the sums of the proceedings of each defendant per court, case
attributes and month, so that they can be moved as a whole when a defendant's current version changes: the sums
are taken back under the old attributes and added under the new ones. Both tables only grow by rows of a
load; reading a report adds up its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.functions.exact import mean, percent
from docketworks.operators.chains import Tail
from docketworks.operators.scd2 import CURRENT
from docketworks.plans.silver import count_true
from docketworks.schemas import DEFENDANT_ATTRIBUTES, Fields, names
from docketworks.session import side_by_side
from docketworks.sources.scratch import Scratch
from docketworks.sources.snapshots import SnapshotStore

NEED, SCORE = "needs_representation", "representation_priority_score"
STANDING = "standing"
KNOWN: Fields = (
    ("court_district", "string"), ("court_district_code", "string"), ("charge_severity", "string"),
    ("charge_type", "string"), ("month", "date"),
)
SUMS: Fields = (
    ("cases", "bigint"), ("gap_cases", "bigint"), ("alerts", "bigint"), ("score_total", "bigint"),
    ("scored", "bigint"), ("cost", "decimal(38,2)"),
)
STANDING_FIELDS: Fields = (("defendant_id", "string"), *KNOWN, *SUMS)

# report -> its keys with their types
REPORTS: dict[str, Fields] = {
    "upkept_gap": (("court_district", "string"), ("court_district_code", "string"),
                   ("charge_severity", "string"), ("income_level", "string")),
    "upkept_attorneys": (("court_district_code", "string"), ("attorney_status", "string")),
    "upkept_demographics": (("defendant_age_group", "string"), ("income_level", "string"), ("charge_type", "string")),
    "upkept_budget": (("court_district", "string"), ("month", "date"), ("attorney_status", "string")),
}


def _fields(name: str) -> Fields:
    return (*REPORTS[name], *SUMS)


def standing_of(measured: DataFrame) -> DataFrame:
    """Sums of measured proceedings per defendant, court, case attributes and month."""
    rows = measured.withColumn("month", F.date_trunc("month", "case_filed_date").cast("date"))
    summed = rows.groupBy("defendant_id", *names(KNOWN)).agg(
        F.count(F.lit(1)).alias("cases"),
        count_true(F.col(NEED)).alias("gap_cases"),
        count_true(F.col("alert_triggered")).alias("alerts"),
        F.coalesce(F.sum(SCORE), F.lit(0)).cast("bigint").alias("score_total"),
        F.count(SCORE).alias("scored"),
        F.coalesce(F.sum("estimated_case_cost"), F.lit(0)).cast("decimal(38,2)").alias("cost"),
    )
    return summed.select(*names(STANDING_FIELDS))


def _signed(frame: DataFrame, sign: int) -> DataFrame:
    return frame.withColumns({name: (F.col(name) * sign).cast(kind) for name, kind in SUMS})


def changes(stored: DataFrame | None, fresh: DataFrame, defendants: Tail, scratch: Scratch) -> DataFrame:
    """Signed standing rows with the defendant's attributes: new ones, and old ones that move.

    Of the stored rows only those of defendants are read whose current attributes the load changed.
    """
    attributes = DEFENDANT_ATTRIBUTES[1:]
    today = defendants.after.filter(CURRENT).select("defendant_id", *attributes)
    new = fresh.join(today, "defendant_id")
    if stored is None:
        return new
    once = defendants.before.filter(CURRENT).select(
        F.col("defendant_id").alias("_id"), F.struct(*attributes).alias("_once")
    )
    changed = scratch.stage(
        today.select("defendant_id", F.struct(*attributes).alias("_today")).join(
            once, F.col("defendant_id") == F.col("_id")
        ).filter("_once <> _today").drop("_id"), "changed-defendants"
    )
    old = scratch.stage(stored.join(changed, "defendant_id"), "moving-sums")

    def under(which: str, sign: int) -> DataFrame:
        return _signed(old.select(*names(STANDING_FIELDS), f"{which}.*"), sign)

    return new.unionByName(under("_once", -1)).unionByName(under("_today", 1))


def _added_up(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(*names(REPORTS[name])).agg(
        *[F.sum(column).cast(kind).alias(column) for column, kind in SUMS]
    )


def write(
    store: SnapshotStore, snapshot: str, before: str | None, measured: DataFrame, defendants: Tail, scratch: Scratch
) -> None:
    """The part of a load in the standing sums and in every report."""
    stored = None if before is None else store.read(STANDING, STANDING_FIELDS, before)
    fresh = store.write(snapshot, STANDING, standing_of(measured))
    signed = scratch.stage(changes(stored, fresh, defendants, scratch), "signed-sums")
    moved = reduce(lambda a, b: a | b, [F.col(column) != 0 for column, _ in SUMS])
    side_by_side(*[
        lambda name=name: store.write(snapshot, name, _added_up(signed, name).filter(moved)) for name in REPORTS
    ])


def read(store: SnapshotStore, name: str, snapshot: str | None = None) -> DataFrame:
    """A report as of the newest load; it has a row for every group with proceedings."""
    whole = _added_up(store.read(name, _fields(name), snapshot), name).filter("cases > 0")
    return whole.select(
        *names(REPORTS[name]), "cases", "gap_cases", percent(F.col("gap_cases"), F.col("cases")).alias("gap_rate"),
        "alerts", mean(F.col("score_total"), F.col("scored")).alias("avg_priority_score"),
        F.col("cost").alias("total_cost"),
    )
