"""Business rules as pure Column functions.

Nothing here reads the clock: rules that need "now" take the run's ``as_of``.
Missing input follows SQL logic, so a comparison with null never matches and
the rule falls to its last branch.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketworks import vocab
from docketworks.functions.exact import cents
from docketworks.functions.hashing import key_hash

FELONY = vocab.SEVERITIES[2]
LOW_INCOME = vocab.INCOME_LEVELS[0]
ALONE = (vocab.SELF, vocab.PENDING)
ENTITLED = (vocab.SELF, vocab.REQUESTED, vocab.PENDING)


def instant(as_of: datetime | Column) -> Column:
    """``as_of`` as a timestamp literal; naive values are taken as UTC.

    Streams that must follow the clock pass ``current_timestamp()`` instead.
    """
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(f"{as_of.isoformat(sep=' ')}+00:00").cast("timestamp")


def up_to(value: Column, limits: tuple, rest) -> Column:
    """Label of the first inclusive upper limit that holds ``value``."""
    branch = F
    for limit, label in limits:
        branch = branch.when(value <= limit, F.lit(label))
    return branch.otherwise(F.lit(rest))


def at_least(value: Column, limits: tuple, rest) -> Column:
    """Label of the first inclusive lower limit that ``value`` reaches."""
    branch = F
    for limit, label in limits:
        branch = branch.when(value >= limit, F.lit(label))
    return branch.otherwise(F.lit(rest))


# --- repairs -----------------------------------------------------------------

def zip_or_marker(zip_code: Column) -> Column:
    return F.coalesce(zip_code, F.lit(vocab.MISSING_ZIP))


def hearing_lies_ahead(hearing: Column, now: Column) -> Column:
    return F.coalesce(hearing > now, F.lit(False))


def repaired_hearing(hearing: Column, filed: Column, now: Column) -> Column:
    """Any hearing after ``now`` moves to the filing date plus the repair interval."""
    moved = filed + F.expr(f"INTERVAL {vocab.REPAIR_DAYS} DAYS")
    return F.when(hearing_lies_ahead(hearing, now), moved).otherwise(hearing)


# --- clean-layer columns -----------------------------------------------------

def days_until(when: Column, now: Column) -> Column:
    """Calendar days from ``now`` to ``when``; negative once it is past."""
    return F.datediff(when, now)


def needs_representation(status: Column, severity: Column, income: Column, days: Column) -> Column:
    """Someone without a lawyer who faces a felony, is poor, or is heard soon. Never null."""
    alone = status.isin(*ALONE)
    due = (
        ((severity == FELONY) & alone)
        | ((income == LOW_INCOME) & status.isin(*ENTITLED))
        | ((days <= vocab.SOON_DAYS) & alone)
    )
    return F.coalesce(due, F.lit(False))


def defender_eligible(income: Column) -> Column:
    return income == LOW_INCOME


def age_group(age: Column) -> Column:
    return up_to(age, vocab.AGE_BANDS, vocab.AGE_BAND_REST)


def district_code(district: Column) -> Column:
    branch = F
    for borough, code in vocab.BOROUGH_CODES.items():
        branch = branch.when(district.contains(borough), code)
    return branch.otherwise(vocab.UNKNOWN_DISTRICT)


def quality_flag(zip_code: Column) -> Column:
    return F.when(zip_code == vocab.MISSING_ZIP, "MISSING_ZIP_CODE").otherwise("CLEAN")


# --- star-schema columns -----------------------------------------------------

def priority_score(needed: Column, days: Column) -> Column:
    """1 when no lawyer is needed, else 10 / 8 / 6 by closeness of the hearing."""
    urgent = F.when(~needed, vocab.SCORE_NOT_NEEDED)
    for limit, score in vocab.SCORE_BY_DAYS:
        urgent = urgent.when(days <= limit, score)
    return urgent.when(needed, vocab.SCORE_NEEDED).otherwise(vocab.SCORE_FALLBACK)


def raises_alert(score: Column) -> Column:
    return score >= vocab.ALERT_THRESHOLD


def alert_priority(score: Column) -> Column:
    return at_least(score, vocab.ALERT_STEPS, vocab.ALERT_REST)


def urgency_flag(days: Column) -> Column:
    return up_to(days, vocab.URGENCY_BANDS, vocab.URGENCY_REST)


def case_cost(case_id: Column, needed: Column) -> Column:
    """Repeatable stand-in for a uniform draw: 1000-4000 with need, 500-2000 without."""
    draw = key_hash(case_id, "cost")
    return cents(F.when(needed, draw % 300_000 + 100_000).otherwise(draw % 150_000 + 50_000))


# --- serving columns ---------------------------------------------------------

def priority_category(score: Column) -> Column:
    """The dashboard scale. It is not the alert scale: score 8 is HIGH there, Critical here."""
    return at_least(score, vocab.CATEGORY_STEPS, vocab.CATEGORY_REST)


def urgency_category(days: Column) -> Column:
    return F.initcap(urgency_flag(days))


# --- documented weighting ----------------------------------------------------

# (upper limit in days, points), points beyond; points by severity and income
PROXIMITY_POINTS = ((2, 5), (7, 3))
PROXIMITY_REST = 1
SEVERITY_POINTS = {"Felony": 3, "Misdemeanor": 2, "Violation": 1}
INCOME_POINTS = {"Low": 2, "Medium": 1, "High": 0}


def _points(value: Column, table: dict) -> Column:
    branch = F
    for label, points in table.items():
        branch = branch.when(value == label, points)
    return branch.otherwise(0)


def weighted_score(
    needed: Column,
    days: Column,
    severity: Column,
    income: Column,
    proximity_points: tuple = PROXIMITY_POINTS,
    severity_points: dict | None = None,
    income_points: dict | None = None,
) -> Column:
    """Proximity, severity and income together (2 to 10); 1 when no lawyer is needed."""
    total = (
        up_to(days, proximity_points, PROXIMITY_REST)
        + _points(severity, SEVERITY_POINTS if severity_points is None else severity_points)
        + _points(income, INCOME_POINTS if income_points is None else income_points)
    )
    return F.when(needed, total).otherwise(vocab.SCORE_NOT_NEEDED)
