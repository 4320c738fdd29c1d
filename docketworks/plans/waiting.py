"""How long cases wait for a lawyer, which cases a week's hours reach, and when filings changed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketworks import vocab
from docketworks.functions.rules import instant
from docketworks.operators.scd2 import changes_only
from docketworks.operators.sequence import arrange
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

#: Shares are counted in billionths and rounded down at every step.
WHOLE = 1_000_000_000
#: Hours of a lawyer that a case takes, by its severity, and hours of a district in a week.
CASE_HOURS = {"Felony": 12, "Misdemeanor": 6, "Violation": 3}
WEEK_HOURS = 400


def case_status_changes(
    updates: DataFrame, scratch: Scratch, rows: int | None = None, sizing: Sizing | None = None
) -> DataFrame:
    """Successive attorney statuses of each case (case_id, updated_at, update_key), one row per change."""
    needed = ["case_id", "attorney_status", "updated_at", "update_key"]
    sequence = arrange(updates.select(*needed), ["case_id"], ["updated_at", "update_key"], scratch, rows, sizing)
    changed = changes_only(sequence, ["attorney_status"]).where("_seen")
    return changed.frame.select(
        "case_id", F.col("_was_attorney_status").alias("from_status"),
        F.col("attorney_status").alias("to_status"), F.col("updated_at").alias("changed_at"),
    )


def time_to_lawyer(cases: DataFrame, updates: DataFrame, as_of: datetime) -> DataFrame:
    """``days`` from filing to the first update with a lawyer; without one, to ``as_of`` and ``assigned`` is false.

    ``cases`` has case_id, court_district_code and case_filed_date. The first update is a minimum per case, so
    a case with very many updates is reduced before it is joined.
    """
    lawyer = F.col("attorney_status").isin(vocab.PRIVATE, vocab.ASSIGNED)
    first = updates.filter(lawyer).groupBy("case_id").agg(F.min("updated_at").alias("_first"))
    until = F.coalesce("_first", instant(as_of))
    seconds = F.unix_timestamp(until) - F.unix_timestamp("case_filed_date")
    return cases.join(first, "case_id", "left").select(
        "case_id", "court_district_code",
        F.call_function("div", seconds, F.lit(86_400)).alias("days"), F.col("_first").isNotNull().alias("assigned"),
    )


def still_waiting(waits: DataFrame, groups: Sequence[str] = ("court_district_code",)) -> DataFrame:
    """Product-limit estimate per group: the share of cases that wait longer than each day.

    A case without a lawyer counts among those at risk until the day it is last known. The cases are
    reduced to one row per group and day; all later steps run over days. ``waiting_billionths`` is rounded
    down after each factor, so it is the same on every engine.
    """
    daily = waits.groupBy(*groups, "days").agg(
        F.count_if("assigned").alias("assigned"), F.count_if(~F.col("assigned")).alias("censored")
    )
    by_day = Window.partitionBy(*groups).orderBy("days")
    from_here = by_day.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    up_to_here = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    risk = daily.withColumn("at_risk", F.sum(F.col("assigned") + F.col("censored")).over(from_here))
    steps = F.collect_list(F.struct("days", "at_risk", "assigned")).over(up_to_here)
    share = F.aggregate(
        F.array_sort("_steps"), F.lit(WHOLE).cast("long"),
        lambda left, x: F.call_function("div", left * (x["at_risk"] - x["assigned"]), x["at_risk"]),
    )
    return risk.withColumn("_steps", steps).withColumn("waiting_billionths", share).drop("_steps")


def capacity_cuts(
    cases: DataFrame, scratch: Scratch, rows: int | None = None, sizing: Sizing | None = None,
    hours: int = WEEK_HOURS,
) -> DataFrame:
    """Cases per district and week of filing, the most urgent first, until the week's hours are used up.

    ``cases`` has court_district, case_filed_date, representation_priority_score, charge_severity and
    proceeding_sk. ``hours_used`` adds up the hours of the case and of all before it. A district with most cases is
    cut into slices, and the sums go on across them.
    """
    need = F.lit(None).cast("long")
    for severity, each in CASE_HOURS.items():
        need = F.when(F.col("charge_severity") == severity, F.lit(each).cast("long")).otherwise(need)
    lined = cases.select(
        "court_district", F.date_trunc("week", "case_filed_date").cast("date").alias("week"),
        (-F.col("representation_priority_score")).alias("_urgency"), "proceeding_sk", "case_id",
        F.coalesce(need, F.lit(0).cast("long")).alias("hours"),
    )
    line = arrange(lined, ["court_district", "week"], ["_urgency", "proceeding_sk"], scratch, rows, sizing)
    used = line.running_total({"hours_used": "hours"}).frame
    return used.select(
        "court_district", "week", "proceeding_sk", "case_id", "hours", "hours_used",
        (F.col("hours_used") <= hours).alias("within_capacity"),
    )


def change_points(fact: DataFrame, groups: Sequence[str] = ("court_district",)) -> DataFrame:
    """Per group the stretch of weeks whose filings lie most above the group's mean.

    The sum of all deviations so far, less its smallest value before, is largest at the end of that stretch; it
    begins after the week of the smallest value. Deviations are whole numbers (times the number of
    weeks). Weeks without filings count as zero. Windows run over weeks, not over the fact.
    """
    week = F.date_trunc("week", "case_filed_date").cast("date")
    weekly = fact.groupBy(*groups, week.alias("week")).agg(F.count(F.lit(1)).alias("filings"))
    spans = weekly.groupBy(*groups).agg(F.min("week").alias("_low"), F.max("week").alias("_high"))
    every = spans.select(*groups, F.explode(F.expr("sequence(_low, _high, interval 7 days)")).alias("week"))
    filled = every.join(weekly, [*groups, "week"], "left").withColumn("filings", F.coalesce("filings", F.lit(0)))
    whole, by_week = Window.partitionBy(*groups), Window.partitionBy(*groups).orderBy("week")
    so_far = by_week.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = filled.withColumns({
        "_weeks": F.count(F.lit(1)).over(whole), "_total": F.sum("filings").over(whole),
    }).withColumn("_sum", F.sum(F.col("_weeks") * F.col("filings") - F.col("_total")).over(so_far))
    # the sum before the first week is zero; of equal minima the latest gives the shortest stretch
    low = F.min(F.struct(F.col("_sum").alias("sum"), (-F.datediff("week", F.lit("1970-01-01"))).alias("day"))).over(so_far)
    start = F.struct(F.lit(0).cast("long").alias("sum"),
                     (-F.datediff(F.date_sub(F.min("week").over(whole), 7), F.lit("1970-01-01"))).alias("day"))
    risen = level.withColumn("_low", F.least(low, start)).withColumn("_rise", F.col("_sum") - F.col("_low.sum"))
    best = risen.groupBy(*groups).agg(
        F.max_by(F.struct("week", "_low", "_weeks", "_rise"), F.struct("_rise", F.datediff(F.lit("1970-01-01"), "week")))
        .alias("_best")
    )
    begins = F.date_add(F.lit("1970-01-01").cast("date"), -F.col("_best._low.day") + 7)
    return best.select(
        *groups, begins.alias("begins"), F.col("_best.week").alias("ends"),
        (F.col("_best._rise") / F.col("_best._weeks")).alias("filings_above_mean"),
    ).filter("filings_above_mean > 0")
