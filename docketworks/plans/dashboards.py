"""Dashboard queries over the fact and the analytics view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketworks.functions import rules
from docketworks.functions.exact import mean, percent
from docketworks.operators.ranking import top_per_group
from docketworks.operators.scd2 import changes_only
from docketworks.operators.sequence import arrange
from docketworks.plans.silver import count_true
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

NEED = "needs_representation"
SCORE = "representation_priority_score"


def _rows():
    return F.count(F.lit(1))


def _gap():
    return count_true(F.col(NEED))


def work_queue(view: DataFrame, size: int = 20) -> DataFrame:
    """The next cases per district: highest score, then closest hearing, then key."""
    order = [F.desc(SCORE), F.asc_nulls_last("days_to_hearing"), F.asc("proceeding_sk")]
    queue = top_per_group(view.filter(NEED), ["court_district"], order, size, "queue_position")
    return queue.select(
        "court_district", "queue_position", "proceeding_sk", "case_id", "defendant_id",
        SCORE, "days_to_hearing", "attorney_status",
    )


def weekly_trend(fact: DataFrame) -> DataFrame:
    """Filings and gap per week with the change from the week before.

    A week without filings has no row and counts as zero for the week after it. The
    window runs over one row per week, not over the fact.
    """
    weekly = fact.groupBy(F.date_trunc("week", "case_filed_date").cast("date").alias("week")).agg(
        _rows().alias("filings"), _gap().alias("gap_cases"),
        percent(_gap(), _rows()).alias("gap_rate"),
    )
    by_week = Window.orderBy("week")
    earlier = F.lag("week").over(by_week)

    def change(column: str):
        before = F.when(F.date_diff("week", earlier) == 7, F.lag(column).over(by_week)).otherwise(0)
        return F.when(earlier.isNotNull(), F.col(column) - before)

    return weekly.withColumns({
        "filings_change": change("filings"), "gap_change": change("gap_cases"),
    })


def demographics(view: DataFrame) -> DataFrame:
    """Gap by age group, by income, by charge type, and overall, in one pass.

    The rows are reduced to one per combination of keys first; the sets expand those.
    """
    keys = ["defendant_age_group", "income_level", "charge_type"]
    cells = view.groupBy(*keys).agg(_rows().alias("_cases"), _gap().alias("_gap"))
    grouped = cells.groupingSets([[F.col(k)] for k in keys] + [[]], *[F.col(k) for k in keys])
    return grouped.agg(
        F.grouping_id(*keys).cast("int").alias("grouping_level"), *_resummed()
    )


def _resummed():
    """Figures from sums per cell; those of no cell at all are zero."""
    cases, gap = (F.coalesce(F.sum(c), F.lit(0).cast("long")) for c in ("_cases", "_gap"))
    return cases.alias("cases"), gap.alias("gap_cases"), percent(gap, cases).alias("gap_rate")


def geo_rollup(view: DataFrame) -> DataFrame:
    """Gap per judge, per district and overall."""
    keys = ["court_district", "assigned_judge"]
    cells = view.groupBy(*keys).agg(
        _rows().alias("_cases"), _gap().alias("_gap"), F.sum("estimated_case_cost").alias("_cost")
    )
    return cells.rollup(*keys).agg(
        F.grouping_id(*keys).cast("int").alias("grouping_level"), *_resummed(),
        F.sum("_cost").alias("total_cost"),
    )


def budget_by_month(view: DataFrame) -> DataFrame:
    """Estimated cost per month and district with the running total of the district."""
    month = F.date_trunc("month", "case_filed_date").cast("date").alias("month")
    monthly = view.groupBy("court_district", month).agg(
        _rows().alias("cases"), F.sum("estimated_case_cost").alias("month_cost")
    )
    so_far = Window.partitionBy("court_district").orderBy("month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return monthly.withColumn("running_cost", F.sum("month_cost").over(so_far))


def executive_kpis(view: DataFrame) -> DataFrame:
    """One row. Districts and courts are few and gathered as sets, so that the only distinct
    count is that of the defendants and no row is copied per count."""
    courts = F.collect_set(F.when(
        F.col("court_district").isNotNull() & F.col("assigned_judge").isNotNull(),
        F.struct("court_district", "assigned_judge"),
    ))
    return view.agg(
        _rows().alias("proceedings"),
        _gap().alias("gap_cases"),
        percent(_gap(), _rows()).alias("gap_rate"),
        count_true(F.col("alert_triggered")).alias("alerts"),
        count_true(F.col("alert_priority") == "CRITICAL").alias("critical_alerts"),
        F.size(F.collect_set("court_district")).cast("long").alias("districts"),
        F.size(courts).cast("long").alias("courts"),
        F.count_distinct("defendant_id").alias("defendants"),
        mean(F.sum(SCORE), F.count(SCORE)).alias("avg_priority_score"),
        F.sum("estimated_case_cost").alias("total_cost"),
    )


def weighted_scores(view: DataFrame, **weights) -> DataFrame:
    """The documented weighting next to the proximity score, which it never replaces."""
    return view.select(
        "proceeding_sk", "case_id", SCORE,
        rules.weighted_score(
            F.col(NEED), F.col("days_to_hearing"),
            F.col("charge_severity"), F.col("income_level"), **weights,
        ).alias("weighted_score"),
    )


def status_changes(
    silver: DataFrame,
    keys: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    sizing: Sizing | None = None,
) -> DataFrame:
    """Successive attorney statuses of each key, one row per change."""
    order = ["record_timestamp", "case_id", "eventhub_partition", "eventhub_offset"]
    needed = list(dict.fromkeys([*keys, "attorney_status", *order]))
    sequence = arrange(silver.select(*needed), keys, order, scratch, rows, sizing)
    changed = changes_only(sequence, ["attorney_status"]).where("_seen")
    return changed.frame.select(
        *keys,
        *(c for c in ("case_id",) if c not in keys),
        F.col("_was_attorney_status").alias("from_status"),
        F.col("attorney_status").alias("to_status"),
        F.col("record_timestamp").alias("changed_at"),
    )
