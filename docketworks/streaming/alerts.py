"""Alerts while the events arrive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.functions import rules
from docketworks.plans.silver import clean, parse

EVENT_TIME = "eventhub_timestamp"
SCORE = "representation_priority_score"


def scored_stream(
    bronze: DataFrame, delay: str, as_of: datetime | Column | None = None
) -> DataFrame:
    """A bronze stream with the gold scores, watermarked ``delay`` behind the newest event."""
    now = F.current_timestamp() if as_of is None else as_of
    timed = parse(bronze.withWatermark(EVENT_TIME, delay))
    score = rules.priority_score(F.col("needs_representation"), F.col("days_to_hearing"))
    return clean(timed, now).select(
        "case_id", "defendant_id", "court_district_code", EVENT_TIME, score.alias(SCORE)
    ).withColumns({
        "alert_triggered": rules.raises_alert(F.col(SCORE)),
        "alert_priority": rules.alert_priority(F.col(SCORE)),
    })


def alert_stream(scored: DataFrame) -> DataFrame:
    """Only the triggered alerts, each as soon as its event arrives."""
    return scored.filter("alert_triggered").drop("alert_triggered")


def alert_counts(scored: DataFrame, width: str = "1 day") -> DataFrame:
    """Alerts per closed time window, district and level.

    Alerts are counted by condition and empty groups dropped afterwards. A
    filter before the aggregate would be pushed below the watermark, which then
    would wait for the next alert instead of the next event. Each task adds up
    its rows before the shuffle, so busy districts stay cheap.
    """
    counts = scored.groupBy(
        F.window(EVENT_TIME, width), "court_district_code", "alert_priority"
    ).agg(F.count_if("alert_triggered").alias("alerts"))
    return counts.filter("alerts > 0").select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "court_district_code", "alert_priority", "alerts",
    )
