"""Views and check queries over the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.functions import rules
from docketworks.functions.exact import mean, percent
from docketworks.plans.silver import count_true
from docketworks.plans.star import FACT_TABLE
from docketworks.schemas import TEXT_LIMITS

Tables = Mapping[str, DataFrame]

# Fixed names of the analytics view
DEFENDANT_COLUMNS = [
    "defendant_age", "defendant_age_group", "defendant_gender", "income_level",
    "defendant_zip_code", "attorney_status", "public_defender_eligible",
]
CASE_COLUMNS = ["charge_type", "charge_severity", "case_status", "hearing_type"]
VIEW_COLUMNS = [
    "proceeding_sk", "case_id", "defendant_id", "case_filed_date", "hearing_date",
    "days_to_hearing", "case_duration_days", "needs_representation",
    "representation_priority_score", "alert_triggered", "alert_priority", "intervention_needed",
    "estimated_case_cost", "hearing_urgency_flag",
    *DEFENDANT_COLUMNS, *CASE_COLUMNS,
    "court_district", "court_district_code", "assigned_judge",
    "priority_category", "hearing_urgency_category",
]
GAP_KEYS = ["court_district", "court_district_code", "charge_severity", "income_level"]

SCORE = "representation_priority_score"
BROADCAST_ROWS = 10_000


def _current(dim: DataFrame, attributes: list[str]) -> DataFrame:
    """Key and attributes of the versions in force."""
    return dim.filter("is_current").select(dim.columns[0], *attributes)


def _star(fact: DataFrame, tables: Tables) -> DataFrame:
    """Fact with the attributes of its dimensions. Catalyst prunes what is not used.

    A proceeding that points to a closed version is not shown. Where versions are closed, the tables come
    from ``with_recorded`` or ``with_today``, which show every proceeding.
    """
    courts = tables["dim_court"].drop("created_timestamp")
    defendants = _current(tables["dim_defendant"], DEFENDANT_COLUMNS)
    cases = _current(tables["dim_case_details"], CASE_COLUMNS)
    return (
        fact.join(courts, "court_sk")
        .join(cases, "case_details_sk")
        .join(defendants, "defendant_sk")
    )


def _with_categories(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "priority_category": rules.priority_category(F.col(SCORE)),
        "hearing_urgency_category": rules.urgency_category(F.col("days_to_hearing")),
    }).select(*VIEW_COLUMNS)


VERSIONED = (("dim_defendant", "defendant_id", DEFENDANT_COLUMNS), ("dim_case_details", "case_id", CASE_COLUMNS))


def with_recorded(tables: Tables) -> dict[str, DataFrame]:
    """Tables for reports that show each proceeding with what was recorded then, closed versions included."""
    return {**tables, **{name: tables[name].withColumn("is_current", F.lit(True)) for name, _, _ in VERSIONED}}


def with_today(tables: Tables) -> dict[str, DataFrame]:
    """Tables for reports that show each proceeding with what is known today.

    The attributes of every version are replaced by those of the current one of its key, of which there is one.
    """
    changed = dict(tables)
    for name, key, attributes in VERSIONED:
        dim = tables[name]
        today = dim.filter("is_current").select(key, *attributes)
        closed = dim.filter("NOT is_current").drop(*attributes).join(today, key)
        closed = closed.withColumn("is_current", F.lit(True)).select(*dim.columns)
        changed[name] = dim.filter("is_current").unionByName(closed)
    return changed


def analytics_view(tables: Tables) -> DataFrame:
    """The 30-column view: fact, current dimension attributes and two categories."""
    return _with_categories(_star(tables[FACT_TABLE], tables))


def gap_summary(tables: Tables) -> DataFrame:
    """Representation gap per district, severity and income of the current versions."""
    rows = F.count(F.lit(1))
    return _star(tables[FACT_TABLE], tables).groupBy(*GAP_KEYS).agg(
        rows.alias("total_cases"),
        count_true(F.col("needs_representation")).alias("cases_needing_representation"),
        count_true(F.col("alert_triggered")).alias("alerts_triggered"),
        mean(F.sum(SCORE), F.count(SCORE)).alias("avg_priority_score"),
        F.sum("estimated_case_cost").alias("total_estimated_cost"),
    )


def top_cases(tables: Tables, rows: int = 10) -> DataFrame:
    """The most urgent cases that need a lawyer, with all view columns.

    The winners are found on keys and sort columns alone. Only they are then
    joined with the wide columns; a handful of rows is broadcast, so no
    dimension is shuffled for its attributes.
    """
    def few(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame

    order = [F.desc(SCORE), F.asc_nulls_last("days_to_hearing"), F.asc("proceeding_sk")]
    slim = (
        tables[FACT_TABLE].filter("needs_representation")
        .select("proceeding_sk", "defendant_sk", "case_details_sk", "court_sk",
                SCORE, "days_to_hearing")
        .join(tables["dim_court"].select("court_sk"), "court_sk", "left_semi")
        .join(_current(tables["dim_case_details"], []), "case_details_sk", "left_semi")
        .join(_current(tables["dim_defendant"], []), "defendant_sk", "left_semi")
        .orderBy(*order).limit(rows)
    )
    chosen = few(tables[FACT_TABLE].join(few(slim.select("proceeding_sk")), "proceeding_sk"))
    return _with_categories(_star(chosen, tables)).orderBy(*order)


def validation_stats(tables: Tables, approximate: bool = False) -> DataFrame:
    """Totals over the view; ``approximate`` trades exact distinct counts for sketches."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    rows = F.count(F.lit(1))
    return analytics_view(tables).agg(
        rows.alias("total_proceedings"),
        count_true(F.col("needs_representation")).alias("needs_representation_count"),
        mean(F.sum(SCORE), F.count(SCORE)).alias("avg_priority_score"),
        # courts are few: gathered as a set, so that no row is copied for a second distinct count
        F.size(F.collect_set("court_district")).cast("long").alias("unique_courts"),
        distinct("defendant_id").alias("unique_defendants"),
    )


# --- reports on the fact alone -----------------------------------------------

def gold_summary(fact: DataFrame) -> DataFrame:
    rows, need = F.count(F.lit(1)), count_true(F.col("needs_representation"))

    def alerts(level: str) -> Column:
        return count_true(F.col("alert_priority") == level)

    return fact.agg(
        rows.alias("total_proceedings"),
        need.alias("needs_representation_count"),
        percent(need, rows).alias("needs_representation_pct"),
        alerts("HIGH").alias("high_priority_alerts"),
        alerts("CRITICAL").alias("critical_alerts"),
    )


def alert_distribution(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("alert_priority").agg(F.count(F.lit(1)).alias("proceedings"))
    return counts.orderBy(F.desc("proceedings"), "alert_priority")


def urgency_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hearing_urgency_flag").agg(F.count(F.lit(1)).alias("proceedings"))


def text_lengths(tables: Tables) -> DataFrame:
    """Per text column of the serving tables: declared length, longest value, values beyond.

    The declared lengths are not enforced by Parquet, so this is the check. One
    pass per table.
    """
    parts = []
    for table, limits in TEXT_LIMITS.items():
        figures = []
        for column, limit in limits.items():
            length = F.length(column)
            figures.append(F.struct(
                F.lit(column).alias("column_name"),
                F.lit(limit).alias("declared"),
                F.max(length).alias("longest"),
                count_true(length > limit).alias("too_long"),
            ))
        summary = tables[table].agg(F.array(*figures).alias("figures"))
        parts.append(summary.select(F.lit(table).alias("table_name"), F.inline("figures")))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Tables) -> DataFrame:
    """One (table, rows) line per table; Parquet answers these from its footers."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
