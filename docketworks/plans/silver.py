"""Bronze to silver: parse, repair, enrich, and the reports over the result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks import vocab
from docketworks.functions import rules
from docketworks.functions.exact import percent
from docketworks.operators.latest import latest_per_key
from docketworks.schemas import (
    DATE_FIELDS, HUB_KEY, PAYLOAD, SILVER, SILVER_EXTRAS, SILVER_TRACE, ddl, names,
)

HUB_COLUMNS = ("eventhub_timestamp", *HUB_KEY, "bronze_ingestion_timestamp")
PAYLOAD_COLUMNS = names(PAYLOAD)


def parse(bronze: DataFrame, added: Sequence[str] = ()) -> DataFrame:
    """The payload as 16 typed columns. Unreadable documents become all-null rows.

    ``added`` names text fields that newer documents have; older ones have null there.
    """
    document = F.from_json("raw_json", ddl((*PAYLOAD, *((name, "string") for name in added))))
    return bronze.withColumn("event", document).select("event.*", *HUB_COLUMNS)


def rejects(bronze: DataFrame) -> DataFrame:
    """Documents that gave no field at all, unchanged, for repair and replay.

    The event is compared as a whole. Testing its fields one by one would parse
    the document once per field, because the filter is evaluated below any alias.
    """
    event = F.from_json("raw_json", ddl(PAYLOAD))
    nothing = F.from_json(F.lit("{}"), ddl(PAYLOAD))
    return bronze.filter(F.coalesce(event, nothing) == nothing)


NUMBERS = tuple(name for name, kind in PAYLOAD if kind == "int")


def drop_copies(bronze: DataFrame) -> DataFrame:
    """One row per hub record. Copies are reduced before the shuffle, however many there are.

    Of copies that differ the one that was ingested first counts, then the earliest and the smallest document.
    Records without a hub position are not told apart by it, so all of them stay.
    """
    first = [c for c in ("bronze_ingestion_timestamp", "eventhub_timestamp", "raw_json") if c in bronze.columns]
    others = [c for c in bronze.columns if c not in {*HUB_KEY, *first}]
    unknown = F.col(HUB_KEY[0]).isNull() | F.col(HUB_KEY[1]).isNull()
    marked = bronze.withColumn("_apart", F.when(unknown, F.monotonically_increasing_id()))
    kept = marked.groupBy(*HUB_KEY, "_apart").agg(F.min(F.struct(*first, *others)).alias("_first"))
    return kept.select(*HUB_KEY, "_first.*").select(*bronze.columns)


def latest_per_case(parsed: DataFrame) -> DataFrame:
    """The newest record of each (case_id, defendant_id), by record time and hub position."""
    return latest_per_key(parsed, ["case_id", "defendant_id"], ["record_timestamp", *HUB_KEY])


def unreadable_fields(bronze: DataFrame) -> DataFrame:
    """Documents that could be read but for some number fields, with the names of these.

    The text of a field is compared with its typed value: a field that is there and has no value
    could not be read. Documents without any readable field are ``rejects``.
    """
    typed = F.from_json("raw_json", ddl(PAYLOAD))
    text = F.from_json("raw_json", ", ".join(f"{name} string" for name in NUMBERS))

    def lost(both: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(both["text"][name].isNotNull() & both["typed"][name].isNull(), F.lit(name)) for name in NUMBERS
        ]))

    # the document is parsed inside a generator, so neither the filter nor a field parses it again
    parsed = F.array(F.struct(typed.alias("typed"), text.alias("text")))
    found = bronze.select("*", F.explode(F.transform(parsed, lost)).alias("unreadable"))
    return found.filter(F.size("unreadable") > 0)


def parse_evolving(bronze: DataFrame, extra: str = "extra_fields") -> DataFrame:
    """Like ``parse``, and fields the schema does not know stay available as a map."""
    everything = F.from_json("raw_json", "map<string,string>")
    unknown = F.map_filter(everything, lambda name, _: ~name.isin(*PAYLOAD_COLUMNS))
    return (
        bronze.withColumns({"event": F.from_json("raw_json", ddl(PAYLOAD)), extra: unknown})
        .select("event.*", *HUB_COLUMNS, extra)
    )


def read_dates(parsed: DataFrame) -> DataFrame:
    """ISO-8601 text to timestamps; what cannot be read becomes null."""
    return parsed.withColumns({name: F.try_to_timestamp(name) for name in DATE_FIELDS})


def clean(
    parsed: DataFrame, as_of: datetime | Column, extras: bool = False, added: Sequence[str] = ()
) -> DataFrame:
    """Repaired and enriched records: the 26 silver columns, partition and offset, then ``added`` ones.

    ``extras`` adds what the fixed rules hide: whether the hearing is past or
    was moved, and whether the age is known.
    """
    now = rules.instant(as_of)
    col = F.col
    marks = {
        "hearing_was_repaired": rules.hearing_lies_ahead(col("hearing_date"), now),
        "age_is_known": col("defendant_age").isNotNull(),
    }
    repairs = {
        "defendant_zip_code": rules.zip_or_marker(col("defendant_zip_code")),
        "hearing_date": rules.repaired_hearing(col("hearing_date"), col("case_filed_date"), now),
    }
    metrics = {
        "days_to_hearing": rules.days_until(col("hearing_date"), now),
        "case_duration_days": -rules.days_until(col("case_filed_date"), now),
        "public_defender_eligible": rules.defender_eligible(col("income_level")),
        "defendant_age_group": rules.age_group(col("defendant_age")),
        "court_district_code": rules.district_code(col("court_district")),
        "silver_processed_timestamp": now,
        "data_quality_flag": rules.quality_flag(col("defendant_zip_code")),
        "hearing_is_past": col("hearing_date") < now,
    }
    flags = {
        "needs_representation": rules.needs_representation(
            col("attorney_status"), col("charge_severity"),
            col("income_level"), col("days_to_hearing"),
        ),
    }
    result = read_dates(parsed).withColumns(marks)
    for level in (repairs, metrics, flags):
        result = result.withColumns(level)
    return result.select(
        *names(SILVER), *names(SILVER_TRACE), *(names(SILVER_EXTRAS) if extras else []), *added
    )


# --- reports: one pass each ----------------------------------------------------

def count_true(condition: Column) -> Column:
    return F.count_if(condition)


def unreadable_summary(bronze: DataFrame) -> DataFrame:
    """Records per field that could not be read."""
    names_lost = unreadable_fields(bronze).select(F.explode("unreadable").alias("field"))
    return names_lost.groupBy("field").agg(F.count(F.lit(1)).alias("records"))


def quality_report(silver: DataFrame) -> DataFrame:
    """One row of quality figures from a single aggregate."""
    needed = count_true(F.col("needs_representation"))
    rows = F.count(F.lit(1))
    return silver.agg(
        rows.alias("total_records"),
        count_true(F.col("case_id").isNull()).alias("null_case_ids"),
        count_true(F.col("defendant_id").isNull()).alias("null_defendant_ids"),
        count_true(F.col("defendant_zip_code") == vocab.MISSING_ZIP).alias("missing_zip_codes"),
        needed.alias("needs_representation_count"),
        percent(needed, rows).alias("needs_representation_pct"),
    )


def sample(silver: DataFrame, rows: int = 10) -> DataFrame:
    """A look at the main columns, by case so that it is repeatable."""
    shown = ["case_id", "attorney_status", "charge_severity", "income_level",
             "days_to_hearing", "needs_representation", "data_quality_flag"]
    return silver.select(*shown).orderBy(*shown[:3]).limit(rows)


def attorney_status_summary(silver: DataFrame) -> DataFrame:
    keys = ["attorney_status", "needs_representation"]
    counts = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("cases"))
    return counts.orderBy(F.desc("cases"), *keys)


def district_summary(silver: DataFrame) -> DataFrame:
    """Cases and representation gap per district, largest gap first."""
    rows, gap = F.count(F.lit(1)), count_true(F.col("needs_representation"))
    return (
        silver.groupBy("court_district_code")
        .agg(
            rows.alias("total_cases"),
            gap.alias("needs_representation_count"),
            percent(gap, rows).alias("representation_gap_rate"),
        )
        .orderBy(F.desc("needs_representation_count"), "court_district_code")
    )


def age_group_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("defendant_age_group").agg(F.count(F.lit(1)).alias("cases"))


def date_quality(parsed: DataFrame, as_of: datetime) -> DataFrame:
    """Counts per date problem: unreadable, hearing before filing, hearing after ``as_of``."""
    now = rules.instant(as_of)
    read = parsed.withColumns({f"_{name}": F.try_to_timestamp(name) for name in DATE_FIELDS})

    def unreadable(name: str) -> Column:
        return F.col(name).isNotNull() & F.col(f"_{name}").isNull()

    issue = (
        F.when(unreadable("hearing_date"), "UNREADABLE_HEARING_DATE")
        .when(unreadable("case_filed_date"), "UNREADABLE_FILED_DATE")
        .when(F.col("_hearing_date").isNull() | F.col("_case_filed_date").isNull(), "MISSING_DATE")
        .when(F.col("_hearing_date") < F.col("_case_filed_date"), "HEARING_BEFORE_FILING")
        .when(F.col("_hearing_date") > now, "HEARING_IN_FUTURE")
        .otherwise("CONSISTENT")
    )
    return read.groupBy(issue.alias("date_issue")).agg(F.count(F.lit(1)).alias("records"))
