"""Explicit schemas of every layer as (column, type) pairs."""

from __future__ import annotations

Fields = tuple[tuple[str, str], ...]


def ddl(fields: Fields) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


def names(fields: Fields) -> list[str]:
    return [name for name, _ in fields]


def _all(kind: str, *columns: str) -> Fields:
    return tuple((column, kind) for column in columns)


PAYLOAD: Fields = (
    *_all("string", "case_id", "defendant_id", "charge_type", "charge_severity",
          "case_status", "attorney_status"),
    ("defendant_age", "int"),
    *_all("string", "defendant_gender", "income_level"),
    ("defendant_zip_code", "int"),
    *_all("string", "court_district", "assigned_judge", "hearing_type",
          "case_filed_date", "hearing_date", "record_timestamp"),
)
DATE_FIELDS = ("case_filed_date", "hearing_date", "record_timestamp")

# what a hub record looks like before it is stored
HUB_RECORD: Fields = (
    ("value", "binary"), ("timestamp", "timestamp"), ("partition", "int"), ("offset", "bigint"),
)
BRONZE: Fields = (
    ("raw_json", "string"),
    ("eventhub_timestamp", "timestamp"),
    ("eventhub_partition", "int"),
    ("eventhub_offset", "bigint"),
    ("bronze_ingestion_timestamp", "timestamp"),
)
HUB_KEY = ("eventhub_partition", "eventhub_offset")

SILVER: Fields = (
    *((n, "timestamp" if n in DATE_FIELDS else t) for n, t in PAYLOAD),
    *_all("timestamp", "eventhub_timestamp", "bronze_ingestion_timestamp"),
    *_all("int", "days_to_hearing", "case_duration_days"),
    *_all("boolean", "needs_representation", "public_defender_eligible"),
    *_all("string", "defendant_age_group", "court_district_code"),
    ("silver_processed_timestamp", "timestamp"),
    ("data_quality_flag", "string"),
)
# kept through silver so that every row stays identifiable
SILVER_TRACE: Fields = (("eventhub_partition", "int"), ("eventhub_offset", "bigint"))
SILVER_EXTRAS: Fields = _all("boolean", "hearing_is_past", "hearing_was_repaired", "age_is_known")

_VERSION: Fields = (
    *_all("timestamp", "record_effective_date", "record_end_date"),
    ("is_current", "boolean"),
    ("record_version", "int"),
    ("created_timestamp", "timestamp"),
)
DIM_DEFENDANT: Fields = (
    ("defendant_sk", "bigint"), ("defendant_id", "string"), ("defendant_age", "int"),
    *_all("string", "defendant_age_group", "defendant_gender", "income_level"),
    ("defendant_zip_code", "int"), ("attorney_status", "string"),
    ("public_defender_eligible", "boolean"), *_VERSION,
)
DIM_CASE: Fields = (
    ("case_details_sk", "bigint"),
    *_all("string", "case_id", "charge_type", "charge_severity", "case_status", "hearing_type"),
    *_VERSION,
)
DIM_COURT: Fields = (
    ("court_sk", "bigint"),
    *_all("string", "court_district", "court_district_code", "assigned_judge"),
    ("created_timestamp", "timestamp"),
)
FACT: Fields = (
    *_all("bigint", "proceeding_sk", "defendant_sk", "case_details_sk", "court_sk"),
    *_all("string", "case_id", "defendant_id"),
    *_all("timestamp", "case_filed_date", "hearing_date"),
    *_all("int", "days_to_hearing", "case_duration_days"),
    ("needs_representation", "boolean"),
    ("representation_priority_score", "int"),
    ("alert_triggered", "boolean"),
    ("alert_priority", "string"),
    ("intervention_needed", "boolean"),
    ("estimated_case_cost", "decimal(10,2)"),
    ("hearing_urgency_flag", "string"),
    *_all("timestamp", "eventhub_timestamp", "silver_processed_timestamp",
          "gold_processed_timestamp"),
)

DEFENDANT_ATTRIBUTES = names(DIM_DEFENDANT)[1:9]
CASE_ATTRIBUTES = names(DIM_CASE)[1:6]

GOLD: dict[str, Fields] = {
    "dim_defendant": DIM_DEFENDANT,
    "dim_case_details": DIM_CASE,
    "dim_court": DIM_COURT,
    "fact_court_proceedings": FACT,
}
# declared text lengths of the serving tables
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "fact_court_proceedings": {
        "case_id": 50, "defendant_id": 50, "alert_priority": 20, "hearing_urgency_flag": 20,
    },
    "dim_defendant": {
        "defendant_id": 50, "defendant_age_group": 10, "defendant_gender": 10,
        "income_level": 10, "attorney_status": 50,
    },
    "dim_case_details": {
        "case_id": 50, "charge_type": 50, "charge_severity": 20, "case_status": 30,
        "hearing_type": 30,
    },
    "dim_court": {"court_district": 50, "court_district_code": 5, "assigned_judge": 50},
}
SURROGATE_KEYS = {table: fields[0][0] for table, fields in GOLD.items()}
