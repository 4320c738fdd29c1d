"""Court events derived from the order tables, in the shape a hub delivers them.

Every choice is a hash of the order or customer key, so a feed is repeatable and
grows with its tables. Dirt is part of it: 3 % of the zip codes are missing and
2 % of the hearings lie far in the future.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks import vocab
from docketworks.functions.hashing import key_hash, pick
from docketworks.functions.rules import instant
from docketworks.schemas import DATE_FIELDS, PAYLOAD, names

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss"
HUB_PARTITIONS = 8
DAY = 86_400


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _defendants(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """One row per customer; what depends on the customer alone is computed before the big join."""
    key = F.col("c_custkey")
    balance = F.col("c_acctbal")
    region = F.col("n_regionkey")
    low, medium, high = vocab.INCOME_LEVELS
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        key,
        F.format_string("DEF-%09d", key).alias("defendant_id"),
        F.when(key_hash(key, "agenull") % 101 != 0, (key_hash(key, "age") % 62 + 16).cast("int"))
        .alias("defendant_age"),
        pick(vocab.GENDERS, key_hash(key, "gen") % 3).alias("defendant_gender"),
        F.when(balance < 2500, low).when(balance < 6500, medium).otherwise(high)
        .alias("income_level"),
        pick(vocab.ZIP_CODES, key_hash(key, "zip") % 12).alias("home_zip"),
        pick(vocab.DISTRICTS, region).alias("court_district"),
        pick(tuple(vocab.BOROUGH_CODES.values()), region).alias("district_code"),
        F.col("n_name").alias("assigned_judge"),
    )


def court_events(
    orders: DataFrame, customers: DataFrame, nations: DataFrame, as_of: datetime
) -> DataFrame:
    """One event per order: the 16 payload columns with typed dates, plus ``feed_key``."""
    people = _defendants(customers, nations)
    key = F.col("o_orderkey")
    now = F.unix_timestamp(instant(as_of))
    violation, misdemeanor, felony = vocab.SEVERITIES

    filed = now - (key_hash(key, "filed") % 90 + 1) * DAY + key_hash(key, "sec") % DAY
    far_ahead = now + (key_hash(key, "futd") % 61 + 60) * DAY
    planned = F.col("filed") + (key_hash(key, "hear") % 39 + 7) * DAY
    hearing = F.when(key_hash(key, "fut") % 100 < 2, far_ahead).otherwise(planned)

    events = orders.withColumn("filed", filed).join(
        people, orders.o_custkey == people.c_custkey
    )
    return events.select(
        F.format_string("2024-%s-%09d", F.col("district_code"), key).alias("case_id"),
        "defendant_id",
        pick(vocab.CHARGE_TYPES, key_hash(key, "chg") % 8).alias("charge_type"),
        F.when(F.col("o_orderpriority") == "1-URGENT", felony)
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), misdemeanor)
        .otherwise(violation).alias("charge_severity"),
        pick(vocab.CASE_STATUSES, key_hash(key, "cst") % 4).alias("case_status"),
        pick(vocab.ATTORNEY_STATUSES, key_hash(key, "att") % 5).alias("attorney_status"),
        "defendant_age",
        "defendant_gender",
        "income_level",
        F.when(key_hash(key, "zipnull") % 100 >= 3, F.col("home_zip")).alias("defendant_zip_code"),
        "court_district",
        "assigned_judge",
        pick(vocab.HEARING_TYPES, key_hash(key, "hty") % 5).alias("hearing_type"),
        F.timestamp_seconds("filed").alias("case_filed_date"),
        F.timestamp_seconds(hearing).alias("hearing_date"),
        F.timestamp_seconds("filed").alias("record_timestamp"),
        key.alias("feed_key"),
    )


def as_payload(events: DataFrame) -> DataFrame:
    """Dates become text, as they are in the JSON document."""
    return events.withColumns({name: F.date_format(name, JSON_TIME) for name in DATE_FIELDS})


def case_updates(cases: DataFrame, lines: DataFrame, as_of: datetime) -> DataFrame:
    """Later records of ``cases`` (feed_key, case_id, case_filed_date), one per line of their order.

    Each tells the attorney status that was found then. Updates after ``as_of`` have not come yet;
    ``update_key`` is unique up to equal lines.
    """
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    later = lines.select(F.col("l_orderkey").alias("feed_key"), line.alias("update_key")).distinct()
    seconds = key_hash(F.col("update_key"), "later") % (60 * DAY)
    changed = later.join(cases.select("feed_key", "case_id", "case_filed_date"), "feed_key")
    return changed.select(
        "case_id", F.timestamp_seconds(F.unix_timestamp("case_filed_date") + seconds).alias("updated_at"),
        pick(vocab.ATTORNEY_STATUSES, key_hash(F.col("update_key"), "status") % 5).alias("attorney_status"),
        "update_key",
    ).filter(F.col("updated_at") <= instant(as_of))


def spoil_dates(payload: DataFrame) -> DataFrame:
    """Make some dates unusable: 1 in 50 hearings unreadable, 1 in 40 before the filing."""
    key = F.col("feed_key")
    hearing = F.col("hearing_date")
    return payload.withColumn(
        "hearing_date",
        F.when(key_hash(key, "baddate") % 50 == 0, F.concat(F.lit("??"), hearing))
        .when(key_hash(key, "early") % 40 == 0, F.lit("2020-01-01T00:00:00"))
        .otherwise(hearing),
    )


def spoil_numbers(bronze: DataFrame) -> DataFrame:
    """Make some numbers unreadable in the documents: 1 in 30 ages, 1 in 40 zip codes."""
    key = F.col("eventhub_offset") * HUB_PARTITIONS + F.col("eventhub_partition")
    document = F.col("raw_json")
    for field, tag, every in (("defendant_age", "badage", 30), ("defendant_zip_code", "badzip", 40)):
        changed = F.regexp_replace(document, f'"{field}":[0-9]+', f'"{field}":"n/a"')
        document = F.when(key_hash(key, tag) % every == 0, changed).otherwise(document)
    return bronze.withColumn("raw_json", document)


def hub_records(
    payload: DataFrame, hub_time: str = "record_timestamp", added: Sequence[str] = ()
) -> DataFrame:
    """The payload and ``added`` fields as hub records: JSON bytes, enqueue time, partition and offset.

    Null fields are left out of the document. Partition and offset are
    arithmetic on the unique feed key, so no task has to count rows.
    """
    key = F.col("feed_key")
    document = F.to_json(F.struct(*names(PAYLOAD), *added))
    return payload.select(
        F.encode(document, "UTF-8").alias("value"),
        F.to_timestamp(hub_time, JSON_TIME).alias("timestamp"),
        F.pmod(key, F.lit(HUB_PARTITIONS)).cast("int").alias("partition"),
        F.call_function("div", key, F.lit(HUB_PARTITIONS)).alias("offset"),
    )
