"""Every query by name, over a directory of source tables.

Results are shown in engine-neutral types: times as text, decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.functions.hashing import key_hash
from docketworks.functions.rules import instant
from docketworks.operators import scd2
from docketworks.operators.asof import as_of_join
from docketworks.operators.dense_keys import add_dense_key
from docketworks.operators.latest import latest_per_key
from docketworks.operators.overlap import overlap_join
from docketworks.plans import conformity, dashboards, serving, silver, upkeep, waiting
from docketworks.plans.star import StarBuilder
from docketworks.schemas import (
    BRONZE, GOLD, PAYLOAD, SILVER, SILVER_TRACE, SURROGATE_KEYS, ddl, names,
)
from docketworks.sources import feed
from docketworks.sources.hub import read_hub, to_bronze
from docketworks.sources.snapshots import SnapshotStore
from docketworks.sources.tables import create_external_tables, create_views, preview
from docketworks.streaming import alerts, answers, dedupe, exactly_once, ingest
from docketworks.workspace import Workspace, open_workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STREAM_DELAY = "2 days"
REPEAT_DELAY = "120 days"


def neutral(frame: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles."""
    changed = {}
    for field in frame.schema.fields:
        kind = field.dataType.typeName()
        if kind.startswith("timestamp"):
            changed[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            changed[field.name] = F.col(field.name).cast("double")
    return frame.withColumns(changed) if changed else frame


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return neutral(build(open_workspace(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# --- feed and silver -----------------------------------------------------------

@query
def feed_envelope(w: Workspace) -> DataFrame:
    return w.payload().select(*names(PAYLOAD))


@query
def silver_parse(w: Workspace) -> DataFrame:
    return w.parsed().drop("bronze_ingestion_timestamp")


@query
def silver_clean(w: Workspace) -> DataFrame:
    return w.clean()


@query
def silver_deduped(w: Workspace) -> DataFrame:
    """Silver of a feed in which every fifth record came twice."""
    payload = w.payload()
    again = payload.filter(key_hash(F.col("feed_key"), "dup") % 5 == 0)
    copies = w.bronze_of(payload.unionByName(again))
    return silver.clean(silver.parse(silver.drop_copies(copies)), w.as_of)


@query
def silver_without_position(w: Workspace) -> DataFrame:
    """The same feed, every fiftieth record without its hub position: such records all stay."""
    payload = w.payload()
    again = payload.filter(key_hash(F.col("feed_key"), "dup") % 5 == 0)
    copies = w.bronze_of(payload.unionByName(again))
    place = F.col("eventhub_offset") * feed.HUB_PARTITIONS + F.col("eventhub_partition")
    known = key_hash(place, "lost") % 50 != 0
    lost = copies.withColumn("_known", known).withColumns({
        c: F.when(F.col("_known"), F.col(c)) for c in ("eventhub_partition", "eventhub_offset")
    }).drop("_known")
    return silver.clean(silver.parse(silver.drop_copies(lost)), w.as_of).select(
        "case_id", "eventhub_partition", "eventhub_offset", "needs_representation"
    )


@query
def unreadable_fields(w: Workspace) -> DataFrame:
    """Number fields that could not be read, among good and broken documents."""
    broken = w.table("documents").select(
        F.col("text").alias("raw_json"), F.lit(None).cast("timestamp").alias("eventhub_timestamp"),
        F.lit(0).alias("eventhub_partition"), F.col("doc_id").alias("eventhub_offset"),
        instant(w.as_of).alias("bronze_ingestion_timestamp"),
    )
    return silver.unreadable_summary(feed.spoil_numbers(w.bronze()).unionByName(broken))


@query
def silver_extras(w: Workspace) -> DataFrame:
    return w.clean(extras=True).select(
        "case_id", "hearing_is_past", "hearing_was_repaired", "age_is_known"
    )


@query
def silver_sample(w: Workspace) -> DataFrame:
    return silver.sample(w.silver)


@query
def silver_rejects(w: Workspace) -> DataFrame:
    """The documents table as raw input: none of its texts is an event."""
    raw = w.table("documents").select(
        F.col("text").alias("raw_json"), F.lit(None).cast("timestamp").alias("eventhub_timestamp"),
        F.lit(0).alias("eventhub_partition"), F.col("doc_id").alias("eventhub_offset"),
        instant(w.as_of).alias("bronze_ingestion_timestamp"),
    )
    mixed = raw.unionByName(w.bronze())
    return silver.rejects(mixed).select("eventhub_offset", "raw_json")


@query
def needs_representation(w: Workspace) -> DataFrame:
    return w.silver.select("case_id", "defendant_id", "needs_representation")


@query
def age_group_counts(w: Workspace) -> DataFrame:
    return silver.age_group_counts(w.silver)


@query
def silver_quality(w: Workspace) -> DataFrame:
    return silver.quality_report(w.silver)


@query
def attorney_status_summary(w: Workspace) -> DataFrame:
    return silver.attorney_status_summary(w.silver)


@query
def district_summary(w: Workspace) -> DataFrame:
    """From the raw events in one plan, without the stored layers."""
    return silver.district_summary(w.clean())


@query
def date_quality(w: Workspace) -> DataFrame:
    spoiled = w.bronze_of(feed.spoil_dates(w.payload()))
    return silver.date_quality(silver.parse(spoiled), w.as_of)


@query
def schema_evolution(w: Workspace) -> DataFrame:
    """Old documents and newer ones with one more field, stored side by side and read as one."""
    key = F.col("feed_key")
    newer = key_hash(key, "v2") % 2 == 1
    room = F.format_string("R%02d", key_hash(key, "room") % 30)
    payload = w.payload().withColumn("court_room", F.when(newer, room))
    document = F.to_json(F.struct(*names(PAYLOAD), "court_room"))
    records = payload.select(
        document.alias("raw_json"), F.lit(None).cast("timestamp").alias("eventhub_timestamp"),
        F.lit(0).alias("eventhub_partition"), key.alias("eventhub_offset"),
        instant(w.as_of).alias("bronze_ingestion_timestamp"),
    )
    parsed = silver.parse_evolving(records)
    found = w.scratch.stage(
        parsed.select("case_id", F.col("extra_fields")["court_room"].alias("court_room")), "parsed"
    )
    place = w.scratch.path("evolving")
    found.filter("court_room IS NULL").drop("court_room").write.parquet(f"{place}/version=1")
    found.filter("court_room IS NOT NULL").write.parquet(f"{place}/version=2")
    return w.spark.read.option("mergeSchema", "true").parquet(place).select(
        "case_id", "court_room", F.col("version").cast("int").alias("version")
    )


@query
def silver_evolving(w: Workspace) -> DataFrame:
    """Silver in two loads, the documents of the second with one more field, read as one table."""
    key = F.col("feed_key")
    newer = key_hash(key, "v2") % 2 == 1
    payload = w.payload().withColumn("court_room", F.format_string("R%02d", key_hash(key, "room") % 30))
    store = SnapshotStore(w.spark, w.scratch.path("evolving-silver"))
    before = None
    for rows, added in ((payload.filter(~newer), ()), (payload.filter(newer), ("court_room",))):
        records = to_bronze(feed.hub_records(rows, added=added), instant(w.as_of))
        snapshot = store.new_snapshot()
        store.write(snapshot, "silver", silver.clean(silver.parse(records, added), w.as_of, added=added))
        store.commit(snapshot, added_to=before)
        before = snapshot
    return store.read_evolving("silver", (*SILVER, *SILVER_TRACE)).select(
        "case_id", "eventhub_offset", "days_to_hearing", "needs_representation", "court_room"
    )


# --- star schema -----------------------------------------------------------------

@query
def dim_defendant(w: Workspace) -> DataFrame:
    return w.builder().dimension("dim_defendant")


@query
def dim_case_details(w: Workspace) -> DataFrame:
    return w.builder().dimension("dim_case_details")


@query
def dim_court(w: Workspace) -> DataFrame:
    return w.builder().dimension("dim_court")


@query
def fact_keys_literal(w: Workspace) -> DataFrame:
    return w.builder().natural_key_rows(w.star).select(
        "defendant_sk", "case_details_sk", "court_sk", "case_id", "defendant_id"
    )


@query
def fact(w: Workspace) -> DataFrame:
    return w.builder().fact(w.star)


@query
def star_increment(w: Workspace) -> DataFrame:
    """Two loads of the star schema and the second once more.

    The second must not change a key of the first, and its repetition nothing at all.
    """
    cut = instant(w.as_of - timedelta(days=45))
    store = SnapshotStore(w.spark, w.scratch.path("increments"))

    def load(condition) -> StarBuilder:
        return StarBuilder(w.silver.filter(condition), w.as_of, w.scratch, w.rows, w.sizing)

    load(F.col("record_timestamp") < cut).publish(store)
    load(F.col("record_timestamp") >= cut).append(store)
    tables = load(F.col("record_timestamp") >= cut).append(store)
    return tables[serving.FACT_TABLE].select(
        "proceeding_sk", "defendant_sk", "case_details_sk", "court_sk", "case_id"
    )


@query
def versioned_dimension(w: Workspace) -> DataFrame:
    """All versions of the defendants after loads in no order of time."""
    return w.versioned.tables()["dim_defendant"].select(
        "defendant_id", "attorney_status", "defendant_zip_code", *_VERSION_COLUMNS
    )


@query
def versioned_gold(w: Workspace) -> DataFrame:
    """Each proceeding with the versions of its defendant and case that its keys point to."""
    tables = w.versioned.tables()
    defendants = tables["dim_defendant"].select(
        "defendant_sk", "attorney_status", "defendant_zip_code", *_VERSION_COLUMNS
    )
    cases = tables["dim_case_details"].select("case_details_sk", F.col(scd2.VERSION).alias("case_version"))
    rows = tables[serving.FACT_TABLE].select("case_id", "defendant_id", "defendant_sk", "case_details_sk")
    return rows.join(defendants, "defendant_sk").join(cases, "case_details_sk").drop("defendant_sk", "case_details_sk")


def _upkept(name: str) -> None:
    def report(w: Workspace) -> DataFrame:
        return w.versioned.reports()[name]

    report.__name__ = name
    query(report)


for _report in upkeep.REPORTS:
    _upkept(_report)


@query
def priority_scores(w: Workspace) -> DataFrame:
    return w.fact.select(
        "proceeding_sk", "case_id", "needs_representation", "representation_priority_score",
        "alert_triggered", "alert_priority", "intervention_needed",
    )


@query
def alert_distribution(w: Workspace) -> DataFrame:
    return serving.alert_distribution(w.fact)


@query
def urgency_counts(w: Workspace) -> DataFrame:
    return serving.urgency_counts(w.fact)


@query
def case_costs(w: Workspace) -> DataFrame:
    return w.fact.select("case_id", "needs_representation", "estimated_case_cost")


@query
def gold_summary(w: Workspace) -> DataFrame:
    return serving.gold_summary(w.fact)


@query
def row_counts(w: Workspace) -> DataFrame:
    return serving.row_counts(w.star)


# --- serving ---------------------------------------------------------------------

def _served(w: Workspace) -> dict[str, DataFrame]:
    """The published snapshot through external tables."""
    w.star  # published on first use
    snapshot = w.store.latest()
    declared = create_external_tables(
        w.spark, lambda table: w.store.locations(snapshot, table), prefix="served_"
    )
    return {table: w.spark.table(name) for table, name in declared.items()}


def _preview_of(table: str) -> None:
    def show(w: Workspace) -> DataFrame:
        return preview(_served(w)[table], SURROGATE_KEYS[table])

    show.__name__ = f"serve_{table}"
    query(show)


for _table in GOLD:
    _preview_of(_table)


@query
def serve_tables(w: Workspace) -> DataFrame:
    return serving.row_counts(_served(w))


@query
def text_lengths(w: Workspace) -> DataFrame:
    return serving.text_lengths(w.star)


@query
def analytics_view(w: Workspace) -> DataFrame:
    name = "vw_court_proceedings_analytics"
    create_views({name: serving.analytics_view(w.star)})
    return w.spark.table(name)


@query
def gap_summary(w: Workspace) -> DataFrame:
    name = "vw_representation_gap_summary"
    create_views({name: serving.gap_summary(w.star)})
    return w.spark.table(name)


@query
def top_cases(w: Workspace) -> DataFrame:
    return serving.top_cases(w.star)


@query
def validation_stats(w: Workspace) -> DataFrame:
    return serving.validation_stats(w.star)


# --- history -----------------------------------------------------------------------

@query
def dedupe_latest(w: Workspace) -> DataFrame:
    """The line items repeat their key; the latest shipment of each is kept."""
    lines = w.table("lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _attorney_events(w: Workspace) -> DataFrame:
    return w.silver.select(
        "defendant_id", "attorney_status", "record_timestamp", "case_id", "eventhub_partition",
        "eventhub_offset",
    )


TIES = ["eventhub_offset", "eventhub_partition"]


def _history(w: Workspace, events: DataFrame) -> DataFrame:
    return scd2.history(
        events, ["defendant_id"], ["attorney_status"], "record_timestamp", TIES,
        w.scratch, w.rows, w.sizing,
    )


@query
def scd2_history(w: Workspace) -> DataFrame:
    return _history(w, _attorney_events(w))


@query
def scd2_merge(w: Workspace) -> DataFrame:
    """Two loads: what was filed until 45 days before ``as_of``, then the rest."""
    cut = instant(w.as_of - timedelta(days=45))
    events = _attorney_events(w)
    first = _history(w, events.filter(F.col("record_timestamp") < cut))
    stored = w.scratch.stage(
        add_dense_key(first, "defendant_sk", ["defendant_id", scd2.VERSION], w.scratch,
                      w.rows, sizing=w.sizing),
        "stored-dimension",
    )
    return scd2.merge(
        stored, events.filter(F.col("record_timestamp") >= cut), "defendant_sk",
        ["defendant_id"], ["attorney_status"], "record_timestamp", TIES,
        w.scratch, 2 * w.rows, w.sizing,
    )


@query
def scd2_merge_late(w: Workspace) -> DataFrame:
    """Three loads in no order of time, the second one delivered twice."""
    events = w.scratch.stage(
        _attorney_events(w).withColumn("_load", key_hash(F.col("case_id"), "load") % 3), "shuffled-events"
    )
    parts = [events.filter(F.col("_load") == n).drop("_load") for n in range(3)]
    first = scd2.history(
        parts[0], ["defendant_id"], ["attorney_status"], "record_timestamp", TIES, w.scratch,
        w.rows, w.sizing, with_ties=True,
    )
    stored = w.scratch.stage(
        add_dense_key(first, "defendant_sk", ["defendant_id", scd2.VERSION], w.scratch, w.rows,
                      sizing=w.sizing), "first-load",
    )
    log = parts[0]
    for batch in (parts[1], parts[2], parts[1]):
        stored = w.scratch.stage(scd2.merge_log(
            stored, log, batch, "defendant_sk", ["defendant_id"], ["attorney_status"],
            "record_timestamp", TIES, w.scratch, 3 * w.rows, w.sizing,
        ), "merged-load")
        log = log.unionByName(batch)
    return stored.drop("defendant_sk", *TIES)


@query
def case_history(w: Workspace) -> DataFrame:
    """Each proceeding with the attorney version in force when it was recorded."""
    events = w.silver.select(
        "case_id", "defendant_id", "record_timestamp", "eventhub_partition", "eventhub_offset"
    )
    versions = scd2_history(w)
    joined = as_of_join(
        events, versions, ["defendant_id"], "record_timestamp", scd2.EFFECTIVE,
        [scd2.VERSION], TIES, ["attorney_status", *_VERSION_COLUMNS], w.scratch,
        2 * w.rows, w.sizing,
    )
    return joined.drop(*TIES)


@query
def case_history_full(w: Workspace) -> DataFrame:
    """Each proceeding with every attorney version in force between its filing and its hearing."""
    cases = w.silver.select("case_id", "defendant_id", "case_filed_date", "hearing_date")
    found = overlap_join(
        cases, scd2_history(w), ["defendant_id"], ("case_filed_date", "hearing_date"),
        (scd2.EFFECTIVE, scd2.END), w.scratch,
    )
    return found.select("left.*", *[f"right.{c}" for c in ("attorney_status", *_VERSION_COLUMNS)])


_VERSION_COLUMNS = [scd2.EFFECTIVE, scd2.END, scd2.CURRENT, scd2.VERSION]


@query
def status_changes(w: Workspace) -> DataFrame:
    return dashboards.status_changes(w.silver, ["defendant_id"], w.scratch, w.rows, w.sizing)


# --- dashboards ----------------------------------------------------------------------

@query
def work_queue(w: Workspace) -> DataFrame:
    return dashboards.work_queue(w.view())


@query
def weekly_trend(w: Workspace) -> DataFrame:
    return dashboards.weekly_trend(w.fact)


@query
def demographics(w: Workspace) -> DataFrame:
    return dashboards.demographics(w.view())


@query
def geo_rollup(w: Workspace) -> DataFrame:
    return dashboards.geo_rollup(w.view())


@query
def budget_by_month(w: Workspace) -> DataFrame:
    return dashboards.budget_by_month(w.view())


@query
def executive_kpis(w: Workspace) -> DataFrame:
    return dashboards.executive_kpis(w.view())


@query
def weighted_score(w: Workspace) -> DataFrame:
    return dashboards.weighted_scores(w.view())


# --- waiting, capacity, conformity ---------------------------------------------------

def _cases(w: Workspace) -> DataFrame:
    feed_key = F.col("eventhub_offset") * feed.HUB_PARTITIONS + F.col("eventhub_partition")
    return w.silver.select(feed_key.alias("feed_key"), "case_id", "court_district_code", "case_filed_date")


def _updates(w: Workspace) -> DataFrame:
    return feed.case_updates(_cases(w), w.table("lineitem"), w.as_of)


@query
def case_status_changes(w: Workspace) -> DataFrame:
    return waiting.case_status_changes(_updates(w), w.scratch, sizing=w.sizing)


@query
def assignment_waits(w: Workspace) -> DataFrame:
    """Share of cases per district that wait longer than each number of days for a lawyer."""
    return waiting.still_waiting(waiting.time_to_lawyer(_cases(w), _updates(w), w.as_of))


@query
def capacity_cuts(w: Workspace) -> DataFrame:
    return waiting.capacity_cuts(w.view(), w.scratch, w.rows, w.sizing)


@query
def change_points(w: Workspace) -> DataFrame:
    """Where filings rose, with most of the early ones of one district left out."""
    early = (F.col("case_filed_date") < F.lit("2024-04-15").cast("timestamp")) & (
        F.col("court_district_code") == "BX") & (key_hash(F.col("case_id"), "shift") % 10 < 6)
    return waiting.change_points(w.view().filter(~early))


@query
def dependency_errors(w: Workspace) -> DataFrame:
    """Dependencies in the records, one case in 25 of which also came under another district."""
    moved = w.silver.filter(key_hash(F.col("case_id"), "moved") % 25 == 0).withColumn(
        "court_district", F.lit("Bronx Criminal Court"))
    return conformity.dependency_errors(w.silver.unionByName(moved))


@query
def schema_drift(w: Workspace) -> DataFrame:
    """Types of the fields per day, of documents some numbers of which became text."""
    return conformity.schema_drift(feed.spoil_numbers(w.bronze())).withColumn("day", F.col("day").cast("string"))


# --- streams -------------------------------------------------------------------------

def _run(w: Workspace, stream: DataFrame, label: str, schema) -> DataFrame:
    """Process everything that has landed, then read the appended files."""
    target, checkpoint = w.scratch.path(label), w.scratch.path(f"{label}-checkpoint")
    width = w.sizing.partitions(w.rows)
    ingest.wait(ingest.append_stream(stream, target, checkpoint, every=None, partitions=width))
    return w.spark.read.schema(schema).parquet(target)


def _landed(w: Workspace, folder: str) -> DataFrame:
    return read_hub(w.spark, "parquet", path=folder)


@query
def bronze_ingest(w: Workspace) -> DataFrame:
    target, checkpoint = w.scratch.path("bronze"), w.scratch.path("bronze-checkpoint")
    ingest.wait(ingest.start_ingest(_landed(w, w.landing), target, checkpoint, every=None))
    stored = w.spark.read.schema(ddl(BRONZE)).parquet(target)
    return stored.select(
        "eventhub_partition", "eventhub_offset", "eventhub_timestamp",
        F.get_json_object("raw_json", "$.case_id").alias("case_id"),
        F.get_json_object("raw_json", "$.hearing_date").alias("hearing_date"),
    )


@query
def stream_dedupe(w: Workspace) -> DataFrame:
    bronze = ingest.to_bronze(_landed(w, w.landing_with_copies), instant(w.as_of))
    single = dedupe.drop_repeats(
        bronze, ["eventhub_partition", "eventhub_offset"], "eventhub_timestamp", REPEAT_DELAY
    )
    stored = _run(w, single, "deduped", ddl(BRONZE))
    return stored.select(
        "eventhub_partition", "eventhub_offset", "eventhub_timestamp",
        F.get_json_object("raw_json", "$.case_id").alias("case_id"),
    )


@query
def stream_alert_feed(w: Workspace) -> DataFrame:
    """Every alert as its own row, for immediate notification."""
    bronze = ingest.to_bronze(_landed(w, w.landing), instant(w.as_of))
    feed_of_alerts = alerts.alert_stream(alerts.scored_stream(bronze, STREAM_DELAY, w.as_of))
    return _run(w, feed_of_alerts, "alerts", feed_of_alerts.schema)


@query
def stream_alerts(w: Workspace) -> DataFrame:
    bronze = ingest.to_bronze(_landed(w, w.landing), instant(w.as_of))
    counts = alerts.alert_counts(alerts.scored_stream(bronze, STREAM_DELAY, w.as_of))
    return _run(w, counts, "alert-counts", counts.schema)


@query
def stream_unanswered(w: Workspace) -> DataFrame:
    """Alerts after which the defendant had no lawyer within 48 hours."""
    bronze = ingest.to_bronze(_landed(w, w.landing), instant(w.as_of))
    open_alerts = answers.unanswered(bronze, STREAM_DELAY, w.as_of)
    return _run(w, open_alerts, "unanswered", open_alerts.schema)


@query
def stream_episodes(w: Workspace) -> DataFrame:
    """Runs of alerts of one defendant with less than a week in between."""
    bronze = ingest.to_bronze(_landed(w, w.landing), instant(w.as_of))
    runs = answers.episodes(bronze, STREAM_DELAY, w.as_of)
    return _run(w, runs, "episodes", runs.schema)


@query
def stream_once(w: Workspace) -> DataFrame:
    """The landed records with copies, streamed twice from the start into one sink."""
    target = w.scratch.path("once")
    for turn in range(2):
        bronze = ingest.to_bronze(_landed(w, w.landing_with_copies), instant(w.as_of))
        checkpoint = w.scratch.path(f"once-checkpoint-{turn}")
        ingest.wait(exactly_once.start_once(bronze, target, checkpoint, every=None))
    return exactly_once.OnceSink(w.spark, target, "").read().select(
        "eventhub_partition", "eventhub_offset", "eventhub_timestamp",
        F.get_json_object("raw_json", "$.case_id").alias("case_id"),
    )
