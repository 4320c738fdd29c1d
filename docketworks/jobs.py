"""Command line of the jobs, for spark-submit.

    python -m docketworks.jobs feed    --tables DIR --landing DIR
    python -m docketworks.jobs ingest  --bronze DIR --checkpoint DIR --option key=value ...
    python -m docketworks.jobs alerts  --bronze DIR --target DIR --checkpoint DIR
    python -m docketworks.jobs dedupe  --bronze DIR --target DIR --checkpoint DIR
    python -m docketworks.jobs compact --bronze DIR --target DIR
    python -m docketworks.jobs silver  --bronze DIR --silver DIR
    python -m docketworks.jobs gold    --silver DIR --gold DIR [--incremental | --versions]
    python -m docketworks.jobs serve   --gold DIR --report NAME --output DIR

Reports are written below ``--output`` with all their rows; without it the first ones are
printed beside the number of all rows. Connections and credentials come as options of the deployment.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from docketworks.plans import dashboards, serving, silver
from docketworks.plans.star import StarBuilder, read_star
from docketworks.plans.versioned import VersionedStar
from docketworks.schemas import BRONZE, HUB_KEY, SILVER, SILVER_TRACE, ddl
from docketworks.session import build_session, prepare
from docketworks.sources import feed, hub
from docketworks.sources.scratch import Scratch
from docketworks.sources.snapshots import SnapshotStore
from docketworks.streaming import alerts, answers, dedupe, exactly_once, ingest
from docketworks.streaming.late import LateRows

STORED_SILVER = (*SILVER, *SILVER_TRACE)
SILVER_TABLE = "court_proceedings"


def options_of(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def run_feed(spark: SparkSession, args: argparse.Namespace) -> None:
    """Court events from the order tables, as hub records in files."""
    tables = [feed.read_table(spark, args.tables, name) for name in ("orders", "customer", "nation")]
    events = feed.court_events(*tables, args.as_of)
    feed.hub_records(feed.as_payload(events)).write.mode("append").parquet(args.landing)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    given = options_of(args.option)
    if args.source == "kafka":
        given = {**hub.KAFKA_DEFAULTS, **given}
    records = hub.read_hub(spark, args.source, **given)
    if args.monitor:
        ingest.start_monitor(records, args.every)
    every = None if args.once else args.every
    ingest.wait(
        ingest.start_ingest(records, args.bronze, args.checkpoint, every, args.format), args.seconds
    )


def _bronze_stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    reader = spark.readStream.format(args.format).schema(ddl(BRONZE))
    if args.files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", args.files_per_trigger)
    return reader.load(args.bronze)


def _append(stream: DataFrame, args: argparse.Namespace) -> None:
    with LateRows(stream.sparkSession) as late:
        query = ingest.append_stream(
            stream, args.target, args.checkpoint, None if args.once else args.every, args.format
        )
        ingest.wait(query, args.seconds)
        late.wait_for(query)
    print(f"rows dropped as late: {late.total}")


def run_alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    """Alerts from the bronze files as they arrive.

    ``--counts`` adds them up per window, ``--unanswered`` tells those without a lawyer in time and
    ``--episodes`` joins those of a defendant that follow each other.
    """
    bronze = _bronze_stream(spark, args)
    if args.unanswered:
        return _append(answers.unanswered(bronze, args.delay), args)
    if args.episodes:
        return _append(answers.episodes(bronze, args.delay), args)
    scored = alerts.scored_stream(bronze, args.delay)
    _append(alerts.alert_counts(scored) if args.counts else alerts.alert_stream(scored), args)


def run_dedupe(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bronze without repeated hub records, as a stream.

    ``--forever`` compares with all that is stored instead of a state that ``--delay`` bounds.
    """
    stream = _bronze_stream(spark, args)
    if args.forever:
        every = None if args.once else args.every
        query = exactly_once.start_once(stream, args.target, args.checkpoint, every, args.format)
        ingest.wait(query, args.seconds)
        return
    _append(dedupe.drop_repeats(stream, HUB_KEY, alerts.EVENT_TIME, args.delay), args)


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Many small bronze files into few large ones, in a new folder; the old one stays as it is."""
    bronze = spark.read.format(args.format).schema(ddl(BRONZE)).load(args.bronze)
    # a rebalance cuts and joins partitions by their size
    bronze.hint("rebalance").write.format(args.format).mode("errorifexists").save(args.target)


def run_silver(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Rebuild silver; the reports read the stored result, so they agree with it.

    A hub record that was delivered twice counts once; ``--latest`` keeps the newest record of
    each case and defendant only.
    """
    bronze = spark.read.format(args.format).schema(ddl(BRONZE)).load(args.bronze)
    prepare(spark, bronze.count())
    bronze = silver.drop_copies(bronze)
    parsed = silver.parse(bronze, args.added_field)
    if args.latest:
        parsed = silver.latest_per_case(parsed)
    store = SnapshotStore(spark, args.silver, args.format)
    snapshot = store.publish({SILVER_TABLE: silver.clean(parsed, args.as_of, added=args.added_field)})
    stored = store.read(SILVER_TABLE, STORED_SILVER, snapshot)
    prepare(spark, stored.count())
    return {
        "date_quality": silver.date_quality(parsed, args.as_of),
        "unreadable": silver.unreadable_summary(bronze),
        "rejects": silver.rejects(bronze),
        "quality": silver.quality_report(stored),
        "sample": silver.sample(stored),
        "attorney_status": silver.attorney_status_summary(stored),
        "districts": silver.district_summary(stored),
    }


def run_gold(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Rebuild gold; ``--incremental`` adds what silver has gained since the last load.

    ``--versions`` keeps one chain of versions per defendant and case instead of attribute sets. It always
    adds, and keeps its reports up to date.
    """
    stored = SnapshotStore(spark, args.silver, args.format).read(SILVER_TABLE, STORED_SILVER)
    rows = stored.count()
    prepare(spark, rows)
    scratch = Scratch(spark)
    store = SnapshotStore(spark, args.gold, args.format)
    reports = {}
    try:
        if args.versions:
            star = VersionedStar(store, args.as_of, scratch, rows)
            tables = star.load(stored)
            reports = star.reports()
        else:
            builder = StarBuilder(stored, args.as_of, scratch, rows)
            add = builder.append if args.incremental and store.newest() else builder.publish
            tables = add(store, cluster_fact=args.cluster_fact)
    finally:
        scratch.close()
    fact = tables[serving.FACT_TABLE]
    return {
        "summary": serving.gold_summary(fact),
        "alerts": serving.alert_distribution(fact),
        "tables": serving.row_counts(tables),
        **reports,
    }


def run_serve(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    store = SnapshotStore(spark, args.gold, args.format)
    if args.versions:
        tables = VersionedStar(store, args.as_of, Scratch(spark)).tables()
        tables = serving.with_today(tables) if args.today else serving.with_recorded(tables)
    else:
        tables = read_star(store, store.latest())
    prepare(spark, tables[serving.FACT_TABLE].count())  # from the footers
    view, fact = serving.analytics_view(tables), tables[serving.FACT_TABLE]
    reports = {
        "analytics_view": lambda: view,
        "weighted_scores": lambda: dashboards.weighted_scores(view),
        "gap_summary": lambda: serving.gap_summary(tables),
        "top_cases": lambda: serving.top_cases(tables),
        "validation_stats": lambda: serving.validation_stats(tables),
        "row_counts": lambda: serving.row_counts(tables),
        "text_lengths": lambda: serving.text_lengths(tables),
        "work_queue": lambda: dashboards.work_queue(view),
        "weekly_trend": lambda: dashboards.weekly_trend(fact),
        "demographics": lambda: dashboards.demographics(view),
        "geo_rollup": lambda: dashboards.geo_rollup(view),
        "budget_by_month": lambda: dashboards.budget_by_month(view),
        "executive_kpis": lambda: dashboards.executive_kpis(view),
    }
    return {name: reports[name]() for name in args.report or reports}


JOBS = {"feed": run_feed, "ingest": run_ingest, "alerts": run_alerts, "dedupe": run_dedupe,
        "compact": run_compact, "silver": run_silver, "gold": run_gold, "serve": run_serve}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docketworks.jobs", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *folders: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name)
        for folder in folders:
            one.add_argument(f"--{folder}", required=True)
        one.add_argument("--format", default="parquet")
        one.add_argument("--as-of", type=datetime.fromisoformat,
                         default=datetime.now(timezone.utc), help="the run's notion of now (UTC)")
        return one

    job("feed", "tables", "landing")
    stream = job("ingest", "bronze", "checkpoint")
    stream.add_argument("--source", default="kafka")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    stream.add_argument("--every", default=ingest.TRIGGER)
    stream.add_argument("--once", action="store_true", help="take what is there, then stop")
    stream.add_argument("--seconds", type=int, help="stop waiting after this time")
    stream.add_argument("--monitor", action="store_true", help="also print the records")
    for name in ("alerts", "dedupe"):
        one = job(name, "bronze", "target", "checkpoint")
        one.add_argument("--delay", default="2 days", help="how late a record may come")
        one.add_argument("--files-per-trigger", type=int, help="files of one micro-batch")
        one.add_argument("--every", default=ingest.TRIGGER)
        one.add_argument("--once", action="store_true")
        one.add_argument("--seconds", type=int)
    kind = jobs.choices["alerts"].add_mutually_exclusive_group()
    kind.add_argument("--counts", action="store_true", help="per day and district")
    kind.add_argument("--unanswered", action="store_true", help="those without a lawyer in time")
    kind.add_argument("--episodes", action="store_true", help="runs of alerts per defendant")
    jobs.choices["dedupe"].add_argument("--forever", action="store_true", help="compare with all that is stored")
    job("compact", "bronze", "target")
    clean = job("silver", "bronze", "silver")
    clean.add_argument("--latest", action="store_true")
    clean.add_argument("--added-field", action="append", default=[], metavar="NAME",
                       help="a text field of newer documents that silver carries along")
    gold = job("gold", "silver", "gold")
    gold.add_argument("--cluster-fact", action="store_true", help="order its files by filing date")
    gold.add_argument("--incremental", action="store_true", help="add new hub records to what is there")
    serve = job("serve", "gold")
    serve.add_argument("--report", action="append")
    serve.add_argument("--today", action="store_true", help="with --versions: attributes as known today")
    for one in (gold, serve):
        one.add_argument("--versions", action="store_true", help="the star schema with versions")
    for name in ("silver", "gold", "serve"):
        jobs.choices[name].add_argument("--output", help="folder for the reports, one table each")
    return top


SHOWN = 50


def deliver(name: str, report: DataFrame, output: str | None) -> None:
    """Write a report whole, or print its first rows and how many there are."""
    if output:
        report.write.mode("overwrite").parquet(f"{output}/{name}")
        return
    rows = report.count()
    print(f"== {name}: {rows} rows" + (f", the first {SHOWN} are shown" if rows > SHOWN else ""))
    report.show(SHOWN, truncate=False)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = prepare(spark or build_session(f"docketworks-{args.job}"))
    for name, report in (JOBS[args.job](spark, args) or {}).items():
        deliver(name, report, getattr(args, "output", None))


if __name__ == "__main__":
    main()
