"""The jobs end to end, from files in a landing folder to the reports."""

from __future__ import annotations

from conftest import SF_DIR
from pyspark.sql import functions as F

from docketworks.jobs import main
from docketworks.plans import serving
from docketworks.plans.star import read_star
from docketworks.sources.snapshots import SnapshotStore
from docketworks.streaming.exactly_once import OnceSink


def test_from_tables_to_reports(spark, tmp_path, capsys, workspace):
    place = {name: str(tmp_path / name) for name in
             ("landing", "bronze", "checkpoint", "silver", "gold")}
    now = ["--as-of", "2024-06-01"]

    def run(job, *arguments):
        main([job, *arguments], spark)
        return capsys.readouterr().out

    run("feed", "--tables", SF_DIR, "--landing", place["landing"], *now)
    for _ in range(2):  # the second run finds nothing new
        run("ingest", "--source", "parquet", "--option", f"path={place['landing']}",
            "--bronze", place["bronze"], "--checkpoint", place["checkpoint"], "--once")
    silver = run("silver", "--bronze", place["bronze"], "--silver", place["silver"], *now)
    assert f"|{workspace.rows}" in silver.replace(" ", "")
    gold = run("gold", "--silver", place["silver"], "--gold", place["gold"], "--cluster-fact", *now)
    assert "fact_court_proceedings" in gold
    served = run("serve", "--gold", place["gold"], "--report", "row_counts")
    sizes = {line.split("|")[1].strip(): int(line.split("|")[2]) for line in served.splitlines()
             if line.startswith("|") and "row_count" not in line}
    assert sizes == {table: frame.count() for table, frame in workspace.star.items()}

    target = str(tmp_path / "reports")
    assert run("serve", "--gold", place["gold"], "--report", "work_queue", "--output", target) == ""
    queue = spark.read.parquet(f"{target}/work_queue")
    districts = workspace.view().filter("needs_representation").groupBy("court_district").count().collect()
    assert queue.count() == sum(min(20, r["count"]) for r in districts) > 50
    printed = run("serve", "--gold", place["gold"], "--report", "work_queue")
    assert f"work_queue: {queue.count()} rows, the first 50 are shown" in printed


def test_stream_jobs_and_compaction(spark, tmp_path, capsys, workspace):
    place = {name: str(tmp_path / name) for name in ("bronze", "alerts", "c1", "unique", "c2", "compact")}
    workspace.bronze().unionByName(workspace.bronze().limit(50)).repartition(6).write.parquet(place["bronze"])

    def run(job, *arguments):
        main([job, *arguments, "--as-of", "2024-06-01"], spark)
        return capsys.readouterr().out

    for _ in range(2):  # the second run goes on from the checkpoint and finds nothing
        assert "dropped as late" in run(
            "dedupe", "--bronze", place["bronze"], "--target", place["unique"], "--checkpoint", place["c2"],
            "--delay", "400 days", "--files-per-trigger", "2", "--once")
        assert spark.read.parquet(place["unique"]).count() == workspace.rows
    run("alerts", "--bronze", place["bronze"], "--target", place["alerts"], "--checkpoint", place["c1"], "--once")
    assert spark.read.parquet(place["alerts"]).columns[:2] == ["case_id", "defendant_id"]
    run("compact", "--bronze", place["bronze"], "--target", place["compact"])
    assert spark.read.parquet(place["compact"]).count() == workspace.rows + 50


def test_versions_and_increments(spark, tmp_path, capsys, workspace):
    place = {name: str(tmp_path / name) for name in ("bronze", "silver", "gold", "versions")}
    now = ["--as-of", "2024-06-01"]
    bronze = workspace.bronze()
    half = F.col("eventhub_offset") % 2 == 0

    def run(job, *arguments):
        main([job, *arguments], spark)
        return capsys.readouterr().out

    sizes = []
    for part in (bronze.filter(half), bronze.filter(~half)):
        part.write.mode("append").parquet(place["bronze"])
        run("silver", "--bronze", place["bronze"], "--silver", place["silver"], "--added-field", "court_room", *now)
        run("gold", "--silver", place["silver"], "--gold", place["gold"], "--incremental", *now)
        store = SnapshotStore(spark, place["gold"])
        sizes.append(read_star(store, store.latest())[serving.FACT_TABLE].count())
    assert sizes[0] < sizes[1] == workspace.fact.count()
    assert len(store.locations(store.latest(), serving.FACT_TABLE)) == 2
    told = run("gold", "--silver", place["silver"], "--gold", place["versions"], "--versions", *now)
    assert "upkept_gap" in told
    served = run("serve", "--gold", place["versions"], "--versions", "--today", "--report", "validation_stats")
    assert f"|{workspace.fact.count()}" in served.replace(" ", "")


def test_answers_and_the_sink_that_stores_once(spark, tmp_path, capsys, workspace):
    place = {name: str(tmp_path / name) for name in ("bronze", "once", "c0", "c1", "open", "c2", "runs", "c3")}
    workspace.bronze().unionByName(workspace.bronze().limit(50)).write.parquet(place["bronze"])

    def run(job, target, checkpoint, *arguments):
        main([job, "--bronze", place["bronze"], "--target", place[target], "--checkpoint", place[checkpoint],
              "--once", "--as-of", "2024-06-01", *arguments], spark)
        return capsys.readouterr().out

    for checkpoint in ("c0", "c1"):  # the second starts from the beginning again
        run("dedupe", "once", checkpoint, "--forever")
        assert OnceSink(spark, place["once"], "any").read().count() == workspace.rows
    assert "dropped as late: 0" in run("alerts", "open", "c2", "--unanswered")
    assert "dropped as late: 0" in run("alerts", "runs", "c3", "--episodes")
    assert spark.read.parquet(place["open"]).columns[0] == "case_id"
    assert "highest_priority" in spark.read.parquet(place["runs"]).columns
