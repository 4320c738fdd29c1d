"""Invariants of the star schema, small and sliced, and its publication."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import AS_OF, plan_of, rows_of
from pyspark.sql import functions as F

from docketworks.plans import dashboards, serving, silver
from docketworks.plans.star import DIMENSIONS, StarBuilder
from docketworks.schemas import BRONZE, FACT, GOLD, ddl, names
from docketworks.session import Sizing
from docketworks.sources.snapshots import LostUpdate, SnapshotStore
from docketworks.sources.tables import create_external_tables

TINY = Sizing(single_task_rows=100, numbering_rows=100, rows_per_partition=200)
FACT_TABLE = serving.FACT_TABLE


@pytest.fixture(scope="module")
def sliced_star(workspace, scratch):
    builder = StarBuilder(workspace.silver, AS_OF, scratch, sizing=TINY)
    return builder.publish(SnapshotStore(workspace.spark, scratch.path("gold")), cluster_fact=True)


def test_sliced_build_equals_plain_build(workspace, sliced_star):
    for table, frame in workspace.star.items():
        assert rows_of(frame) == rows_of(sliced_star[table]), table


def test_schemas(workspace):
    for table, fields in GOLD.items():
        assert workspace.star[table].dtypes == list(fields)


def test_fact_invariants(workspace):
    fact, star = workspace.fact, workspace.star
    complete = workspace.silver.dropna(
        subset=["case_id", "defendant_id", "court_district", "assigned_judge"])
    rows = complete.count()
    assert fact.count() == rows
    low, high, different = fact.agg(
        F.min("proceeding_sk"), F.max("proceeding_sk"), F.count_distinct("proceeding_sk")).first()
    assert (low, high, different) == (1, rows, rows)
    for table, key in (("dim_defendant", "defendant_sk"), ("dim_case_details", "case_details_sk"),
                       ("dim_court", "court_sk")):
        dim = star[table]
        assert fact.join(dim, key, "left_anti").count() == 0
        size = dim.count()
        assert dim.agg(F.max(key), F.count_distinct(key)).first()[:] == (size, size)


def small_silver(spark):
    """A defendant with two attribute sets, an unknown age, and rows without keys."""
    def document(case, who, judge="Judge Brown", age=30, zip_code=10001):
        fields = {"case_id": case, "defendant_id": who, "attorney_status": "Self-Represented",
                  "charge_severity": "Felony", "court_district": "Bronx Criminal Court",
                  "assigned_judge": judge, "case_filed_date": "2024-05-01T00:00:00",
                  "hearing_date": "2024-05-20T00:00:00"}
        texts = [f'"{k}":"{v}"' for k, v in fields.items() if v is not None]
        numbers = [f'"{k}":{v}' for k, v in
                   (("defendant_age", age), ("defendant_zip_code", zip_code)) if v is not None]
        return "{" + ",".join(texts + numbers) + "}"

    documents = [
        document("c1", "d1"), document("c2", "d1", zip_code=None), document("c3", "d2", age=None),
        document(None, "d3"), document("c5", None), document("c6", "d4", judge=None), "not json",
    ]
    rows = [(d, datetime(2024, 5, 1), 0, i, AS_OF) for i, d in enumerate(documents)]
    return silver.clean(silver.parse(spark.createDataFrame(rows, ddl(BRONZE))), AS_OF)


def test_literal_join_fans_out_and_exact_join_does_not(spark, scratch):
    builder = StarBuilder(small_silver(spark), AS_OF, scratch, rows=7)
    dims = {table: builder.dimension(table) for table in DIMENSIONS}
    exact = builder.fact(dims)
    assert rows_of(exact, "proceeding_sk", "case_id") == [(1, "c1"), (2, "c2"), (3, "c3")]
    literal = builder.natural_key_rows(dims)
    assert rows_of(literal, "case_id") == [("c1",), ("c1",), ("c2",), ("c2",), ("c3",)]


def test_exact_join_is_the_same_without_broadcasts(workspace):
    conf = workspace.spark.conf
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = workspace.builder().fact(workspace.star)
        assert plan_of(merged).count("SortMergeJoin") == 3
        assert rows_of(merged) == rows_of(workspace.fact)
    finally:
        conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("sizing", [Sizing(), TINY])
def test_appended_loads_keep_all_keys(workspace, scratch, sizing):
    store = SnapshotStore(workspace.spark, scratch.path("loads"))
    loads = [workspace.silver.filter(F.pmod("eventhub_offset", F.lit(3)) == n) for n in range(3)]
    tables = StarBuilder(loads[0], AS_OF, scratch, sizing=sizing).publish(store)
    for load in loads[1:]:
        before = {t: set(rows_of(f)) for t, f in tables.items()}
        tables = StarBuilder(load, AS_OF, scratch, sizing=sizing).append(store)
        for table, frame in tables.items():
            assert before[table] <= set(rows_of(frame)), table
    again = StarBuilder(loads[1], AS_OF, scratch, sizing=sizing)
    for table, attributes in DIMENSIONS.items():
        key = GOLD[table][0][0]
        numbers = [r[0] for r in rows_of(tables[table], key)]
        assert numbers == list(range(1, len(numbers) + 1))
        assert rows_of(tables[table], *attributes) == rows_of(workspace.star[table], *attributes)
        assert again.dimension(table, tables[table]).count() == 0
    natural = ["case_id", "defendant_id", "representation_priority_score", "estimated_case_cost"]
    assert rows_of(tables[FACT_TABLE], *natural) == rows_of(workspace.fact, *natural)
    assert rows_of(serving.gap_summary(tables)) == rows_of(serving.gap_summary(workspace.star))


@pytest.fixture(scope="module")
def grown(workspace, scratch):
    """A store after a first load, an increment and the same increment again."""
    store = SnapshotStore(workspace.spark, scratch.path("grown"))
    early = F.col("record_timestamp") < F.lit(AS_OF - timedelta(days=45))

    def load(rows):
        return StarBuilder(workspace.silver.filter(rows), AS_OF, scratch, workspace.rows)

    load(early).publish(store)
    once = {t: f.count() for t, f in load(~early).append(store).items()}
    return store, once, load(~early).append(store)


def test_a_repeated_increment_adds_nothing(workspace, grown):
    _, once, twice = grown
    assert {t: f.count() for t, f in twice.items()} == once
    assert once[FACT_TABLE] == workspace.fact.count()
    low, high, different = twice[FACT_TABLE].agg(
        F.min("proceeding_sk"), F.max("proceeding_sk"), F.count_distinct("proceeding_sk")).first()
    assert (low, high, different) == (1, once[FACT_TABLE], once[FACT_TABLE])


def test_external_tables_after_increments(workspace, grown):
    store, once, _ = grown
    snapshot = store.latest()
    for _ in range(2):  # declaring them again replaces the entries
        made = create_external_tables(
            workspace.spark, lambda t: store.locations(snapshot, t), prefix="grown_")
    assert {t: workspace.spark.table(n).count() for t, n in made.items()} == once
    assert workspace.spark.table(made[FACT_TABLE]).dtypes == list(FACT)


def test_a_managed_table_is_not_dropped(workspace):
    spark = workspace.spark
    spark.range(3).write.mode("overwrite").saveAsTable("kept_dim_court")
    try:
        with pytest.raises(ValueError, match="managed"):
            create_external_tables(
                spark, lambda t: workspace.store.locations(workspace.store.latest(), t), prefix="kept_")
        assert spark.table("kept_dim_court").count() == 3
    finally:
        spark.sql("DROP TABLE kept_dim_court")
        spark.sql("DROP TABLE IF EXISTS kept_dim_defendant")
        spark.sql("DROP TABLE IF EXISTS kept_dim_case_details")


def test_an_addition_to_an_old_snapshot_fails(spark, scratch):
    store = SnapshotStore(spark, scratch.path("rivals"))
    first = store.publish({"t": spark.range(3)})
    for number in range(2):
        mine = store.new_snapshot()
        store.write(mine, "t", spark.range(2))
        if number:
            with pytest.raises(LostUpdate):
                store.commit(mine, added_to=first)
        else:
            store.commit(mine, added_to=first)
    assert store.read("t", (("id", "bigint"),)).count() == 5


def test_a_week_without_filings_counts_as_zero(spark):
    rows = [("2024-01-01", True), ("2024-01-02", False), ("2024-01-22", True), ("2024-01-29", False)]
    fact = spark.createDataFrame(rows, "d string, needs_representation boolean").select(
        F.col("d").cast("timestamp").alias("case_filed_date"), "needs_representation")
    found = [(str(r["week"]), r["filings_change"], r["gap_change"])
             for r in dashboards.weekly_trend(fact).orderBy("week").collect()]
    assert found == [("2024-01-01", None, None), ("2024-01-22", 1, 1), ("2024-01-29", 0, -1)]


def test_no_report_copies_every_row(workspace):
    view = workspace.view()
    for report in (dashboards.executive_kpis(view), serving.validation_stats(workspace.star)):
        assert "Expand" not in plan_of(report)
    for report in (dashboards.demographics(view), dashboards.geo_rollup(view)):
        inner = below("Expand", plan_of(report))
        assert any("HashAggregate" in line for line in inner)


def test_view_shows_current_versions_only(workspace):
    star = dict(workspace.star)
    closed = F.col("defendant_sk") == 1
    star["dim_defendant"] = star["dim_defendant"].withColumn("is_current", ~closed)
    hidden = workspace.fact.filter(closed).count()
    assert hidden > 0
    view = serving.analytics_view(star)
    assert len(view.columns) == 30
    assert view.count() == workspace.fact.count() - hidden
    assert serving.top_cases(star, 10**4).count() == view.filter("needs_representation").count()


def test_empty_silver(workspace, scratch):
    builder = StarBuilder(workspace.silver.filter("false"), AS_OF, scratch)
    tables = builder.publish(SnapshotStore(workspace.spark, scratch.path("empty")))
    assert rows_of(serving.row_counts(tables), "row_count") == [(0,)] * 4
    assert serving.gold_summary(tables[FACT_TABLE]).first().needs_representation_pct is None
    assert serving.validation_stats(tables).first().avg_priority_score is None


def test_approximate_statistics_are_close(workspace):
    exact = serving.validation_stats(workspace.star).first()
    rough = serving.validation_stats(workspace.star, approximate=True).first()
    assert rough.total_proceedings == exact.total_proceedings
    assert abs(rough.unique_defendants - exact.unique_defendants) <= 0.15 * exact.unique_defendants


def test_readers_keep_the_last_committed_snapshot(spark, scratch):
    store = SnapshotStore(spark, scratch.path("store"))
    fields = (("id", "bigint"),)
    with pytest.raises(Exception):
        store.latest()
    store.publish({"t": spark.range(3)})
    unfinished = store.new_snapshot()
    store.write(unfinished, "t", spark.range(100))
    assert store.read("t", fields).count() == 3
    store.commit(unfinished)
    assert store.read("t", fields).count() == 100


def test_external_tables_have_declared_types(workspace):
    workspace.star
    snapshot = workspace.store.latest()
    made = create_external_tables(
        workspace.spark, lambda t: workspace.store.locations(snapshot, t), prefix="typed_")
    assert workspace.spark.table(made[FACT_TABLE]).dtypes == list(FACT)


# --- plans ---------------------------------------------------------------------

def below(marker: str, plan: str) -> list[str]:
    """The lines of the operator that contains ``marker`` and of all its inputs."""
    lines = plan.splitlines()
    start = next(i for i, line in enumerate(lines) if marker in line)
    depth = lines[start].index(marker)
    found = [lines[start]]
    for line in lines[start + 1:]:
        if len(line) - len(line.lstrip(" :+-*")) <= depth:
            break
        found.append(line)
    return found


def test_serving_reads_only_what_it_uses(workspace):
    plan = plan_of(serving.gap_summary(workspace.star))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    wide = names(GOLD["dim_defendant"])[2]
    assert all("created_timestamp" not in s and wide not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)" in plan


def test_date_filter_reaches_the_scan(sliced_star):
    early = sliced_star[FACT_TABLE].filter(
        F.col("case_filed_date") < F.lit(AS_OF - timedelta(days=60)))
    assert "LessThan(case_filed_date" in plan_of(early)


def test_one_pass_reports(workspace):
    for report in (silver.quality_report(workspace.silver), serving.gold_summary(workspace.fact)):
        assert plan_of(report).count("FileScan") == 1


def test_top_cases_keep_wide_columns_out_of_the_ranking(workspace):
    ranking = below("TakeOrderedAndProject(limit=10", plan_of(serving.top_cases(workspace.star)))
    scans = [line for line in ranking if "ReadSchema" in line]
    assert len(scans) == 4
    for column in ("charge_type", "attorney_status", "court_district", "estimated_case_cost"):
        assert not any(column in line.split("ReadSchema")[1] for line in scans)


def test_hot_dimension_key_is_split(spark):
    """Adaptive execution cuts the partition of a key that holds most rows."""
    old = {}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.shuffle.partitions": "8",
    }
    try:
        for name, value in settings.items():
            old[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)
        facts = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("payload"))
        dims = spark.range(200_000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
        joined = facts.join(dims, "k").groupBy("k", "name").agg(F.max("payload"))
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
