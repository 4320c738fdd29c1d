"""What large tables must not meet: steps that run twice, wide sorts, and broadcasts by stored size."""

from __future__ import annotations

from datetime import timedelta

from conftest import AS_OF, plan_of, rows_of
from pyspark.sql import functions as F
from test_versioned import FACT_TABLE, START, event, frame

from docketworks.operators.chains import Tail, intervals
from docketworks.operators.scd2 import EFFECTIVE
from docketworks.operators.sequence import arrange
from docketworks.plans import conformity
from docketworks.plans.star import DIMENSIONS, StarBuilder, not_among
from docketworks.plans.versioned import STORED, VersionedStar
from docketworks.schemas import BRONZE, ddl
from docketworks.session import Sizing, prepare
from docketworks.sources.snapshots import SnapshotStore

TINY = Sizing(single_task_rows=40, numbering_rows=50, rows_per_partition=25)


class Labels:
    """The scratch of a test with the labels and columns of what is stored."""

    def __init__(self, scratch):
        self.scratch, self.spark, self.path, self.stored = scratch, scratch.spark, scratch.path, {}

    def stage(self, rows, label):
        self.stored[label] = rows.columns
        return self.scratch.stage(rows, label)


def test_a_large_frame_is_stored_before_it_is_measured(spark, scratch):
    source = spark.range(200).select((F.col("id") % 10).alias("k"), F.col("id").alias("t"))
    parts = arrange(source, ["k"], ["t"], scratch, sizing=TINY).parts
    assert [p.sliced for p in parts] == [False] and parts[0].frame.inputFiles()
    assert rows_of(parts[0].frame) == rows_of(source)


def test_a_bound_of_the_rows_of_a_key_saves_the_measuring(spark, scratch):
    labels = Labels(scratch)
    source = spark.range(200).select((F.col("id") % 10).alias("k"), F.col("id").alias("t"))
    assert not arrange(source, ["k"], ["t"], labels, sizing=TINY, key_rows=40).parts[0].sliced
    assert not labels.stored
    arrange(source.withColumn("k", F.lit(1)), ["k"], ["t"], labels, sizing=TINY, key_rows=200)
    assert {"unmeasured", "hot-keys"} <= set(labels.stored)


def test_loads_of_small_keys_are_not_measured_however_many_rows_there_may_be(spark, scratch):
    labels = Labels(scratch)
    star = VersionedStar(SnapshotStore(spark, scratch.path("small-keys")), AS_OF, labels, 10_000, TINY)
    events = [event(n, n, who=f"d{n % 9}", case=f"c{n % 11}") for n in range(30)]
    for part in (events[::2], events[1::2]):
        star.load(frame(spark, part))
    assert not {"unmeasured", "hot-keys"} & set(labels.stored)
    assert star.tables()["fact_court_proceedings"].count() == 30


def test_the_fact_is_numbered_without_its_measures(workspace, scratch):
    labels = Labels(scratch)
    builder = StarBuilder(workspace.silver, AS_OF, labels, workspace.rows, TINY)
    fact = builder.fact({table: workspace.star[table] for table in DIMENSIONS})
    assert not {"estimated_case_cost", "alert_priority"} & set(labels.stored["sliced-proceeding_sk"])
    assert rows_of(fact) == rows_of(workspace.fact)


def test_documents_are_parsed_once_for_their_drift(spark):
    rows = [('{"a": 1, "b": {"x": 1.5}, "c": [2.5]}', None, 0, 1, None), ('{"a": 1.25}', None, 0, 2, None)]
    drift = conformity.schema_drift(spark.createDataFrame(rows, ddl(BRONZE)))
    assert {r["field"]: r["types"] for r in drift.collect()} == {"a": "integer,number", "b": "object", "c": "array"}
    assert drift._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1


def test_a_table_of_some_megabytes_is_not_broadcast(spark, scratch):
    prepare(spark)
    wide = spark.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    stored = scratch.stage(wide, "some-megabytes")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = stored.join(stored.select("id", F.col("text").alias("other")), "id")
        assert "BroadcastHashJoin" not in plan_of(joined)
    finally:
        prepare(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def shuffles(rows) -> int:
    """Shuffles of the plan of ``rows``, whatever adaptive execution makes of them."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan_of(rows.select("*")).count("Exchange hashpartitioning")
    finally:
        prepare(spark)


def test_owners_and_first_versions_of_ordinary_keys_need_no_shuffle_of_their_own(spark, scratch):
    rows = spark.range(60).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.expr("id div 6").alias("run"),
        F.expr("CASE WHEN id % 6 > 2 THEN id END").alias("sk"), (F.col("id") + 100).alias("v"),
        F.expr("id % 6 < 3").alias("opens"))
    found = []
    for sizing in (Sizing(), Sizing(single_task_rows=5, rows_per_partition=7)):
        picked = arrange(rows, ["k"], ["t"], scratch, sizing=sizing).position("n").openers(
            "opens", "run", {"owner": "sk"}, {"base": "v"})
        assert [p.sliced for p in picked.parts] in ([False], [False, True])
        found.append(rows_of(picked.frame, "k", "t", "owner", "base"))
        if len(picked.parts) == 1:
            assert shuffles(picked.frame) == 1
    assert found[0] == found[1] == [(n % 3, n, n + 3, n % 3 + 100) for n in sorted(
        (n for n in range(60) if n % 6 < 3), key=lambda n: (n % 3, n))]


def test_changed_stretches_need_one_shuffle(spark, scratch):
    """Edges of both chains at one position are one stretch, with keys in slices as well."""
    fields = f"d string, {EFFECTIVE} timestamp, tie int, sk bigint"
    def chain(*rows):
        return spark.createDataFrame([(d, START + timedelta(hours=h), tie, sk) for d, h, tie, sk in rows], fields)
    tail = Tail(chain(("a", 1, 0, 1), ("a", 5, 0, 2), ("b", 1, None, 3)),
                chain(("a", 0, 0, 9), ("a", 1, 0, 1), ("a", 5, 0, 8), ("b", 1, None, 3)))
    expected = [("a", 0, None, 9), ("a", 1, 1, 1), ("a", 5, 2, 8), ("b", 1, 3, 3)]
    for sizing in (Sizing(), Sizing(single_task_rows=2, rows_per_partition=3)):
        found = intervals(tail, "sk", ["d"], ["tie"], scratch, sizing=sizing)
        assert [(r.d, (r.begins.time - START).seconds // 3600, r.was, r.now) for r in found.orderBy(
            "d", "begins").collect()] == expected
    assert shuffles(intervals(tail, "sk", ["d"], ["tie"], scratch)) == 1


def test_moved_facts_are_found_by_their_keys_and_fetched_once(spark, scratch):
    labels = Labels(scratch)
    star = VersionedStar(SnapshotStore(spark, scratch.path("moved")), AS_OF, labels, 100)
    star.load(frame(spark, [event(n, 2 * n, who="d1") for n in range(8)]))
    star.load(frame(spark, [event(9, 5, who="d1", status="Private Attorney")]))
    assert set(labels.stored["moved-keys"]) == {"proceeding_sk", "_at", "_defendant_sk", "_case_details_sk"}
    assert labels.stored["moved"] == star.store.read(FACT_TABLE, STORED[FACT_TABLE]).columns
    assert {"defendant_gender", "assigned_judge", "hearing_type"}.isdisjoint(labels.stored["keyed"])
    assert star.rows_in_force(FACT_TABLE).filter("load = 1").count() == 1 + 5  # those from hour 6 on moved


def test_records_of_a_new_or_repeated_delivery_are_compared_by_position_alone(spark, scratch):
    rows = spark.range(40).select(
        (F.col("id") % 4).cast("int").alias("eventhub_partition"), F.expr("id div 4").alias("eventhub_offset"),
        F.col("id").cast("string").alias("wide"))
    nameless = spark.createDataFrame([(None, 3, "none"), (None, None, "none")], rows.schema)
    labels, positions = Labels(scratch), ["eventhub_partition", "eventhub_offset"]
    for loaded, expected in ((rows.filter("eventhub_offset < 2"), 32), (rows.limit(0), 40), (rows, 0)):
        left = not_among(rows, loaded, labels)
        assert left.count() == expected and left.columns == rows.columns
        assert labels.stored["loaded-again"] == positions
    assert "Join" not in plan_of(not_among(rows, rows.limit(0), labels))
    assert not_among(rows.unionByName(nameless), rows, labels).count() == 2  # without a position they stay
