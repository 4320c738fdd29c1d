"""Sliced and plain arrangements must agree, whatever the skew."""

from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from docketworks.operators.asof import as_of_join
from docketworks.operators.dense_keys import add_dense_key
from docketworks.operators.latest import latest_per_key
from docketworks.operators.ranking import top_per_group
from docketworks.operators.sequence import arrange
from docketworks.session import Sizing

# small enough that the hot keys of these tests are cut into many slices
TINY = Sizing(single_task_rows=40, numbering_rows=50, rows_per_partition=25)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: one key and the null key hold most of them; values repeat and have gaps."""
    rng = random.Random(7)
    rows = []
    for n in range(600):
        key = rng.choice(["hot"] * 6 + [None] * 3 + [f"k{rng.randrange(30)}"])
        rows.append((key, rng.randrange(90), n, rng.choice(["a", "b", None, "b"])))
    return spark.createDataFrame(rows, "k string, t int, n int, v string").repartition(5).cache()


def both(frame, scratch, operation):
    """Rows by plain windows and by slices; the slices must really have been used."""
    plain = arrange(frame, ["k"], ["t", "n"], scratch)
    cut = arrange(frame, ["k"], ["t", "n"], scratch, sizing=TINY)
    assert [p.sliced for p in plain.parts] == [False]
    assert [p.sliced for p in cut.parts] == [False, True]
    slices = cut.parts[1].frame.filter("k = 'hot'").select("_slice").distinct().count()
    assert slices > 3
    columns = operation(plain).frame.columns
    return rows_of(operation(plain).frame, *columns), rows_of(operation(cut).frame, *columns)


OPERATIONS = {
    "previous": lambda s: s.previous({"before": "v", "before_t": "t"}, present="seen"),
    "following": lambda s: s.following({"after": "v"}, present="more"),
    "position": lambda s: s.position("place"),
    "carry": lambda s: s.carry_forward({"known": "v"}),
    "chain": lambda s: s.previous({"was": "v"}, present="seen")
    .where("NOT seen OR NOT (v <=> was)").position("place").following({"until": "t"}),
    "chain stored": lambda s: s.previous({"was": "v"}, present="seen")
    .where("NOT seen OR NOT (v <=> was)").stored("kept").position("place"),
    "sparse": lambda s: s.where("n % 37 = 0").position("place").carry_forward({"known": "v"})
    .following({"after": "n"}),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_slices_equal_windows(skewed, scratch, name):
    plain, cut = both(skewed, scratch, OPERATIONS[name])
    assert plain == cut


def test_hot_rows_leave_the_keyed_window(skewed, scratch):
    cut = arrange(skewed, ["k"], ["t", "n"], scratch, sizing=TINY)
    usual, heavy = (p.frame for p in cut.parts)
    assert usual.count() + heavy.count() == skewed.count()
    assert usual.filter("k = 'hot' OR k IS NULL").count() == 0
    largest = heavy.groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest < heavy.count() / 3


def test_no_hot_key_means_one_plain_part(spark, scratch):
    even = spark.range(500).select((F.col("id") % 100).alias("k"), "id")
    assert [p.sliced for p in arrange(even, ["k"], ["id"], scratch, sizing=TINY).parts] == [False]


def test_a_hot_key_is_split_whatever_the_size_of_the_table(skewed, scratch):
    """The limit is that of a task alone; a stated row count far beyond the real one changes nothing."""
    for rows in (600, 10**13):
        parts = arrange(skewed, ["k"], ["t", "n"], scratch, rows=rows, sizing=TINY).parts
        assert [p.sliced for p in parts] == [False, True]


@pytest.mark.parametrize("start", [0, 1000])
def test_dense_keys(skewed, scratch, start):
    order = ["k", "t", "n"]
    plain = add_dense_key(skewed, "sk", order, scratch, rows=600, start=start)
    cut = add_dense_key(skewed, "sk", order, scratch, start=start, sizing=TINY)
    assert rows_of(plain, "sk", *order) == rows_of(cut, "sk", *order)
    numbers = [r[0] for r in rows_of(cut, "sk")]
    assert numbers == list(range(start + 1, start + 601))


def test_large_numbering_has_no_single_task_window(skewed, scratch):
    cut = add_dense_key(skewed, "sk", ["k", "t", "n"], scratch, sizing=TINY)
    # the only single-partition step numbers the slices, one row each
    plan = plan_of(cut)
    assert plan.count("Exchange SinglePartition") == 1
    assert "Window [sum(_rows" in plan and "row_number" not in plan


def test_dense_keys_on_empty_input(skewed, scratch):
    empty = skewed.filter("false")
    assert add_dense_key(empty, "sk", ["k"], scratch).count() == 0


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 1, "p"), (None, 3, None),
            ("b", None, "q")]
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    assert rows_of(latest_per_key(frame, ["k"], ["t"])) == [
        (None, 3, None), ("a", 2, "z"), ("b", None, "q")]


def test_latest_per_key_combines_before_the_shuffle(spark):
    frame = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = plan_of(latest_per_key(frame, ["k"], ["t"]))
    assert "partial_max" in plan and "Window" not in plan


def test_top_per_group_limits_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("s"))
    top = top_per_group(frame, ["g"], [F.desc("s")], 2, "place")
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert rows_of(top, "g", "s") == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    frame = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("s"))
    large = top_per_group(frame, ["g"], [F.desc("s")], 5000, "place")
    assert plan_of(large).count("WindowGroupLimit") == 2 and large.count() == 15_000


@pytest.mark.parametrize("sizing", [None, TINY])
def test_as_of_join_against_brute_force(spark, scratch, sizing):
    rng = random.Random(3)
    keys = ["hot"] * 8 + ["x", "y", None]
    rows = [(rng.choice(keys), rng.randrange(60), n) for n in range(300)]
    versions = [(rng.choice(keys), rng.randrange(60), n) for n in range(200)]

    def in_force(key, time):
        fits = [(t, n) for k, t, n in versions if k == key and t <= time]
        return max(fits)[1] if fits else None

    found = as_of_join(
        spark.createDataFrame(rows, "k string, t int, n int"),
        spark.createDataFrame(versions, "k string, vt int, version int"),
        ["k"], "t", "vt", ["version"], ["n"], ["version"], scratch, sizing=sizing,
    )
    expected = sorted((n, in_force(k, t)) for k, t, n in rows)
    assert [(n, v) for n, v in rows_of(found, "n", "version")] == expected
