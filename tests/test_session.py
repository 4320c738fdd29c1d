"""Settings and sizing."""

from __future__ import annotations

from docketworks.session import RUNTIME_SETTINGS, Sizing, prepare, spread

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_prepare_applies_settings_and_widens_large_shuffles(spark):
    before = spark.conf.get(INITIAL, None)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        prepare(spark, rows=1000)
        assert spark.conf.get(INITIAL, None) == before
        assert all(spark.conf.get(name) == value for name, value in RUNTIME_SETTINGS.items())
        prepare(spark, rows=5_000_000_000)
        assert spark.conf.get(INITIAL) == "5000"
    finally:
        spark.conf.unset(INITIAL)


def test_sizing_grows_with_the_rows_up_to_its_bound():
    sizing = Sizing()
    assert [sizing.partitions(n) for n in (0, 1, 10**6, 10**6 + 1, 10**14)] == [
        1, 1, 1, 2, sizing.max_partitions]


def test_spread_leaves_wide_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores * 3)
    assert spread(wide) is wide
