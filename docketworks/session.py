"""Session settings and the sizing rules that follow from row counts."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

# Settings every job relies on; all of them can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split over several tasks, also where an aggregate follows
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sizes count stored bytes, which are about a tenth of those in memory: a task sorts some 200 MB, and a
    # broadcast table does not fill the memory of every executor (9.6 MB of cases took 520 MB per task)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.parquet.compression.codec": "zstd",
    # the shuffle files of an action go when it ends, not when the driver happens to collect its plan
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # streaming state on local disk with changes in the checkpoint, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


INITIAL_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@dataclass(frozen=True)
class Sizing:
    """How many rows one task may be given.

    ``single_task_rows``: the largest group that may be ordered by one task.
    ``numbering_rows``: the largest table that is numbered by one task; beyond it
    slices of half this size are faster as well (measured: even at 500,000 rows,
    half the time at 2,000,000). ``rows_per_partition``: target size of a shuffle
    partition.
    """

    single_task_rows: int = 5_000_000
    numbering_rows: int = 500_000
    rows_per_partition: int = 1_000_000
    max_partitions: int = 100_000

    def partitions(self, rows: int) -> int:
        return max(1, min(self.max_partitions, math.ceil(rows / self.rows_per_partition)))

    def numbering_slices(self, rows: int) -> int:
        return max(2, min(self.max_partitions, math.ceil(2 * rows / self.numbering_rows)))


def prepare(spark: SparkSession, rows: int = 0, sizing: Sizing | None = None) -> SparkSession:
    """Apply the runtime settings; raise the shuffle width if ``rows`` asks for it, else set it back."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    wanted = (sizing or Sizing()).partitions(rows)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_WIDTH, str(wanted))
    else:
        spark.conf.unset(INITIAL_WIDTH)
    return spark


def side_by_side(*works: Callable[[], Result]) -> list[Result]:
    """Results of independent jobs that run at the same time; the first failure is raised."""
    session = SparkSession.getActiveSession()
    wrap = inheritable_thread_target(session) if session else lambda work: work
    with ThreadPoolExecutor(len(works)) as pool:
        return [done.result() for done in [pool.submit(wrap(work)) for work in works]]


def spread(frame: DataFrame) -> DataFrame:
    """Use all cores on a scan that has fewer splits than the cluster has cores.

    Large tables have many splits and pass unchanged.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
