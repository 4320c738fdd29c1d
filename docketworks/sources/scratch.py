"""Intermediate tables in the folder the cluster shares for checkpoints.

A written table cuts lineage: later stages read files that survive the loss of
any executor, and every reader sees the same rows.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _local_master(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _temporary_folder() -> str:
    folder = tempfile.mkdtemp(prefix="docketworks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpoint_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or a temporary folder in local mode only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not _local_master(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _temporary_folder()


class Scratch:
    """A private folder for the intermediate tables of one run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.base = f"{root or checkpoint_root(spark)}/docketworks-{uuid.uuid4().hex}"
        self._numbers = count()

    def path(self, label: str) -> str:
        return f"{self.base}/{next(self._numbers):03d}-{label}"

    def stage(self, frame: DataFrame, label: str) -> DataFrame:
        """Write ``frame`` once and return the stored table."""
        target = self.path(label)
        frame.write.parquet(target)
        return self.spark.read.schema(frame.schema).parquet(target)

    def close(self) -> None:
        """Delete the folder. Frames read from it are unusable afterwards."""
        _delete(self.spark, self.base)


class Passing:
    """Stages into ``scratch`` for one step and remembers where."""

    def __init__(self, scratch: Scratch):
        self.spark, self.path = scratch.spark, scratch.path
        self._scratch, self._folders = scratch, set()

    def stage(self, frame: DataFrame, label: str) -> DataFrame:
        found = self._scratch.stage(frame, label)
        self._folders.update(unquote(file).rpartition("/")[0] for file in found.inputFiles()[:1])
        return found

    def close(self) -> None:
        for folder in self._folders:
            _delete(self.spark, folder)


@contextmanager
def passing(scratch: Scratch) -> Iterator[Passing]:
    """A scratch whose tables are deleted when the step that stages them is done.

    What the step returns must not read them; the tables that ``scratch`` holds already stay.
    """
    step = Passing(scratch)
    try:
        yield step
    finally:
        step.close()


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
