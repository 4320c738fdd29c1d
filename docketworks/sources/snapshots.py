"""Tables that are published together, as a whole or by additions.

Each publication writes new folders and then appends its list of folders to the
commit log. Readers take the newest committed list, so they never see half a
load, and a failed load changes nothing. An addition lists its own folders and
names the snapshot that it adds to; nothing stored is rewritten.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.schemas import Fields, ddl

LOG = "_commits"
LOG_FIELDS = (
    ("number", "bigint"), ("snapshot", "string"), ("table_name", "string"), ("location", "string"),
    ("parent", "string"), ("committed_at", "timestamp"),
)
Parts = dict[str, list[str]]


class LostUpdate(RuntimeError):
    """Another load was committed since the snapshot that this one adds to."""


class SnapshotStore:
    """Snapshots below one folder. ``fmt`` may name any file format or table connector."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark = spark
        self.base = base.rstrip("/")
        self.fmt = fmt
        self._written: dict[str, Parts] = defaultdict(lambda: defaultdict(list))

    def new_snapshot(self) -> str:
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        return f"{stamp}-{uuid.uuid4().hex[:8]}"

    def write(
        self, snapshot: str, table: str, frame: DataFrame, cluster_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """Write rows of an open snapshot and return them as stored.

        ``cluster_by`` sorts the files by range, so that filters on its first
        column skip files and row groups; a hot value still spreads, because the
        range also uses the other columns.
        """
        if cluster_by:
            frame = frame.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        location = f"{self.base}/{table}/{snapshot}"
        frame.write.format(self.fmt).save(location)
        self._written[snapshot][table].append(location)
        return self.spark.read.format(self.fmt).schema(frame.schema).load(location)

    def commit(self, snapshot: str, added_to: str | None = None) -> None:
        """Make a snapshot visible, on top of the folders of ``added_to`` if given.

        Commits are numbered from the log, so their order is not that of any clock. An
        addition fails if ``added_to`` is no longer the newest, and if another commit took
        the same number in the meantime.
        """
        number, newest = self._newest()
        if added_to and added_to != newest:
            raise LostUpdate(f"{newest} was committed after {added_to}")
        written = self._written.pop(snapshot, {})
        places = [(table, place) for table, locations in written.items() for place in locations]
        # the first row, without a table, names the parent even if nothing was written
        rows = [(number + 1, snapshot, *place, added_to) for place in ((None, None), *places)]
        log = self.spark.createDataFrame(rows, ddl(LOG_FIELDS[:-1]))
        log = log.withColumn("committed_at", F.current_timestamp()).coalesce(1)
        log.write.mode("append").parquet(f"{self.base}/{LOG}")
        rivals = self._log().filter(F.col("number") == number + 1).select("snapshot").distinct()
        if added_to and rivals.count() > 1:
            raise LostUpdate(f"two commits are numbered {number + 1}")

    def publish(self, tables: Mapping[str, DataFrame]) -> str:
        snapshot = self.new_snapshot()
        for table, frame in tables.items():
            self.write(snapshot, table, frame)
        self.commit(snapshot)
        return snapshot

    def _log(self) -> DataFrame:
        return self.spark.read.schema(ddl(LOG_FIELDS)).parquet(f"{self.base}/{LOG}")

    def _newest(self) -> tuple[int, str | None]:
        """Number and name of the newest commit; 0 and None before the first."""
        try:
            found = self._log().agg(F.max(F.struct("number", "snapshot")).alias("newest")).first()[0]
        except AnalysisException:
            return 0, None
        return (found["number"], found["snapshot"]) if found else (0, None)

    def newest(self) -> str | None:
        """The newest committed snapshot, or None before the first."""
        return self._newest()[1]

    def latest(self) -> str:
        newest = self.newest()
        if newest is None:
            raise LookupError(f"nothing was published below {self.base}")
        return newest

    def parts(self, snapshot: str) -> Parts:
        """The folders of a committed snapshot per table, one per load since the last rebuild."""
        listed: dict[str, list] = defaultdict(list)
        for row in self._log().orderBy("number").collect():  # a row per folder
            listed[row.snapshot].append(row)
        line = [snapshot]
        while listed[line[-1]] and (parent := listed[line[-1]][0].parent):
            line.append(parent)
        found: Parts = defaultdict(list)
        for name in reversed(line):
            for row in listed[name]:
                if row.table_name is not None:
                    found[row.table_name].append(row.location)
        return dict(found)

    def locations(self, snapshot: str, table: str) -> list[str]:
        """The folders of a table, one per load, as external tables need them."""
        return self.parts(snapshot)[table]

    def read(self, table: str, fields: Fields, snapshot: str | None = None) -> DataFrame:
        """A published table under its declared schema."""
        places = self.parts(snapshot or self.latest())[table]
        return self.spark.read.format(self.fmt).schema(ddl(fields)).load(places)

    def read_evolving(self, table: str, fields: Fields, snapshot: str | None = None) -> DataFrame:
        """A published table with the columns that some of its loads added, null for the others."""
        places = self.parts(snapshot or self.latest())[table]
        found = self.spark.read.format(self.fmt).option("mergeSchema", "true").load(places)
        declared = [
            (F.col(name) if name in found.columns else F.lit(None)).cast(kind).alias(name) for name, kind in fields
        ]
        known = {name for name, _ in fields}
        return found.select(*declared, *[c for c in found.columns if c not in known])
