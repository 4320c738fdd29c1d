"""Rows that a stream dropped because they came behind its watermark."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Counts late rows of every micro-batch while it is open, not only of those Spark still remembers.

    ``by_batch`` holds the batches that had any, by query and number.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.by_batch: dict[tuple[str, int], int] = {}
        self._seen: dict[str, int] = {}

    @property
    def total(self) -> int:
        return sum(self.by_batch.values())

    def __enter__(self) -> LateRows:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        if dropped:
            self.by_batch[str(progress.id), progress.batchId] = dropped
        self._seen[str(progress.id)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 10) -> None:
        """Until the last batch of ``query`` was told; progress is told after the batch has ended."""
        last, end = query.lastProgress, time.monotonic() + seconds
        while last and self._seen.get(str(query.id), -1) < last["batchId"] and time.monotonic() < end:
            time.sleep(0.05)
