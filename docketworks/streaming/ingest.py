"""Hub to bronze: a stateless append stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from docketworks.sources.hub import to_bronze

TRIGGER = "30 seconds"
WIDTH = "spark.sql.shuffle.partitions"


def _paced(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A processing-time trigger, or everything there is and then stop."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def append_stream(
    stream: DataFrame, target: str, checkpoint: str, every: str | None = TRIGGER,
    fmt: str = "parquet", partitions: int = 0,
) -> StreamingQuery:
    """Append a stream to files; the checkpoint makes restarts continue exactly.

    A stateful stream keeps the number of partitions it starts with, and
    adaptive execution does not change it, so ``partitions`` can raise it here.
    """
    writer = stream.writeStream.format(fmt).outputMode("append")
    writer = _paced(writer.option("checkpointLocation", checkpoint), every)
    conf = stream.sparkSession.conf
    usual = conf.get(WIDTH)
    conf.set(WIDTH, str(max(partitions, int(usual))))
    try:
        return writer.start(target)  # the query takes a copy of the settings
    finally:
        conf.set(WIDTH, usual)


def start_ingest(
    records: DataFrame, target: str, checkpoint: str, every: str | None = TRIGGER,
    fmt: str = "parquet", ingested_at=None,
) -> StreamingQuery:
    return append_stream(to_bronze(records, ingested_at), target, checkpoint, every, fmt)


def start_monitor(records: DataFrame, every: str | None = TRIGGER) -> StreamingQuery:
    """Print the arriving records to the console, beside the ingest."""
    writer = to_bronze(records).writeStream.format("console").outputMode("append")
    return _paced(writer.option("truncate", "false"), every).start()


def wait(query: StreamingQuery, seconds: int | None = None) -> bool:
    """Block until the query stops; with a limit, tell whether it did."""
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))
