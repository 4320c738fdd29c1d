"""Drop repeated deliveries from a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANE, APART = "_lane", "_apart"


def drop_repeats(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, lanes: int = 16
) -> DataFrame:
    """The first record of each key; state is dropped ``delay`` behind the newest event.

    A record repeated very often would send all its copies to one task. So the
    copies are first reduced within ``lanes`` lanes, which follow the input
    partitions, and only one survivor per lane meets the others. A record with a null key is
    a copy of no other; it gets a mark of its own.
    """
    lane = F.pmod(F.spark_partition_id(), F.lit(lanes))
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        stream.withWatermark(event_time, delay)
        .withColumns({LANE: lane, APART: F.when(unknown, F.expr("uuid()"))})
        .dropDuplicatesWithinWatermark([*keys, APART, LANE])
        .drop(LANE)
        .dropDuplicatesWithinWatermark([*keys, APART])
        .drop(APART)
    )
