"""Reading the source tables and passing rows through Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 4_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, whatever the batches of the session hold."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, rows * most // max(batch.nbytes, 1)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def through(
    frame: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``work`` over the batches of every task; its input comes in bounded slices."""
    return frame.mapInArrow(lambda batches: work(slices(batches)), schema)


def set_aside(docs: DataFrame, used: Sequence[str]) -> DataFrame:
    """``used`` columns and all others in one, so that no name clashes with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*others or [F.lit(None).cast("int").alias("_none")]).alias("_rest"))


def restore(frame: DataFrame, columns: Sequence[str], used: Sequence[str]) -> DataFrame:
    """The columns that ``set_aside`` was given, in their order."""
    return frame.select(*[
        F.col(f"`{c}`") if c in used else F.col("_rest").getField(c).alias(c) for c in columns
    ])


def ddl(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
