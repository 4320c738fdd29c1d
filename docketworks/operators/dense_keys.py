"""Gap-free surrogate keys 1..n in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketworks.operators.sequence import PLACE, SLICE, slice_by_order
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch


def add_dense_key(
    frame: DataFrame,
    name: str,
    order: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    start: int = 0,
    sizing: Sizing | None = None,
    keep: bool = False,
) -> DataFrame:
    """Number the rows by ``order`` (total, nulls first), counting on from ``start``.

    A frame that fits one task is numbered by a plain window. A larger one is
    cut into ordered slices; its number is the place in the slice plus the rows
    of all earlier slices. ``rows`` is an upper bound that should be near the
    true count; without one the frame is stored and counted. ``keep`` stores a small frame too, for callers
    that read the result more than once.
    """
    sizing = sizing or Sizing()
    if rows is None:
        frame = scratch.stage(frame, f"unnumbered-{name}")
        rows = frame.count()
    if rows <= sizing.numbering_rows:
        number = F.row_number().over(Window.orderBy(*order))
        numbered = frame.withColumn(name, number.cast("long") + start)
        return scratch.stage(numbered, f"numbered-{name}") if keep else numbered

    cut = slice_by_order(
        frame, order, sizing.numbering_slices(rows), scratch, f"sliced-{name}"
    )
    sizes = cut.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per slice, bounded by Sizing.max_partitions
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        SLICE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.col("_before") + F.col(PLACE) + 1 + start
    return (
        cut.join(F.broadcast(offsets), SLICE)
        .withColumn(name, number.cast("long"))
        .drop(SLICE, PLACE, "_before")
    )
