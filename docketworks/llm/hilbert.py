"""Shards cut from a Hilbert curve through the metadata of documents.

Several dimensions are quantised to a few bits each; the place of a row on the Hilbert curve
through that grid is its sort key. Neighbours on the curve are neighbours in every
dimension, so a run of the curve covers a small box of the grid and the minima and maxima of a file
prune on all dimensions at once. Columns and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.operators.dense_keys import add_dense_key
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

SHARDS = 24
BITS = 6
NUMBERING_ROWS = 40_000


def of_category(column: str, bits: int = BITS) -> Column:
    """A cell for a value without an order; null is a value of its own."""
    text = F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))
    return F.shiftright(F.crc32(text.cast("binary")), 32 - bits)


def of_size(size: Column, bits: int = BITS) -> Column:
    """Four cells for each doubling of a size, without floating point."""
    width = F.length(F.bin(size)).cast("long")  # bits of the number
    top = F.call_function("shiftright", F.call_function("shiftleft", size, F.lit(2)),
                          (width - 1).cast("int"))  # its leading bit and the two below
    return F.least(width * 4 + top - 8, F.lit((1 << bits) - 1).cast("long"))


def with_curve(frame: DataFrame, cells: Mapping[str, Column], bits: int, name: str) -> DataFrame:
    """Add ``name``, the place of the cell on the Hilbert curve of ``len(cells)`` dimensions.

    The axes are turned and reflected bit by bit, from the highest (Skilling 2004); each step
    is a projection of its own, so that no expression is written out twice.
    """
    kept = frame.columns
    axes = [f"_axis_{i}" for i in range(len(cells))]
    frame = frame.select("*", *[cell.cast("long").alias(a) for a, cell in zip(axes, cells.values())])

    def step(frame: DataFrame, changes: dict[str, Column]) -> DataFrame:
        return frame.withColumns(changes)

    first = F.col(axes[0])
    for bit in range(bits - 1, 0, -1):
        low = F.lit((1 << bit) - 1).cast("long")
        for i, axis in enumerate(axes):
            here = F.col(axis)
            hit = F.shiftright(here, bit).bitwiseAND(F.lit(1)) == 1
            if i == 0:
                frame = step(frame, {axis: F.when(hit, here.bitwiseXOR(low)).otherwise(here)})
                continue
            swap = first.bitwiseXOR(here).bitwiseAND(low)
            frame = step(frame, {
                axes[0]: F.when(hit, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap)),
                axis: F.when(hit, here).otherwise(here.bitwiseXOR(swap)),
            })
    for before, axis in zip(axes, axes[1:]):
        frame = step(frame, {axis: F.col(axis).bitwiseXOR(F.col(before))})
    turned = F.lit(0).cast("long")
    for bit in range(bits - 1, 0, -1):
        hit = F.shiftright(F.col(axes[-1]), bit).bitwiseAND(F.lit(1)) == 1
        turned = turned.bitwiseXOR(F.when(hit, F.lit((1 << bit) - 1)).otherwise(F.lit(0)).cast("long"))
    frame = step(frame, {"_turned": turned})
    frame = step(frame, {a: F.col(a).bitwiseXOR(F.col("_turned")) for a in axes})
    place = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for i, axis in enumerate(axes):
            at = bit * len(axes) + len(axes) - 1 - i
            place = place + F.shiftleft(F.shiftright(F.col(axis), bit).bitwiseAND(F.lit(1)), at)
    return frame.select(*kept, place.alias(name))


def shard(
    docs: DataFrame, scratch: Scratch, shards: int = SHARDS, categories: Sequence[str] = ("lang", "source"),
    keep: Sequence[str] = (), bits: int = BITS, sizing: Sizing | None = None,
) -> DataFrame:
    """Cut ``docs`` (doc_id, text and ``categories``) into runs of the curve with equal row counts.

    Columns: ``doc_id``, ``size`` (bytes of the text plus 8; a null text has none),
    ``text_crc32``, ``curve``, ``shard`` (0 to ``shards`` - 1, counts at most one apart) and ``slot``
    (0 upwards in each shard), then the columns named by ``keep``. Rows of one cell are ordered by
    doc_id (null first), size and checksum, so a cell that holds a third of all rows is cut
    like any other stretch, and rows equal in all of that may swap places. Shards are empty if there
    are fewer rows than shards; an empty table has none.
    """
    text = F.coalesce("text", F.lit(""))
    source = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"_category_{i}") for i, c in enumerate(categories)],
        *keep,
    )
    cells = {c: of_category(f"_category_{i}", bits) for i, c in enumerate(categories)}
    placed = with_curve(source, {**cells, "size": of_size(F.col("size"), bits)}, bits, "curve")
    placed = placed.drop(*[f"_category_{i}" for i in range(len(categories))])
    rows = docs.count()  # from the footers of the files
    numbered = add_dense_key(
        placed, "_number", ["curve", "doc_id", "size", "text_crc32"], scratch, rows=rows,
        sizing=sizing or Sizing(numbering_rows=NUMBERING_ROWS),
    )
    place = F.col("_number") - 1
    cut = F.call_function("div", place * shards, F.lit(max(rows, 1)))
    first = F.call_function("div", F.col("shard") * rows + (shards - 1), F.lit(shards))
    return numbered.withColumn("shard", cut.cast("int")).withColumn("slot", place - first).select(
        "doc_id", "size", "text_crc32", "curve", "shard", "slot", *keep
    )
