"""Ordered operations per key that stay parallel when one key holds most rows.

A window sends each key to one task. That is right for ordinary keys, so it is
what ordinary keys get. Keys with more rows than a task should order are cut
into slices of the (key, order) range instead: the operation runs per slice,
and what crosses a slice border comes from a table with at most two rows per
slice. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

SLICE = "_slice"
PLACE = "_place"


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for mine, theirs in pairs:
        condition = condition & left[mine].eqNullSafe(right[theirs])
    return condition


def slice_by_order(
    frame: DataFrame, order: Sequence[str], slices: int, scratch: Scratch, label: str
) -> DataFrame:
    """Store ``frame`` cut into ordered slices, with each row's place in its slice.

    Slice numbers ascend with the order. They are written, not recomputed, so a
    lost executor cannot shift rows between slices.
    """
    cut = frame.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    place_mask = F.lit((1 << 33) - 1)
    return scratch.stage(
        cut.withColumns({
            SLICE: F.spark_partition_id(),
            PLACE: F.monotonically_increasing_id().bitwiseAND(place_mask),
        }),
        label,
    )


@dataclass(frozen=True)
class Part:
    frame: DataFrame
    sliced: bool


@dataclass(frozen=True)
class Sequenced:
    """Rows arranged per key in a total order, in plain and sliced parts."""

    parts: tuple[Part, ...]
    keys: tuple[str, ...]
    order: tuple[str, ...]
    scratch: Scratch

    @property
    def frame(self) -> DataFrame:
        plain = [p.frame.drop(SLICE, PLACE) for p in self.parts]
        whole = plain[0]
        for more in plain[1:]:
            whole = whole.unionByName(more)
        return whole

    def _over(self, change: Callable[[Part], DataFrame]) -> Sequenced:
        return replace(self, parts=tuple(replace(p, frame=change(p)) for p in self.parts))

    def where(self, condition: Column | str) -> Sequenced:
        """Keep some rows. Slices stay valid, because their ranges do not change."""
        return self._over(lambda part: part.frame.filter(condition))

    def with_columns(self, columns: Mapping[str, Column]) -> Sequenced:
        return self._over(lambda part: part.frame.withColumns(dict(columns)))

    def stored(self, label: str) -> Sequenced:
        """Write the sliced part, so that later passes do not repeat earlier ones."""
        return self._over(
            lambda part: self.scratch.stage(part.frame, label) if part.sliced else part.frame
        )

    # -- operations ----------------------------------------------------------

    def previous(self, columns: Mapping[str, str], present: str | None = None) -> Sequenced:
        """Values of the row before; ``present`` tells a missing row from a null value."""
        return self._neighbour(columns, present, back=True)

    def following(self, columns: Mapping[str, str], present: str | None = None) -> Sequenced:
        return self._neighbour(columns, present, back=False)

    def position(self, name: str) -> Sequenced:
        """1-based row number within the key."""

        def number(part: Part) -> DataFrame:
            local = F.row_number().over(self._window(part))
            if not part.sliced:
                return part.frame.withColumn(name, local.cast("long"))
            before = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(
                Window.unboundedPreceding, -1
            )
            runs = self._border_runs(part.frame, {"_rows": F.count(F.lit(1))})
            runs = runs.withColumn("_before", F.sum("_rows").over(before)).drop("_rows")
            joined = self._attach(part.frame.withColumn(name, local), runs, ["_before"])
            total = F.coalesce(F.col("_before"), F.lit(0)) + F.col(name)
            return joined.withColumn(name, total.cast("long")).drop("_before")

        return self._over(number)

    def carry_forward(self, columns: Mapping[str, str]) -> Sequenced:
        """The latest non-null value at or before each row."""

        def fill(part: Part) -> DataFrame:
            window = self._window(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            local = {out: F.last(source, ignorenulls=True).over(window)
                     for out, source in columns.items()}
            if not part.sliced:
                return part.frame.withColumns(local)
            last_known = {
                f"_in_{out}": F.max_by(source, F.when(F.col(source).isNotNull(), F.col(PLACE)))
                for out, source in columns.items()
            }
            runs = self._border_runs(part.frame, last_known)
            before = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(
                Window.unboundedPreceding, -1
            )
            runs = runs.withColumns(
                {name: F.last(name, ignorenulls=True).over(before) for name in last_known}
            )
            joined = self._attach(part.frame.withColumns(local), runs, list(last_known))
            return joined.withColumns(
                {out: F.coalesce(F.col(out), F.col(f"_in_{out}")) for out in columns}
            ).drop(*last_known)

        return self._over(fill)

    def running_total(self, columns: Mapping[str, str]) -> Sequenced:
        """Sums of the rows of the key up to and including each row; null counts as nothing.

        Sums are those of the source type, so whole numbers and decimals are exact across slices.
        """

        def total(part: Part) -> DataFrame:
            window = self._window(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            local = {out: F.sum(source).over(window) for out, source in columns.items()}
            if not part.sliced:
                return part.frame.withColumns(local)
            runs = self._border_runs(
                part.frame, {f"_in_{out}": F.sum(source) for out, source in columns.items()}
            )
            before = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(
                Window.unboundedPreceding, -1
            )
            runs = runs.withColumns({f"_in_{out}": F.sum(f"_in_{out}").over(before) for out in columns})
            joined = self._attach(part.frame.withColumns(local), runs, [f"_in_{out}" for out in columns])
            sums = {
                out: F.when(F.col(f"_in_{out}").isNull(), F.col(out)).otherwise(
                    F.col(f"_in_{out}") + F.coalesce(F.col(out), F.lit(0)))
                for out in columns
            }
            return joined.withColumns(sums).drop(*[f"_in_{out}" for out in columns])

        return self._over(total)

    def smallest(
        self, columns: Mapping[str, str], within: str | None = None, only: str | None = None
    ) -> Sequenced:
        """The smallest value of some columns in the key of each row, or in its run.

        ``within`` names a column that tells the runs of a key and must not be null; with ``only`` just the rows it
        tells are returned. Ordinary keys need no other shuffle; of hot keys the values are reduced per slice
        and run first.
        """
        group = [*self.keys, *([within] if within else [])]

        def least(part: Part) -> DataFrame:
            if not part.sliced:
                # the rows of a key keep the order that other steps ask for
                whole = Window.partitionBy(*group) if within else self._window(part).rowsBetween(
                    Window.unboundedPreceding, Window.unboundedFollowing
                )
                found = part.frame.withColumns({
                    out: F.min(source).over(whole) for out, source in columns.items()
                })
                return found.filter(only) if only else found
            some = reduce(lambda a, b: a | b, [F.col(source).isNotNull() for source in columns.values()])
            reduced = part.frame.filter(some).groupBy(*[F.col(c).alias(f"_of_{c}") for c in group]).agg(
                *[F.min(source).alias(out) for out, source in columns.items()]
            )
            found = part.frame.filter(only) if only else part.frame
            same = _same(found, reduced, [(c, f"_of_{c}") for c in group])
            return found.join(reduced, same, "left").drop(*[f"_of_{c}" for c in group])

        return self._over(least)

    def openers(self, opens: str, run: str, in_run: Mapping[str, str], in_key: Mapping[str, str]) -> Sequenced:
        """Only the rows that open a run, with the smallest values of some columns in their run and in their key."""
        return self.smallest(in_key).smallest(in_run, within=run, only=opens)

    # -- inner steps ---------------------------------------------------------

    def _window(self, part: Part):
        """The rows of a key in order; within a slice their places give the order."""
        if part.sliced:
            return Window.partitionBy(SLICE, *self.keys).orderBy(PLACE)
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def _neighbour(self, columns, present, back: bool) -> Sequenced:
        step = F.lag if back else F.lead
        edge_row = F.max_by if back else F.min_by
        values = F.struct(*[F.col(source).alias(out) for out, source in columns.items()])

        def look(part: Part) -> DataFrame:
            found = part.frame.withColumn("_near", step(values).over(self._window(part)))
            if part.sliced:
                edge = edge_row(values, PLACE)
                runs = self._border_runs(part.frame, {"_edge": edge})
                across = Window.partitionBy(*self.keys).orderBy(SLICE)
                runs = runs.withColumn("_edge", step("_edge").over(across))
                found = self._attach(found, runs, ["_edge"])
                found = found.withColumn("_near", F.coalesce("_near", "_edge")).drop("_edge")
            new = {out: F.col("_near").getField(out) for out in columns}
            if present:
                new[present] = F.col("_near").isNotNull()
            return found.withColumns(new).drop("_near")

        return self._over(look)

    def _border_runs(self, frame: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
        """One row per slice and key for the first and last key of each slice.

        Only these keys can continue in another slice.
        """
        key = F.struct(*self.keys)
        ends = frame.groupBy(SLICE).agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
        outer = frame.join(F.broadcast(ends), SLICE).filter(
            key.eqNullSafe(F.col("_low")) | key.eqNullSafe(F.col("_high"))
        )
        return outer.groupBy(SLICE, *self.keys).agg(
            *[column.alias(name) for name, column in aggregates.items()]
        )

    def _attach(self, frame: DataFrame, runs: DataFrame, values: list[str]) -> DataFrame:
        """Join the border table, which has at most two rows per slice."""
        renamed = runs.select(
            F.col(SLICE).alias("_run_slice"),
            *[F.col(k).alias(f"_run_{k}") for k in self.keys],
            *values,
        )
        pairs = [(SLICE, "_run_slice"), *[(k, f"_run_{k}") for k in self.keys]]
        joined = frame.join(F.broadcast(renamed), _same(frame, renamed, pairs), "left")
        return joined.drop(*[theirs for _, theirs in pairs])


def arrange(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    sizing: Sizing | None = None,
    key_rows: int | None = None,
) -> Sequenced:
    """Arrange ``frame`` per key.

    ``order`` must be total within a key. ``rows`` is an upper bound of the row
    count where the caller knows one, ``key_rows`` one of the rows of any key. When
    the whole frame or every key fits one task no key can be hot and nothing is
    measured; else the frame is stored, so that what leads to it runs once.
    """
    sizing = sizing or Sizing()
    keys, order = tuple(keys), tuple(order)

    def sequenced(*parts: Part) -> Sequenced:
        return Sequenced(parts, keys, order, scratch)

    if min(n for n in (rows, key_rows, sizing.single_task_rows + 1) if n is not None) <= sizing.single_task_rows:
        return sequenced(Part(frame, sliced=False))
    frame = scratch.stage(frame, "unmeasured")
    if frame.count() <= sizing.single_task_rows:  # from the footers
        return sequenced(Part(frame, sliced=False))

    counted = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counted.filter(F.col("_rows") > sizing.single_task_rows)
    hot = scratch.stage(hot, "hot-keys")
    in_hot = hot.agg(F.sum("_rows")).first()[0]
    if in_hot is None:
        return sequenced(Part(frame, sliced=False))

    marked = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    match = _same(frame, marked, [(k, f"_hot_{k}") for k in keys])
    # the stored table of hot keys is broadcast if its size allows, else joined by shuffles
    usual = frame.join(marked, match, "left_anti")
    heavy = slice_by_order(
        frame.join(marked, match, "left_semi"),
        [*keys, *order],
        max(2, sizing.partitions(in_hot)),
        scratch,
        "hot-rows",
    )
    return sequenced(Part(usual, sliced=False), Part(heavy, sliced=True))
