"""Version chains that late events change, and what the change means for rows that point to them.

A chain is the versions of one key in order of their position: the time of the event that opened a version and
tie columns that make the order total. A batch in any order only touches the end of a chain from
its earliest event on, so only that tail is read and built anew. Versions, stored rows and new rows lie on one
time line, so that the versions before and after are known of each row without another one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.operators.dense_keys import add_dense_key
from docketworks.operators.scd2 import CURRENT, EFFECTIVE, END, VERSION
from docketworks.operators.sequence import arrange
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

#: What a row of a time line is. At one position a stored version comes before the rows that point to it.
_KIND = "_kind"
_VERSION, _STORED_ROW, _NEW_ROW = 0, 1, 2
#: The keys of a batch of so many rows are sent to every task that reads stored rows.
_FEW = 10_000


class Tail(NamedTuple):
    """The tails of the touched chains before and after a batch.

    ``after`` has the stored columns of a version that was there before as ``_stored``, and tells by ``_changed`` which
    versions are new or differ from it. ``line`` has the rows between the versions, and ``created`` the new
    versions with the row that opens each.
    """

    before: DataFrame
    after: DataFrame
    line: DataFrame | None = None
    created: DataFrame | None = None


def merge_tail(
    stored: DataFrame,
    rows: DataFrame,
    batch: DataFrame,
    row: str,
    surrogate: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    ties: Sequence[str],
    scratch: Scratch,
    start: int,
    bound: int | None = None,
    sizing: Sizing | None = None,
    key_rows: int | None = None,
    load: str | None = None,
) -> Tail:
    """Tails of the chains that ``batch`` (row, keys, tracked, time, ties) touches.

    ``stored`` holds all versions with their tie columns, ``rows`` the rows merged so far (row, keys,
    time, ties, surrogate), each pointing to its version; they stand for the events. ``row`` numbers the rows of both. A
    version keeps its surrogate key wherever its opening event ends up; new ones are numbered on from
    ``start``. Events are never taken back, so two versions never become one. ``time`` and ``keys`` must not be
    null; equal events count once. ``key_rows`` limits the rows of one key on the time line. Where ``rows`` have a
    ``load``, a row may be there several times with one surrogate per load, and the latest counts. The result of any
    order of batches is the history of all events.
    """
    extra = [t for t in ties if t not in tracked]
    told = [c for c in stored.columns if c not in {surrogate, EFFECTIVE, *keys, *tracked, *extra}]
    count, first = batch.agg(F.count(F.lit(1)), F.min(time).cast("string")).first()
    earliest = F.lit(first).cast("timestamp")
    # closed versions that ended before any event of the batch are skipped by their files' statistics
    recent = stored.filter(F.col(END).isNull() | (F.col(END) >= earliest))
    later = rows.filter(F.col(time) >= earliest)
    if count <= _FEW:
        mentioned = F.broadcast(scratch.stage(batch.select(*keys).distinct(), "touched-keys"))
        recent, later = (frame.join(mentioned, [*keys], "left_semi") for frame in (recent, later))

    def kind(value: int) -> Column:
        return F.lit(value).alias(_KIND)

    is_version, is_stored = F.col(_KIND) == _VERSION, F.col(_KIND) == _STORED_ROW
    line = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        recent.select(
            *keys, *tracked, F.col(EFFECTIVE).alias(time), *extra, kind(_VERSION), F.col(surrogate).alias("_was"),
            F.struct(surrogate, *told).alias("_version"),
        ),
        later.select(
            row, *keys, time, *extra, kind(_STORED_ROW), F.col(surrogate).alias("_was"),
            F.col(load).alias("_load") if load else F.lit(0).alias("_load"),
        ),
        batch.select(row, *keys, *tracked, time, *extra, kind(_NEW_ROW)),
    ])
    order = [time, *extra, _KIND, row, "_load", "_was"]
    line = arrange(line, keys, order, scratch, bound, sizing, key_rows)

    # only keys of the batch, from its first event of each on
    line = line.with_columns({"_begins": F.when(F.col(_KIND) == _NEW_ROW, F.col(time))}).smallest({"_from": "_begins"})
    ended = F.col(f"_version.{END}")
    line = line.where(F.when(is_version, ended.isNull() | (ended >= F.col("_from"))).otherwise(
        F.col(time) >= F.col("_from")) & F.col("_from").isNotNull()).stored("tail-touched")
    # of the states of a row, which are neighbours, the last is in force
    line = line.following({"_next_row": row}).where(
        ~(is_stored & F.col(row).eqNullSafe(F.col("_next_row")))).stored("tail-in-force")
    # a stored row has the values of the version that it lies in
    line = line.with_columns({
        "_mine": F.when(is_version, F.struct(*tracked)), "_nth": F.when(is_version, F.col(f"_version.{VERSION}")),
    }).carry_forward({"_known": "_mine"})
    line = line.with_columns({
        c: F.when(is_stored, F.col("_known").getField(c)).otherwise(F.col(c)) for c in tracked
    }).smallest({"_base": "_nth"}).stored("tail-known")

    # equal events are neighbours, so only the first can open a version; a stored version comes before its events
    # and lies in the run of the version that it becomes
    line = line.previous({f"_was_{c}": c for c in tracked}, present="_seen")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in tracked])
    line = line.with_columns({"_opens": ~F.col("_seen") | differs}).stored("tail-opened")
    line = line.with_columns({"_one": F.col("_opens").cast("long")}).running_total({"_run": "_one"})
    line = line.following({"_next": time, "_next_opens": "_opens"}).with_columns({
        "_until": F.when(F.col("_next_opens"), F.col("_next")), "_back": -F.col(row),
    }).stored("tail-runs")
    line = line.smallest(
        {"_owner": "_version", "_first_row": row, "_last_back": "_back", END: "_until"}, within="_run"
    )

    opens = F.col("_opens")
    shown = [*keys, *tracked, *extra]
    placed = scratch.stage(line.frame.select(
        row, _KIND, time, "_was", "_opens", "_first_row", F.col(f"_owner.{surrogate}").alias("_now"), "_version",
        (F.col("_first_row") + F.col("_last_back") != 0).alias("_several"),
        F.when(opens, F.col("_owner")).alias("_stored"), F.when(opens, F.col(END)).alias(END),
        F.when(opens, F.coalesce("_base", F.lit(1)) + F.col("_run") - 1).cast("int").alias(VERSION),
        *[F.when(opens | is_version, F.col(c)).alias(c) for c in shown],
    ), "tail-placed")
    before = placed.filter(is_version).select(
        F.col("_was").alias(surrogate), *shown, F.col(time).alias(EFFECTIVE), *[f"_version.{c}" for c in told]
    )
    built = placed.filter(opens).select(
        F.col("_now").alias(surrogate), *keys, *tracked, F.col(time).alias(EFFECTIVE), END,
        F.col(END).isNull().alias(CURRENT), VERSION, *extra, "_stored", row, _KIND, "_was", "_first_row",
        "_several",
    )
    created = add_dense_key(
        built.filter(F.col(surrogate).isNull()).drop(surrogate, "_stored"), surrogate, [*keys, VERSION], scratch,
        rows=bound, start=start, sizing=sizing, keep=True,
    )
    about = [row, _KIND, "_was", "_first_row", "_several"]
    # a version that still opens itself begins where it began
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_stored.{c}")) for c in (END, CURRENT, VERSION)])
    after = built.filter(F.col(surrogate).isNotNull()).withColumn("_changed", ~(is_version & same)).drop(*about)
    after = after.unionByName(created.withColumn("_changed", F.lit(True)).drop(*about), allowMissingColumns=True)
    of_rows = placed.filter(~is_version).select(row, _KIND, time, "_was", "_now", "_opens", "_first_row")
    return Tail(before, after, of_rows, created.select(
        row, _KIND, F.col(EFFECTIVE).alias(time), "_was", F.col(surrogate).alias("_now"), "_first_row",
        "_several",
    ))


def position(time: str, ties: Sequence[str]) -> Column:
    """Place of an event in the order of its key, as one value."""
    return F.struct(F.col(time).alias("time"), *[F.col(t).alias(f"tie_{i}") for i, t in enumerate(ties)])


def intervals(
    tail: Tail, surrogate: str, keys: Sequence[str], ties: Sequence[str], scratch: Scratch,
    bound: int | None = None, sizing: Sizing | None = None, key_rows: int | None = None,
) -> DataFrame:
    """The touched chains as stretches: keys, ``begins`` (a position), ``was`` and ``now`` (surrogate keys).

    Each stretch lasts until the next one of its key begins. The chains differ where ``was`` and
    ``now`` do; ``was`` is null before the first stored version. A tail that has its rows gives instead each row with
    the stretch that it lies in: row, time, ``was`` and ``now``; ``was`` is null of the rows of the batch.
    """
    if tail.line is not None:
        known, fresh = (tail.line.filter(F.col("_now").isNull() == new) for new in (False, True))
        told = [c for c in tail.line.columns if c not in ("_now", "_opens", "_first_row")]
        # a row that opens a new version is at hand there; the others of its run look it up
        runs = tail.created.filter("_several").select("_first_row", "_now")
        others = fresh.filter("NOT _opens").drop("_now").join(runs, "_first_row")
        return reduce(DataFrame.unionByName, [
            found.select(*told, "_now") for found in (known, tail.created, others)
        ]).withColumnsRenamed({"_was": "was", "_now": "now"})

    def edges(chain: DataFrame, name: str) -> DataFrame:
        return chain.select(*keys, position(EFFECTIVE, ties).alias("begins"), F.col(surrogate).alias(name))

    both = edges(tail.before, "_was").unionByName(edges(tail.after, "_now"), allowMissingColumns=True)
    line = arrange(both, keys, ["begins", "_was", "_now"], scratch, bound, sizing, key_rows)
    line = line.carry_forward({"was": "_was", "now": "_now"}).following({"_next": "begins"}, present="_more")
    # of the edges at one position the last knows both chains
    return line.where("NOT _more OR _next <> begins").frame.select(*keys, "begins", "was", "now")


def moved_rows(stretches: DataFrame) -> DataFrame:
    """The stored rows inside stretches that changed, with ``was`` and ``now``; no other row is returned."""
    return stretches.filter((F.col(_KIND) == _STORED_ROW) & (F.col("was") != F.col("now"))).drop(_KIND)


def versions_of(stretches: DataFrame, row: str, surrogate: str) -> DataFrame:
    """The rows of the batch with the surrogate key of the version in force at their position."""
    return stretches.filter(F.col(_KIND) == _NEW_ROW).select(row, F.col("now").alias(surrogate))
