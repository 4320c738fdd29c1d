"""Slowly changing dimensions with full history (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketworks.operators.dense_keys import add_dense_key
from docketworks.operators.sequence import Sequenced, arrange
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch

EFFECTIVE, END, CURRENT, VERSION = (
    "record_effective_date", "record_end_date", "is_current", "record_version",
)


def _differs(tracked: Sequence[str]) -> Column:
    """Some tracked column changed; null and null are the same value."""
    tests = [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in tracked]
    return reduce(lambda a, b: a | b, tests)


def changes_only(sequence: Sequenced, tracked: Sequence[str]) -> Sequenced:
    """Add the row before as ``_was_*`` and ``_seen``; keep first rows and real changes."""
    compared = sequence.previous({f"_was_{c}": c for c in tracked}, present="_seen")
    return compared.where(~F.col("_seen") | _differs(tracked))


def history(
    events: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    ties: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    sizing: Sizing | None = None,
    with_ties: bool = False,
) -> DataFrame:
    """All versions of each key from its events.

    An event opens a version when a tracked column differs from the event
    before. A version ends where the next one begins. ``with_ties`` keeps the tie
    columns of the opening event, as ``merge_log`` needs them.
    """
    needed = list(dict.fromkeys([*keys, *tracked, time, *ties]))
    sequence = arrange(events.select(*needed), keys, [time, *ties], scratch, rows, sizing)
    versions = changes_only(sequence, tracked).stored("versions")
    versions = versions.position(VERSION).following({END: time}, present="_followed")
    return versions.frame.select(
        *keys,
        *tracked,
        F.col(time).alias(EFFECTIVE),
        END,
        (~F.col("_followed")).alias(CURRENT),
        F.col(VERSION).cast("int").alias(VERSION),
        *(ties if with_ties else ()),
    )


def merge_log(
    stored: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    surrogate: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    ties: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    sizing: Sizing | None = None,
) -> DataFrame:
    """The dimension after a batch in any order: late, tied and repeated events included.

    ``log`` holds the events merged so far and ``stored`` their versions with tie columns.
    The keys of the batch are built anew from all their events, so the result is the
    ``history`` of everything. A stored version keeps its surrogate key, also when a late event
    moves its beginning: it lies in the run of equal events that it opened or joined. Events are never
    taken back, so two stored versions never fall into one run. Other keys pass unchanged.
    """
    needed = list(dict.fromkeys([*keys, *tracked, time, *ties]))
    mentioned = batch.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    mentioned = scratch.stage(mentioned, "mentioned")

    def same(frame: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [frame[k].eqNullSafe(mentioned[f"_key_{k}"]) for k in keys])

    earlier = log.select(*needed).join(mentioned, same(log), "left_semi")
    events = earlier.unionByName(batch.select(*needed)).distinct()
    marks = stored.join(mentioned, same(stored), "left_semi").select(
        *keys, *tracked, F.col(EFFECTIVE).alias(time), *ties, surrogate
    )
    line = events.unionByName(marks, allowMissingColumns=True)
    placed = arrange(line, keys, [time, *ties, surrogate], scratch, rows, sizing).previous(
        {f"_was_{c}": c for c in tracked}, present="_seen"
    ).with_columns({"_opens": ~F.col("_seen") | _differs(tracked)}).position("_place")
    placed = placed.with_columns({"_mark": F.when(F.col("_opens"), F.col("_place"))})
    placed = placed.carry_forward({"_run": "_mark"}).stored("placed")
    owned = scratch.stage(placed.frame.filter(F.col(surrogate).isNotNull()).groupBy(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_run").alias("_key_run")
    ).agg(F.min(surrogate).alias("_owner")), "owners")
    versions = placed.where("_opens").position(VERSION).following({END: time}, present="_followed")
    built = versions.frame.drop(surrogate)
    match = reduce(
        lambda a, b: a & b, [built[k].eqNullSafe(owned[f"_key_{k}"]) for k in keys],
        built["_run"] == owned["_key_run"],
    )
    built = scratch.stage(built.join(owned, match, "left").select(
        F.col("_owner").alias(surrogate), *keys, *tracked, F.col(time).alias(EFFECTIVE), END,
        (~F.col("_followed")).alias(CURRENT), F.col(VERSION).cast("int").alias(VERSION), *ties,
    ), "versions")
    created = add_dense_key(
        built.filter(F.col(surrogate).isNull()).drop(surrogate), surrogate, [*keys, VERSION], scratch,
        rows=rows, start=stored.agg(F.max(surrogate)).first()[0] or 0, sizing=sizing,
    )
    columns = built.columns
    return (
        stored.join(mentioned, same(stored), "left_anti").select(*columns)
        .unionByName(built.filter(F.col(surrogate).isNotNull()))
        .unionByName(created.select(*columns))
    )


def merge(
    stored: DataFrame,
    batch: DataFrame,
    surrogate: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    ties: Sequence[str],
    scratch: Scratch,
    rows: int | None = None,
    sizing: Sizing | None = None,
) -> DataFrame:
    """The dimension after a batch of events, with stable surrogate keys.

    For batches that follow what was merged before, or new facts about closed spans; a late
    event against a version that later events confirmed, or a repeated batch with several
    events of one instant, needs ``merge_log``. A key may change several times in one batch. Versions that ended before the
    batch begins pass through without a join. Stored versions are never
    removed, also when a late event falls among them, so facts keep their keys;
    new versions are numbered on from the largest stored key. Keys that the
    batch does not mention stay open.
    """
    # as text, because a Python datetime would follow the driver's own time zone
    begin = batch.agg(F.min(time).cast("string")).first()[0]
    if begin is None:
        return stored
    begins = F.lit(begin).cast(batch.schema[time].dataType)
    settled = ~F.col(CURRENT) & (F.col(END) <= begins)
    passed = stored.filter(settled)

    spans = batch.groupBy(*keys).agg(F.min(time).alias("_from"))
    spans = spans.select(*[F.col(k).alias(f"_span_{k}") for k in keys], "_from")
    active = stored.filter(~settled)
    match = reduce(
        lambda a, b: a & b, [active[k].eqNullSafe(spans[f"_span_{k}"]) for k in keys]
    )
    active = scratch.stage(active.join(spans, match, "left").drop(*spans.columns[:-1]), "active")
    reopened = F.col("_from").isNotNull() & (F.col(CURRENT) | (F.col(END) > F.col("_from")))
    untouched = active.filter(~F.coalesce(reopened, F.lit(False))).drop("_from")

    seeds = active.filter(reopened).select(
        *keys, *tracked, F.col(EFFECTIVE).alias(time), surrogate, VERSION,
        F.lit(0).alias("_source"),
    )
    fresh = batch.select(
        *dict.fromkeys([*keys, *tracked, time, *ties]), F.lit(1).alias("_source")
    )
    line = seeds.unionByName(fresh, allowMissingColumns=True)
    order = [time, "_source", VERSION, *ties]
    compared = arrange(line, keys, order, scratch, rows, sizing).previous(
        {f"_was_{c}": c for c in tracked}, present="_seen"
    )
    # the first row of a key carries the version number the key goes on from
    first = F.when(~F.col("_seen"), F.coalesce(F.col(VERSION), F.lit(1)))
    kept = compared.with_columns({"_first": first}).where(
        (F.col("_source") == 0) | ~F.col("_seen") | _differs(tracked)
    ).stored("merged")
    numbered = (
        kept.carry_forward({"_base": "_first"})
        .position("_position")
        .following({END: time}, present="_followed")
    )
    merged = numbered.frame.select(
        surrogate, *keys, *tracked,
        F.col(time).alias(EFFECTIVE),
        END,
        (~F.col("_followed")).alias(CURRENT),
        (F.col("_base") + F.col("_position") - 1).cast("int").alias(VERSION),
    )
    merged = scratch.stage(merged, "versions")
    highest = stored.agg(F.max(surrogate)).first()[0] or 0
    created = add_dense_key(
        merged.filter(F.col(surrogate).isNull()).drop(surrogate),
        surrogate, [*keys, VERSION], scratch, rows=rows, start=highest, sizing=sizing,
    )
    kept_rows = merged.filter(F.col(surrogate).isNotNull())
    columns = merged.columns
    return (
        passed.select(*columns)
        .unionByName(untouched.select(*columns))
        .unionByName(kept_rows)
        .unionByName(created.select(*columns))
    )
