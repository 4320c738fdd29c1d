"""A star schema whose dimensions have versions, loaded in batches that may come in any order.

A proceeding points to the version of its defendant and of its case in force when it was recorded. A late
batch can open versions before stored ones and split them; then only the proceedings inside the
stretches that changed get other keys. Stored rows are never rewritten: a load appends rows and withdraws
others by key and load, so its cost follows the batch and what the batch changes.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.functions import rules
from docketworks.operators.chains import Tail, intervals, merge_tail, moved_rows, versions_of
from docketworks.operators.dense_keys import add_dense_key
from docketworks.plans import upkeep
from docketworks.plans.star import FACT_ORDER, FACT_TABLE, NATURAL_KEYS, StarBuilder, _match, not_among
from docketworks.schemas import CASE_ATTRIBUTES, DEFENDANT_ATTRIBUTES, FACT, GOLD, HUB_KEY, Fields, ddl, names
from docketworks.session import Sizing, side_by_side
from docketworks.sources.scratch import Passing, Scratch, passing
from docketworks.sources.snapshots import SnapshotStore

RECORDED, TIE, LOAD = "recorded_at", "event_tie", "load"
TIES = (HUB_KEY[1], HUB_KEY[0], TIE)
TIE_FIELDS: Fields = ((HUB_KEY[1], "bigint"), (HUB_KEY[0], "int"), (TIE, "bigint"))
#: Records without a time count as the earliest of all.
EARLIEST = "1900-01-01 00:00:00"

TRACKED = {
    "dim_defendant": ("defendant_sk", "defendant_id", tuple(DEFENDANT_ATTRIBUTES[1:])),
    "dim_case_details": ("case_details_sk", "case_id", tuple(CASE_ATTRIBUTES[1:])),
}
STORED: dict[str, Fields] = {
    **{table: (*GOLD[table], *TIE_FIELDS, (LOAD, "int")) for table in TRACKED},
    "dim_court": GOLD["dim_court"],
    FACT_TABLE: (*FACT, (RECORDED, "timestamp"), *TIE_FIELDS, (LOAD, "int")),
}
ROW_KEYS = {table: GOLD[table][0][0] for table in (*TRACKED, FACT_TABLE)}
#: Rows of a key on a time line, at most, for each of its proceedings: itself and a version before and after.
_LINES = 3
HIGHEST = "highest_keys"
HIGHEST_FIELDS: Fields = (("table_name", "string"), ("highest", "bigint"))


def _key_rows_of(table: str) -> str:
    """Under this name ``highest_keys`` has a bound of the proceedings of one key."""
    return f"{table}_key_rows"


def withdrawn(table: str) -> str:
    return f"{table}_withdrawn"


def withdrawn_fields(table: str) -> Fields:
    return ((ROW_KEYS[table], "bigint"), (LOAD, "int"))


class VersionedStar:
    """The versioned star schema in ``store``. ``rows`` is an upper bound of the rows of a load where known."""

    def __init__(
        self, store: SnapshotStore, as_of: datetime, scratch: Scratch, rows: int | None = None,
        sizing: Sizing | None = None,
    ):
        self.store, self.as_of, self.scratch = store, as_of, scratch
        self.now = rules.instant(as_of)
        self.rows, self.sizing = rows, sizing or Sizing()

    # -- reading -----------------------------------------------------------------

    def rows_in_force(self, table: str, snapshot: str | None = None) -> DataFrame:
        """Rows of a table that no load has withdrawn, with all stored columns."""
        stored = self.store.read(table, STORED[table], snapshot)
        if table not in ROW_KEYS:
            return stored
        gone = self.store.read(withdrawn(table), withdrawn_fields(table), snapshot)
        return stored.join(gone, [ROW_KEYS[table], LOAD], "left_anti").select(*stored.columns)

    def tables(self, snapshot: str | None = None) -> dict[str, DataFrame]:
        """The four tables of the star schema under their declared columns."""
        return {table: self.rows_in_force(table, snapshot).select(*names(fields)) for table, fields in GOLD.items()}

    def reports(self, snapshot: str | None = None) -> dict[str, DataFrame]:
        """The reports that every load keeps up to date."""
        return {name: upkeep.read(self.store, name, snapshot) for name in upkeep.REPORTS}

    # -- loading -----------------------------------------------------------------

    def load(self, silver: DataFrame) -> dict[str, DataFrame]:
        """Add the rows of ``silver`` that no earlier load brought, in whatever order loads come.

        Rows without a case, defendant, district or judge have no place in the star schema. Rows with a
        hub position count once; rows without one cannot be told from others and count each.
        """
        before = self.store.newest()
        with passing(self.scratch) as scratch:
            snapshot = self._first(silver, scratch) if before is None else self._add(silver, before, scratch)
        return self.tables(snapshot)

    def _prepared(self, silver: DataFrame) -> DataFrame:
        keys = [k for natural in NATURAL_KEYS.values() for k in natural]
        compared = [*keys, *DEFENDANT_ATTRIBUTES[1:], *CASE_ATTRIBUTES[1:]]
        rows = silver.dropna(subset=keys).withColumns({
            RECORDED: F.coalesce("record_timestamp", F.lit(EARLIEST).cast("timestamp")),
            TIE: F.xxhash64(*compared),
        })
        used = {*names(FACT), *FACT_ORDER, *names(upkeep.KNOWN), *compared, RECORDED, TIE}
        return rows.select(*[c for c in rows.columns if c in used])

    def _not_loaded(self, batch: DataFrame, before: str, scratch: Passing) -> DataFrame:
        """Rows whose hub position no stored proceeding has."""
        return not_among(batch, self.store.read(FACT_TABLE, STORED[FACT_TABLE], before), scratch)

    def _first(self, silver: DataFrame, scratch: Passing) -> str:
        batch = scratch.stage(self._prepared(silver), "first-load")
        snapshot = self.store.new_snapshot()
        nothing = {
            # as the optimizer knows that there is nothing, nothing is planned for it
            table: self.store.spark.createDataFrame([], ddl(fields)).limit(0)
            for table, fields in STORED.items()
        }
        self._write(snapshot, batch, nothing, {table: 0 for table in GOLD}, 0, None, scratch)
        self.store.commit(snapshot)
        return snapshot

    def _add(self, silver: DataFrame, before: str, scratch: Passing) -> str:
        batch = scratch.stage(self._not_loaded(self._prepared(silver), before, scratch), "next-load")
        if batch.isEmpty():
            return before
        stored = {table: self.rows_in_force(table, before) for table in STORED if table != FACT_TABLE}
        # withdrawn proceedings too, as they are told by what replaced them where they are met
        stored[FACT_TABLE] = self.store.read(FACT_TABLE, STORED[FACT_TABLE], before)
        highest = self.store.read(HIGHEST, HIGHEST_FIELDS, before).groupBy("table_name").agg(F.max("highest"))
        start = {**{table: 0 for table in GOLD}, **{r[0]: r[1] for r in highest.collect()}}  # a row per table
        snapshot = self.store.new_snapshot()
        number = len(self.store.locations(before, FACT_TABLE))
        self._write(snapshot, batch, stored, start, number, before, scratch)
        self.store.commit(snapshot, added_to=before)
        return snapshot

    def _write(
        self, snapshot: str, batch: DataFrame, stored: dict[str, DataFrame], start: dict[str, int], number: int,
        before: str | None, scratch: Passing,
    ) -> None:
        bound = None if self.rows is None else 3 * self.rows
        settings = {"scratch": scratch, "bound": bound, "sizing": self.sizing}
        # a store of loads that did not count the rows of its keys goes without
        counts = before is None or all(_key_rows_of(table) in start for table in TRACKED)
        key_rows = {
            table: self._key_rows(batch, table, start.get(_key_rows_of(table), 0)) for table in TRACKED if counts
        }
        counted = {key: _LINES * key_rows[table] if counts else None for table, (_, key, _) in TRACKED.items()}
        load, facts, highest = F.lit(number), stored[FACT_TABLE], []

        builder = StarBuilder(batch, self.as_of, scratch, self.rows, self.sizing)
        courts = self.store.write(snapshot, "dim_court", builder.dimension("dim_court", stored["dim_court"]))
        highest.append(self._highest("dim_court", courts, "court_sk"))
        courts = builder.touched("dim_court", stored["dim_court"]).unionByName(courts)
        # the row key tells the rows of the batch apart from here on
        numbered = add_dense_key(
            _match(batch, courts, ["court_district", "assigned_judge"], []), "proceeding_sk", FACT_ORDER, scratch,
            rows=self.rows if self.rows is not None else batch.count(), start=start[FACT_TABLE],
            sizing=self.sizing, keep=True,
        )

        def dimension(table: str) -> tuple[Tail, DataFrame, DataFrame]:
            """The chains of one dimension, their highest key, and the stretch that each row lies in."""
            surrogate, key, tracked = TRACKED[table]
            place = ["proceeding_sk", key, RECORDED, *TIES]
            tail = merge_tail(
                stored[table], facts.select(*place, surrogate, LOAD), numbered.select(*place, *tracked), "proceeding_sk",
                surrogate, [key], tracked, RECORDED, TIES, start=start[table], key_rows=counted[key],
                load=LOAD, **settings,
            )
            top = self._replace_versions(snapshot, table, tail, load)
            return tail, top, intervals(tail, surrogate, [key], TIES, key_rows=counted[key], **settings)

        done = side_by_side(*[lambda table=table: dimension(table) for table in TRACKED])
        tails = {table: tail for table, (tail, _, _) in zip(TRACKED, done)}
        highest += [top for _, top, _ in done]

        used = {*names(FACT), *FACT_ORDER, RECORDED, *TIES, *names(upkeep.KNOWN)}
        keyed, found = numbered.select(*[c for c in numbered.columns if c in used]), []
        for (surrogate, _, _), (_, _, stretches) in zip(TRACKED.values(), done):
            keyed = keyed.join(versions_of(stretches, "proceeding_sk", surrogate), "proceeding_sk")
            found.append(moved_rows(stretches).select("proceeding_sk", RECORDED, F.col("now").alias(f"_{surrogate}")))
        keyed, moved = side_by_side(
            lambda: scratch.stage(keyed, "keyed"),
            lambda: scratch.stage(self._moved(facts, found, before, scratch), "moved"),
        )
        measured = builder.measured(keyed)

        def write_facts() -> None:
            again, added = (
                rows.withColumn(LOAD, load).select(*names(STORED[FACT_TABLE])) for rows in (moved, measured)
            )
            # by position, so that later loads skip files by time and by offset
            written = self.store.write(
                snapshot, FACT_TABLE, added.unionByName(again), cluster_by=(RECORDED, HUB_KEY[1], "proceeding_sk")
            )
            tops = [*highest, self._highest(FACT_TABLE, written, "proceeding_sk"), self.store.spark.createDataFrame(
                [(_key_rows_of(table), most) for table, most in key_rows.items()],
                ", ".join(f"{n} {t}" for n, t in HIGHEST_FIELDS),
            )]
            self.store.write(snapshot, HIGHEST, reduce(DataFrame.unionByName, tops))

        side_by_side(
            write_facts,
            lambda: self.store.write(snapshot, withdrawn(FACT_TABLE), moved.select("proceeding_sk", LOAD)),
            lambda: upkeep.write(self.store, snapshot, before, measured, tails["dim_defendant"], scratch),
        )

    @staticmethod
    def _key_rows(batch: DataFrame, table: str, before: int) -> int:
        """A bound of the proceedings of any one key: the largest number of each load, added up."""
        # keys that share a hash only raise the bound
        counted = batch.groupBy(F.xxhash64(TRACKED[table][1])).agg(F.count(F.lit(1)).alias("_rows"))
        return before + (counted.agg(F.max("_rows")).first()[0] or 0)

    @staticmethod
    def _highest(table: str, written: DataFrame, key: str) -> DataFrame:
        return written.agg(F.max(key).alias("highest")).filter("highest IS NOT NULL").select(
            F.lit(table).alias("table_name"), "highest"
        )

    def _replace_versions(self, snapshot: str, table: str, tail: Tail, load) -> DataFrame:
        """Write the versions that are new or changed and withdraw what they replace."""
        surrogate = TRACKED[table][0]
        # the key and the tracked values of a version never change
        changed = tail.after.filter("_changed")
        fresh = changed.withColumns({
            "created_timestamp": F.coalesce("_stored.created_timestamp", self.now), LOAD: load,
        })
        written = self.store.write(snapshot, table, fresh.select(*names(STORED[table])))
        gone = changed.filter("_stored IS NOT NULL")
        self.store.write(snapshot, withdrawn(table), gone.select(surrogate, F.col(f"_stored.{LOAD}").alias(LOAD)))
        return self._highest(table, written, surrogate)

    def _moved(
        self, facts: DataFrame, found: Sequence[DataFrame], before: str | None, scratch: Passing
    ) -> DataFrame:
        """Facts that get another key from one dimension, the other, or both.

        ``found`` has row key, time and new key per dimension; whole rows are fetched once.
        """
        surrogates = [surrogate for surrogate, _, _ in TRACKED.values()]
        either = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
        change = scratch.stage(
            either.groupBy("proceeding_sk").agg(
                F.min(RECORDED).alias("_at"), *[F.max(f"_{s}").alias(f"_{s}") for s in surrogates]
            ), "moved-keys"
        )
        low, high = change.agg(F.min("_at").cast("string"), F.max("_at").cast("string")).first()
        if low is None:
            return facts.limit(0)
        near = facts.filter(F.col(RECORDED).between(*[F.lit(t).cast("timestamp") for t in (low, high)]))
        gone = self.store.read(withdrawn(FACT_TABLE), withdrawn_fields(FACT_TABLE), before)
        hit = near.join(change, "proceeding_sk").join(gone, ["proceeding_sk", LOAD], "left_anti")
        return hit.withColumns(
            {s: F.coalesce(f"_{s}", s) for s in surrogates}
        ).select(*facts.columns)
