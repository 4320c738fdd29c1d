"""Silver to gold: three dimensions and the fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.functions import rules
from docketworks.operators.dense_keys import add_dense_key
from docketworks.schemas import (
    CASE_ATTRIBUTES, DEFENDANT_ATTRIBUTES, FACT, GOLD, HUB_KEY, names,
)
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch
from docketworks.sources.snapshots import SnapshotStore

FACT_TABLE = "fact_court_proceedings"
# dimension -> its attributes, in the order of its keys
DIMENSIONS = {
    "dim_defendant": tuple(DEFENDANT_ATTRIBUTES),
    "dim_case_details": tuple(CASE_ATTRIBUTES),
    "dim_court": ("court_district", "assigned_judge", "court_district_code"),
}
NATURAL_KEYS = {
    "dim_defendant": ("defendant_id",),
    "dim_case_details": ("case_id",),
    "dim_court": ("court_district", "assigned_judge"),
}
# the hub records behind the fact rows, kept beside the four tables
LOADED = "loaded_records"
LOADED_FIELDS = (("eventhub_partition", "int"), ("eventhub_offset", "bigint"))
SURROGATES = tuple(GOLD[table][0][0] for table in DIMENSIONS)
FACT_ORDER = ("case_id", "defendant_id", "record_timestamp", *HUB_KEY)


class StarBuilder:
    """Builds the star schema of one silver table.

    ``rows`` is an upper bound of the silver rows where known; a small bound
    lets the surrogate keys be numbered without counting first.
    """

    def __init__(
        self,
        silver: DataFrame,
        as_of: datetime,
        scratch: Scratch,
        rows: int | None = None,
        sizing: Sizing | None = None,
    ):
        self.silver = silver
        self.as_of = as_of
        self.now = rules.instant(as_of)
        self.scratch = scratch
        self.rows = rows
        self.sizing = sizing or Sizing()

    # -- dimensions ----------------------------------------------------------

    def dimension(
        self, table: str, stored: DataFrame | None = None, near: DataFrame | None = None
    ) -> DataFrame:
        """Distinct attribute sets with a key; versioned tables start at version 1.

        With the ``stored`` dimension only the sets that it lacks are returned,
        numbered on from its largest key; ``near`` are its ``touched`` rows where they
        are at hand. A large silver table says little about the number of distinct
        sets, so there they are counted.
        """
        columns = names(GOLD[table])
        key, attributes = columns[0], DIMENSIONS[table]
        sets = self.silver.select(*attributes).distinct()
        start = 0
        if stored is not None:
            near = self.touched(table, stored) if near is None else near
            known = near.select(F.struct(*attributes).alias("_known"))
            sets = sets.join(known, F.struct(*attributes) == known["_known"], "left_anti")
            start = stored.agg(F.max(key)).first()[0] or 0
        small = self.rows is not None and self.rows <= self.sizing.numbering_rows
        keyed = add_dense_key(
            sets, key, attributes, self.scratch,
            rows=self.rows if small else None, start=start, sizing=self.sizing,
        )
        first_version = {
            "record_effective_date": self.now,
            "record_end_date": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
            "record_version": F.lit(1),
            "created_timestamp": self.now,
        }
        stamps = {name: value for name, value in first_version.items() if name in columns}
        return keyed.withColumns(stamps).select(*columns)

    def touched(self, table: str, stored: DataFrame) -> DataFrame:
        """Rows of a stored dimension whose natural key this silver mentions.

        The mentioned keys are the small side, so the stored rows are filtered before
        anything sorts or shuffles them by their attributes.
        """
        keys = NATURAL_KEYS[table]
        mentioned = self.silver.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
        same = [stored[k].eqNullSafe(mentioned[f"_key_{k}"]) for k in keys]
        return stored.join(mentioned, reduce(lambda a, b: a & b, same), "left_semi")

    def not_loaded(self, loaded: DataFrame) -> DataFrame:
        """Silver rows whose hub record is not among ``loaded``."""
        return not_among(self.silver, loaded, self.scratch)

    # -- fact ----------------------------------------------------------------

    def keyed_rows(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        """Silver rows with their three keys, exactly one match each.

        Rows meet the dimension row with the same natural key and the same
        attributes, so a defendant with several attribute sets does not multiply.
        """
        rows = self.silver
        rows = _match(rows, dims["dim_court"], ["court_district", "assigned_judge"], [])
        rows = _match(rows, dims["dim_case_details"], ["case_id"], CASE_ATTRIBUTES[1:])
        return _match(rows, dims["dim_defendant"], ["defendant_id"], DEFENDANT_ATTRIBUTES[1:])

    def natural_key_rows(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        """Literal mode: join on natural keys alone, one row per matching dimension row."""
        return (
            self.silver
            .join(dims["dim_defendant"].select("defendant_sk", "defendant_id"), "defendant_id")
            .join(dims["dim_case_details"].select("case_details_sk", "case_id"), "case_id")
            .join(
                dims["dim_court"].select("court_sk", "court_district", "assigned_judge"),
                ["court_district", "assigned_judge"],
            )
        )

    def measured(self, keyed: DataFrame) -> DataFrame:
        """Scores, alerts and costs on top of keyed rows; no row key yet."""
        need, days = F.col("needs_representation"), F.col("days_to_hearing")
        score = F.col("representation_priority_score")
        return keyed.withColumns({
            "representation_priority_score": rules.priority_score(need, days),
            "estimated_case_cost": rules.case_cost(F.col("case_id"), need),
            "hearing_urgency_flag": rules.urgency_flag(days),
            "gold_processed_timestamp": self.now,
        }).withColumns({
            "alert_triggered": rules.raises_alert(score),
            "intervention_needed": rules.raises_alert(score),
            "alert_priority": rules.alert_priority(score),
        })

    def fact(self, dims: Mapping[str, DataFrame], start: int = 0) -> DataFrame:
        """The 20-column fact, numbered by case, defendant, time and hub position."""
        columns = names(FACT)
        carried = dict.fromkeys([*(c for c in columns if c in self.silver.columns), *FACT_ORDER])
        # measures follow from the row alone, so they are not sent and stored to be numbered
        rows = self.keyed_rows(dims).select(*carried, *SURROGATES)
        bound = self.silver.count() if self.rows is None else self.rows
        numbered = add_dense_key(
            rows, columns[0], FACT_ORDER, self.scratch, rows=bound, start=start,
            sizing=self.sizing,
        )
        return self.measured(numbered).select(*columns)

    # -- publication -----------------------------------------------------------

    def publish(self, store: SnapshotStore, cluster_fact: bool = False) -> dict[str, DataFrame]:
        """Write all four tables as one snapshot and return them as stored.

        The fact joins the dimensions that were written, so its keys are theirs.
        ``cluster_fact`` orders its files by filing date for date-filtered reads.
        """
        snapshot = store.new_snapshot()
        dims = {t: store.write(snapshot, t, self.dimension(t)) for t in DIMENSIONS}
        self._write_fact(store, snapshot, dims, 0, cluster_fact)
        store.write(snapshot, LOADED, self.silver.select(*HUB_KEY))
        store.commit(snapshot)
        return read_star(store, snapshot)

    def append(self, store: SnapshotStore, cluster_fact: bool = False) -> dict[str, DataFrame]:
        """Add this silver to the published star schema without renumbering anything.

        Only new attribute sets and new fact rows are written; their keys go on from the
        stored ones. Hub records that an earlier load brought are left out, so a repeated
        load adds nothing, not even a snapshot. The cost follows the batch: of the stored dimensions only rows with
        its natural keys are joined.
        """
        before = store.latest()
        stored = read_star(store, before)
        loaded = store.read(LOADED, LOADED_FIELDS, before)
        new = self.scratch.stage(self.not_loaded(loaded), "new-records")
        if new.isEmpty():
            return stored
        batch = StarBuilder(new, self.as_of, self.scratch, self.rows, self.sizing)
        snapshot = store.new_snapshot()
        dims = {}
        for table in DIMENSIONS:
            near = self.scratch.stage(batch.touched(table, stored[table]), f"touched-{table}")
            added = store.write(snapshot, table, batch.dimension(table, stored[table], near))
            dims[table] = near.unionByName(added)
        start = stored[FACT_TABLE].agg(F.max("proceeding_sk")).first()[0] or 0
        batch._write_fact(store, snapshot, dims, start, cluster_fact)
        store.write(snapshot, LOADED, batch.silver.select(*HUB_KEY))
        store.commit(snapshot, added_to=before)
        return read_star(store, snapshot)

    def _write_fact(self, store, snapshot, dims, start: int, cluster: bool) -> None:
        order = ("case_filed_date", "proceeding_sk") if cluster else ()
        store.write(snapshot, FACT_TABLE, self.fact(dims, start), cluster_by=order)


def read_star(store: SnapshotStore, snapshot: str) -> dict[str, DataFrame]:
    return {table: store.read(table, fields, snapshot) for table, fields in GOLD.items()}


def not_among(rows: DataFrame, loaded: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` whose hub position is not among ``loaded``; files beyond their range are skipped.

    Positions alone are compared first: where none or all of them were loaded, as in a new or a repeated
    delivery, no whole row is sent anywhere.
    """
    _, offset = HUB_KEY
    low, high, total = rows.agg(F.min(offset), F.max(offset), F.count(F.lit(1))).first()
    if low is None:
        return rows
    near = loaded.filter(F.col(offset).between(low, high)).select(*HUB_KEY)
    again = scratch.stage(rows.select(*HUB_KEY).join(near, list(HUB_KEY), "left_semi"), "loaded-again")
    found = again.count()  # from the footers
    if found in (0, total):
        return rows if found == 0 else rows.limit(0)
    return rows.join(again, list(HUB_KEY), "left_anti").select(*rows.columns)


def _match(
    rows: DataFrame, dim: DataFrame, natural: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Add the key of the one dimension row that equals ``rows`` in all named columns.

    A null natural key finds nothing; a null attribute equals a null attribute,
    as it does inside a struct. One struct is also a cheaper sort key than a
    null-safe comparison per column.
    """
    side = dim.select(
        dim.columns[0],
        *[F.col(c).alias(f"_dim_{c}") for c in natural],
        F.struct(*attributes).alias("_dim_attributes"),
    )
    condition = F.lit(True)
    for column in natural:
        condition = condition & (rows[column] == side[f"_dim_{column}"])
    if attributes:
        mine = F.struct(*[rows[c] for c in attributes])
        condition = condition & (mine == side["_dim_attributes"])
    return rows.join(side, condition).drop(*[c for c in side.columns if c.startswith("_dim_")])
