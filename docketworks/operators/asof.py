"""As-of join: each row meets the latest earlier row of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.operators.sequence import arrange
from docketworks.session import Sizing
from docketworks.sources.scratch import Scratch


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    row_time: str,
    version_time: str,
    version_order: Sequence[str],
    row_order: Sequence[str],
    carried: Sequence[str],
    scratch: Scratch,
    bound: int | None = None,
    sizing: Sizing | None = None,
    key_rows: int | None = None,
) -> DataFrame:
    """``rows`` with the ``carried`` columns of the version in force at ``row_time``.

    Both sides are laid on one time line per key and the last version is carried
    forward. No row is ever paired with more than one version, so a key with
    many rows and many versions stays linear. ``version_order`` and
    ``row_order`` make the order total; ``bound`` limits the rows of both sides, ``key_rows`` those of one key.
    """
    ties = [f"_tie_v{i}" for i in range(len(version_order))]
    ties += [f"_tie_r{i}" for i in range(len(row_order))]

    marks = versions.select(
        *keys,
        F.col(version_time).alias("_time"),
        F.lit(0).alias("_kind"),
        *[F.col(c).alias(f"_tie_v{i}") for i, c in enumerate(version_order)],
        F.struct(*carried).alias("_version"),
    )
    seekers = rows.withColumns({
        "_time": F.col(row_time),
        "_kind": F.lit(1),
        **{f"_tie_r{i}": F.col(c) for i, c in enumerate(row_order)},
    })
    if row_time not in (*keys, *carried):
        seekers = seekers.drop(row_time)  # it goes along as the time and comes back under its name
    line = seekers.unionByName(marks, allowMissingColumns=True)
    sequence = arrange(line, keys, ["_time", "_kind", *ties], scratch, bound, sizing, key_rows)
    found = sequence.carry_forward({"_in_force": "_version"}).frame.filter("_kind = 1")
    own = [F.col("_time").alias(c) if c == row_time else F.col(c) for c in rows.columns]
    return found.select(*own, *[F.col("_in_force").getField(c).alias(c) for c in carried])
