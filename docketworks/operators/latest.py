"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row per key by ``order`` and then by all other columns.

    This is an aggregate, not a window: every map task reduces its copies of a
    key to one row before the shuffle, so a key with very many copies costs no
    more there than any other.
    """
    rest = [c for c in frame.columns if c not in {*keys, *order}]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return frame.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*frame.columns)
