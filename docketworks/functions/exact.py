"""Arithmetic that gives the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, rounded half up to one decimal; null for an empty whole.

    Rounds in integers, because rounding a double depends on its binary tail.
    """
    tenths = F.call_function("div", part * 2000 + whole, whole * 2)
    return F.when(whole > 0, tenths / F.lit(10.0))


def mean(total: Column, rows: Column) -> Column:
    return F.when(rows > 0, total.cast("double") / rows)


def cents(amount: Column) -> Column:
    """A bigint number of cents as a DECIMAL(10,2)."""
    return (amount.cast("decimal(12,2)") / F.lit(100)).cast("decimal(10,2)")
