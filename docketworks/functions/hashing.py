"""A hash that any SQL engine with md5 can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: Column, tag: str) -> Column:
    """First 32 bits of ``md5(key:tag)`` as a bigint in [0, 2^32)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{tag}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def pick(values: tuple, index: Column) -> Column:
    """The value at a 0-based index of a constant list."""
    return F.get(F.array(*[F.lit(value) for value in values]), index.cast("int"))
