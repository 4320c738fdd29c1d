"""Top rows of a table and of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spark prunes each group before the shuffle only up to this many rows
LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_per_group(
    frame: DataFrame, groups: Sequence[str], order: Sequence[Column], size: int, rank: str
) -> DataFrame:
    """The first ``size`` rows of each group.

    Spark's group limit lets every map task send at most ``size`` rows per
    group, so a group may be of any size. A larger ``size`` raises the setting
    up to which Spark does so.
    """
    conf = frame.sparkSession.conf
    if size > int(conf.get(LIMIT_SETTING, "1000")):
        conf.set(LIMIT_SETTING, str(size))
    number = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return frame.withColumn(rank, number).filter(F.col(rank) <= size)
