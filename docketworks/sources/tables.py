"""External tables and views over the published star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from docketworks.schemas import GOLD, ddl


def create_external_tables(
    spark: SparkSession, locate: Callable[[str], str | Sequence[str]], fmt: str = "parquet", prefix: str = ""
) -> dict[str, str]:
    """Declare the four tables with their typed schemas over existing folders.

    ``locate`` gives the folder of a table, or its folders, one per load. Several loads become a
    table each and a view over all of them under the table's name. Only catalog entries
    are replaced: an entry that is neither a view nor an external table is refused, because
    dropping it would delete its data.
    """
    created = {}
    for table, fields in GOLD.items():
        name, places = f"{prefix}{table}", locate(table)
        places = [places] if isinstance(places, str) else list(places)
        parts = [name] if len(places) == 1 else [f"{name}__load{i}" for i in range(len(places))]
        for part in {name, *parts}:
            _forget(spark, part)
        for part, place in zip(parts, places):
            quoted = place.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE {part} ({ddl(fields)}) USING {fmt} LOCATION '{quoted}'")
        if len(parts) > 1:
            union = " UNION ALL ".join(f"SELECT * FROM {part}" for part in parts)
            spark.sql(f"CREATE VIEW {name} AS {union}")
        created[table] = name
    return created


def _forget(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        return
    kind = spark.catalog.getTable(name).tableType
    if kind not in ("EXTERNAL", "VIEW"):
        raise ValueError(f"{name} is a {kind.lower()} table; its data would be dropped with it")
    spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")


def create_views(views: Mapping[str, DataFrame]) -> None:
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def preview(table: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows by key, so that two previews of one table agree."""
    return table.orderBy(key).limit(rows)
