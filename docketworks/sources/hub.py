"""Streaming sources with the four columns value, timestamp, partition, offset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.schemas import BRONZE, HUB_RECORD, ddl, names

# start at the newest records and go on when the broker has lost some
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(
    servers: str, topic: str, login: str | None = None, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of the Kafka source. ``login`` is the JAAS entry, given by the deployment."""
    options = {**KAFKA_DEFAULTS, "kafka.bootstrap.servers": servers, "subscribe": topic}
    if login:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": login,
        }
    return options | dict(extra or {})


def read_hub(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """Unbounded read. A file format replaces the broker where the connector is absent."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(ddl(HUB_RECORD))
    return reader.load()


def to_bronze(records: DataFrame, ingested_at=None) -> DataFrame:
    """Envelope projection; the document stays exactly as it arrived."""
    source = (
        F.col("value").cast("string"),
        F.col("timestamp"),
        F.col("partition"),
        F.col("offset"),
        F.current_timestamp() if ingested_at is None else ingested_at,
    )
    return records.select(*[c.alias(name) for c, name in zip(source, names(BRONZE))])
