"""Event sources: the append-only inbox, a message bus, and the common raw contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.schemas import INBOX

INBOX_SOURCE = "inbox_recent_change"
BUS_SOURCE = "bus_recent_change"


def inbox_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New inbox files as they appear."""
    reader = spark.readStream.schema(INBOX)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def inbox_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INBOX).parquet(path)


def bus_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options for the message-bus source: read from the start, tolerate expired offsets."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **extra,
    }


def kafka_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_bus(records: DataFrame) -> DataFrame:
    """Bus record -> raw event contract."""
    return records.select(
        F.col("value").cast("string").alias("event_json"),
        *[
            F.col(name).alias(alias)
            for name, alias in (
                ("topic", "kafka_topic"),
                ("partition", "kafka_partition"),
                ("offset", "kafka_offset"),
                ("timestamp", "kafka_enqueued_at"),
            )
        ],
    )


def bronze_metadata(
    rows: DataFrame, source: str = BUS_SOURCE, now: Column | None = None
) -> DataFrame:
    """Where a row came from and when it arrived."""
    now = F.current_timestamp() if now is None else now
    return rows.withColumns(
        {"_source": F.lit(source), "_ingested_at": now, "_load_date": F.to_date(now)}
    )


def decode_inbox(
    inbox: DataFrame, source: str = INBOX_SOURCE, now: Column | None = None
) -> DataFrame:
    """Inbox row -> the same raw event contract; it has no bus position."""
    position = {
        "kafka_topic": "string",
        "kafka_partition": "int",
        "kafka_offset": "long",
        "kafka_enqueued_at": "timestamp",
    }
    raw = inbox.select(
        "event_json", *[F.lit(None).cast(kind).alias(name) for name, kind in position.items()]
    )
    return bronze_metadata(raw, source, now)
