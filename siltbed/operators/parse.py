"""Raw JSON text -> flat typed event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.plans import once
from siltbed.schemas import PAYLOAD

# Payload path -> column of the flat row.
FLAT_COLUMNS = {
    "id": "event_id",
    "type": "event_type",
    "namespace": "namespace",
    "title": "title",
    "title_url": "title_url",
    "comment": "comment",
    "timestamp": "event_timestamp_unix",
    "user": "user",
    "bot": "bot",
    "minor": "minor",
    "patrolled": "patrolled",
    "server_name": "server_name",
    "wiki": "wiki",
    "meta.id": "meta_id",
    "meta.domain": "domain",
    "length.old": "length_old",
    "length.new": "length_new",
    "_producer.source": "producer_source",
}
# Delivery columns that travel through unchanged (renamed where the second name differs).
CARRIED = {
    "event_json": "event_json",
    "kafka_topic": "kafka_topic",
    "kafka_partition": "kafka_partition",
    "kafka_offset": "kafka_offset",
    "kafka_enqueued_at": "kafka_enqueued_at",
    "_source": "_source",
    "_ingested_at": "bronze_ingested_at",
    "_load_date": "bronze_load_date",
}
LEGACY_ABSENT = {"meta_id", "producer_source"}

# Years 1..9999; a second count outside them is not a usable event time.
EPOCH_MIN, EPOCH_MAX = -62135596800, 253402300799


def epoch_time(seconds: Column) -> Column:
    """Unix seconds -> timestamp, NULL where no calendar date exists."""
    return F.timestamp_seconds(F.when(seconds.between(EPOCH_MIN, EPOCH_MAX), seconds))


def event_times(payload: str = "payload") -> dict[str, Column]:
    """The three clocks of an event. Bad text becomes NULL instead of ending the job."""
    return {
        "event_time": epoch_time(F.col(f"{payload}.timestamp")),
        "event_time_utc": F.try_to_timestamp(F.col(f"{payload}.meta.dt")),
        "producer_timestamp_utc": F.try_to_timestamp(
            F.col(f"{payload}._producer.producer_timestamp_utc")
        ),
    }


def editor_class(bot: Column) -> Column:
    """``bot`` only for an explicit true; a missing flag counts as a human."""
    return F.when(bot.eqNullSafe(F.lit(True)), F.lit("bot")).otherwise(F.lit("human"))


def byte_delta(old: Column, new: Column) -> Column:
    """``new - old``; NULL if either is missing or the difference leaves BIGINT."""
    return F.try_subtract(new, old)


def absolute(delta: Column) -> Column:
    """``abs`` that yields NULL for the one value without a positive counterpart."""
    return F.abs(F.when(delta != F.lit(-(2**63)).cast("long"), delta))


def parse_events(raw: DataFrame, mode: str = "current", now: Column | None = None) -> DataFrame:
    """Parse ``event_json`` once and flatten it.

    ``current`` marks rows whose text, or any field of it, does not fit the schema
    (``_parse_error``) and keeps the fields that do. ``legacy`` has no ``meta.id`` or producer
    fields, and marks only rows with no JSON value at all.
    """
    if mode not in ("current", "legacy"):
        raise ValueError(f"Unknown parse mode {mode!r}")
    now = F.current_timestamp() if now is None else now
    schema = PAYLOAD if mode == "legacy" else f"{PAYLOAD}, _corrupt_record STRING"
    options = {"mode": "PERMISSIVE"}
    if mode == "current":
        options["columnNameOfCorruptRecord"] = "_corrupt_record"
    # Otherwise the rules, pushed below the parse, would repeat it for every field they read.
    parsed = once(raw, "payload", F.from_json("event_json", schema, options))
    broken = (
        F.col("payload").isNull()
        if mode == "legacy"
        else F.col("payload._corrupt_record").isNotNull()
    )
    skipped = LEGACY_ABSENT if mode == "legacy" else set()
    times = event_times()
    if mode == "legacy":
        times.pop("producer_timestamp_utc")
    flat = parsed.select(
        *[F.expr(f"payload.{p} AS {n}") for p, n in FLAT_COLUMNS.items() if n not in skipped],
        *[value.alias(name) for name, value in times.items()],
        broken.alias("_parse_error"),
        *[F.expr(f"{src} AS {dst}") for src, dst in CARRIED.items() if src in raw.columns],
    )
    if mode == "legacy":
        return flat.withColumns(
            {
                "editor_type": editor_class(F.col("bot")),
                "silver_ingested_at": now,
                "silver_load_date": F.to_date(now),
            }
        )
    return flat.withColumns(
        {
            "editor_type": editor_class(F.col("bot")),
            "byte_change": byte_delta(F.col("length_old"), F.col("length_new")),
            "silver_ingested_at": now,
            "silver_load_date": F.to_date(now),
        }
    ).withColumn("abs_byte_change", absolute(F.col("byte_change")))


def clean_titles(rows: DataFrame, column: str = "title") -> DataFrame:
    """Drop rows without a title; lower-case and trim the rest."""
    return rows.filter(F.col(column).isNotNull()).withColumn(column, F.lower(F.trim(column)))


def null_fallbacks(rows: DataFrame, defaults: dict[str, Column | object]) -> DataFrame:
    """Replace NULLs column by column; a default may be a literal or another column."""
    return rows.withColumns(
        {
            name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
            for name, value in defaults.items()
        }
    )
