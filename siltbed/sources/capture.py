"""Admission of raw events, capture records, replay and backfill of the inbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.functions.joins import top_per_group
from siltbed.functions.plans import once
from siltbed.functions.text import is_blank
from siltbed.schemas import INBOX

ADMISSION = "type STRING, meta STRUCT<id: STRING, domain: STRING>, _corrupt_record STRING"
# The domain of test events, and the producer name in the stamp.
CANARY = "canary"
PRODUCER = "recent-change"


def _peek(rows: DataFrame) -> DataFrame:
    """Parse only what admission needs."""
    options = {"columnNameOfCorruptRecord": "_corrupt_record"}
    return once(rows, "_p", F.from_json("event_json", ADMISSION, options))


def admit_events(
    rows: DataFrame, change_type: str | None = "edit", domain_suffix: str | None = None
) -> DataFrame:
    """Add ``drop_reason``: NULL for admitted events. The first reason that applies wins."""
    reason = F.when(
        F.col("_p._corrupt_record").isNotNull() | F.col("_p.meta").isNull(), "malformed"
    ).when(F.col("_p.meta.domain") == CANARY, "canary")
    if change_type is not None:
        reason = reason.when(~F.col("_p.type").eqNullSafe(F.lit(change_type)), "change_type")
    if domain_suffix is not None:
        ends = F.coalesce(F.col("_p.meta.domain"), F.lit("")).endswith(domain_suffix)
        reason = reason.when(~ends, "domain")
    reason = reason.when(is_blank(F.col("_p.meta.id")), "missing_id")
    return _peek(rows).withColumn("drop_reason", reason).drop("_p")


def admitted(labelled: DataFrame) -> DataFrame:
    return labelled.filter("drop_reason IS NULL").drop("drop_reason")


def admission_metrics(labelled: DataFrame) -> DataFrame:
    """Events per outcome; the admitted ones are counted as ``kept``."""
    return labelled.groupBy(
        F.coalesce("drop_reason", F.lit("kept")).alias("outcome")
    ).agg(F.count("*").alias("events"))


def observe_admission(labelled: DataFrame, name: str = "admission") -> DataFrame:
    """The same counts as metrics of a running query."""
    reasons = ("malformed", "canary", "change_type", "domain", "missing_id")
    return labelled.observe(
        name,
        F.count("*").alias("read"),
        F.count_if(F.col("drop_reason").isNull()).alias("kept"),
        *[F.count_if(F.col("drop_reason") == r).alias(r) for r in reasons],
    )


def stamp_producer(
    rows: DataFrame, now: Column | None = None, source: str = PRODUCER
) -> DataFrame:
    """Inbox records whose payload carries the producer's name and time.

    The other fields pass through as variants, so their JSON types and unknown fields survive.
    """
    now = F.current_timestamp() if now is None else now
    stamp = F.to_variant_object(
        F.struct(
            F.lit(source).alias("source"),
            F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("producer_timestamp_utc"),
        )
    )
    fields = F.map_filter("_f", lambda k, _: k != "_producer")
    parsed = once(rows, "_f", F.from_json("event_json", "MAP<STRING, VARIANT>"))
    return parsed.select(
        F.to_json(F.map_concat(fields, F.create_map(F.lit("_producer"), stamp))).alias("event_json"),
        F.expr("try_variant_get(_f['meta'], '$.id', 'string')").alias("event_key"),
        F.unix_micros(now).alias("produced_at"),
    )


def first_wins(records: DataFrame, order: Column | str, key: str = "event_key") -> DataFrame:
    """First record per key in arrival order."""
    order = F.col(order) if isinstance(order, str) else order
    return top_per_group(records, [key], [order], 1, "_copy").drop("_copy")


def validate_batch(records: DataFrame, change_type: str = "edit") -> DataFrame:
    """Broken capture rules with the number of records (or keys) that break them.

    Records are reduced to one row per key first, inside the map tasks, so a key repeated very
    often costs no more than any other.
    """
    expected = [(f.name, f.dataType) for f in StructType.fromDDL(INBOX).fields]
    actual = [(f.name, f.dataType) for f in records.schema.fields]
    schema_fault = 0 if sorted(expected, key=str) == sorted(actual, key=str) else 1
    if {n for n, _ in expected} - {n for n, _ in actual}:
        return records.sparkSession.createDataFrame(
            [("schema", 1)], "rule STRING, violations BIGINT"
        )
    not_object = F.col("_p._corrupt_record").isNotNull() | F.col("_p.meta").isNull()
    faults = {
        "blank_key": is_blank(F.col("event_key")),
        "bad_time": F.coalesce(F.col("produced_at") <= 0, F.lit(True)),
        "payload_not_object": not_object,
        "key_mismatch": ~not_object & ~F.col("_p.meta.id").eqNullSafe(F.col("event_key")),
        "wrong_type": ~not_object & ~F.col("_p.type").eqNullSafe(F.lit(change_type)),
    }
    per_key = _peek(records).groupBy("event_key").agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in faults.items()]
    )
    totals = per_key.agg(
        F.when(F.coalesce(F.sum("n"), F.lit(0)) == 0, 1).otherwise(0).cast("long").alias("empty"),
        F.count_if(F.col("n") > 1).alias("repeated_key"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in faults],
    ).withColumn("schema", F.lit(schema_fault).cast("long"))
    rules = ["empty", "schema", "blank_key", "repeated_key", *list(faults)[1:]]
    pairs = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules]
    )
    return totals.select(F.inline(pairs)).filter("violations > 0")


def replay_with_duplicates(records: DataFrame, n: int, order: list[str]) -> DataFrame:
    """All records, then the first ``n`` again (an at-least-once delivery)."""
    return records.unionByName(records.orderBy(*order).limit(n))


def missing_keys(expected: DataFrame, inbox: DataFrame, key: str = "event_key") -> DataFrame:
    """Expected keys that cannot be read from the inbox yet."""
    return expected.select(key).distinct().join(inbox.select(key).distinct(), key, "left_anti")


def inbox_visibility(expected: DataFrame, inbox: DataFrame, key: str = "event_key") -> DataFrame:
    """One row: expected keys, visible keys, and whether the inbox is complete."""
    seen = inbox.select(key).distinct().withColumn("_seen", F.lit(True))
    return (
        expected.select(key)
        .distinct()
        .join(seen, key, "left")
        .agg(F.count("*").alias("expected_keys"), F.count("_seen").alias("visible_keys"))
        .withColumn("complete", F.col("expected_keys") == F.col("visible_keys"))
    )


def _payload_key(column: str = "event_json") -> Column:
    """Digest that stands for the payload in joins; NULL equals NULL."""
    return F.coalesce(F.sha2(column, 256), F.lit(""))


def backfill_missing(history: DataFrame, inbox: DataFrame, now: Column | None = None) -> DataFrame:
    """Inbox records for historical payloads that the inbox does not hold.

    Both sides are large: the inbox is cut to distinct digests, and AQE splits a payload with
    very many historical copies.
    """
    now = F.current_timestamp() if now is None else now
    held = inbox.select(_payload_key().alias("_digest")).distinct()
    return (
        history.withColumn("_digest", _payload_key())
        .join(held, "_digest", "left_anti")
        .select(
            "event_json",
            F.coalesce(
                F.get_json_object("event_json", "$.meta.id"),
                F.sha2(F.coalesce("event_json", F.lit("")), 256),
            ).alias("event_key"),
            F.unix_micros(F.coalesce("_ingested_at", now)).alias("produced_at"),
        )
    )


def backfill_coverage(history: DataFrame, inbox: DataFrame) -> DataFrame:
    """Historical payloads (copies counted) still missing from the inbox."""
    wanted = history.groupBy(_payload_key().alias("_digest")).agg(F.count("*").alias("n"))
    held = inbox.select(_payload_key().alias("_digest")).distinct()
    return wanted.join(held, "_digest", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("missing")
    )
