"""Streaming refinement: one inbox, a clean sink and a quarantine sink.

The two sinks are two queries with their own checkpoints. Duplicates must be removed upstream of
a sink, and rejected rows must not be deduplicated, so one query cannot feed both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltbed.operators.dedup import KEY
from siltbed.operators.quality import EVENT_RULES, good_rows, quarantine
from siltbed.plans.refine import refine
from siltbed.sources.inbox import inbox_stream

# The event clock and the allowed lateness.
EVENT_TIME, LATENESS = "event_time", "10 minutes"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def disk_state(spark: SparkSession) -> SparkSession:
    """Keep state on disk instead of the executor heap, unless the session names another store.

    The unbounded form of the duplicate filter remembers every key it has seen.
    """
    if "HDFSBacked" in spark.conf.get(STATE_STORE, "HDFSBacked"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    return spark


def dedup_stream(
    rows: DataFrame, key: str = KEY, state: str = "bounded", lateness: str = LATENESS
) -> DataFrame:
    """One row per key.

    ``bounded`` forgets a key once the watermark has passed it, so its state stays as large as the
    lateness. ``unbounded`` recognises copies for ever, as long as they are not late. Nothing is
    dropped before the watermark has seen it: a late copy must not displace one that is on time.
    """
    timed = rows.withWatermark(EVENT_TIME, lateness)
    if state == "bounded":
        return timed.dropDuplicatesWithinWatermark([key])
    if state == "unbounded":
        return timed.dropDuplicates([key])
    raise ValueError(f"Unknown state mode {state!r}")


def clean_stream(
    flagged: DataFrame, state: str = "bounded", valid_first: bool = True
) -> DataFrame:
    """Valid rows, one per key. Valid-first also keeps invalid clocks out of the watermark."""
    if valid_first:
        return dedup_stream(good_rows(flagged), state=state)
    return good_rows(dedup_stream(flagged, state=state))


def append_sink(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Append to Parquet exactly once per checkpoint; drains what is available unless ``every``."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    when = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**when).start()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for triggered queries; if one fails the others are stopped before the failure is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    except BaseException:
        for query in queries:
            query.stop()
        raise


def stream_refine(
    spark: SparkSession,
    inbox_path: str,
    out: str,
    checkpoints: str,
    rules: Mapping[str, str] = EVENT_RULES,
    state: str = "bounded",
    valid_first: bool = True,
    max_files: int | None = None,
) -> tuple[str, str]:
    """Process what is new in the inbox into ``out/clean`` and ``out/quarantine``."""
    flagged = refine(inbox_stream(disk_state(spark), inbox_path, max_files), rules)
    sinks = {
        "clean": clean_stream(flagged, state, valid_first),
        "quarantine": quarantine(flagged),
    }
    drain([append_sink(r, f"{out}/{n}", f"{checkpoints}/{n}") for n, r in sinks.items()])
    return f"{out}/clean", f"{out}/quarantine"


def stage_typed(
    spark: SparkSession, inbox_path: str, out: str, checkpoint: str, max_files: int | None = None
) -> str:
    """Parse once into a typed staging table, for inboxes where parsing dominates."""
    drain([append_sink(refine(inbox_stream(spark, inbox_path, max_files)), out, checkpoint)])
    return out


def late_ledger(flagged: DataFrame, clean: DataFrame, key: str = KEY) -> DataFrame:
    """Valid rows whose key never reached the clean table: dropped as late, or lost."""
    kept = clean.select(key).distinct()
    return good_rows(flagged).join(kept, key, "left_anti")
