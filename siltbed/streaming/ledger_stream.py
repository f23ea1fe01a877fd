"""Streaming refinement that keeps what comes too late.

A watermark inside a streaming query drops late rows without a trace. Here every micro-batch is
refined as an ordinary frame: rows behind the watermark go to a ledger as they come, rows on time to the clean
table, rejected rows to quarantine. The three appends and the new watermark become visible in one
commit, so a batch that is delivered again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.plans import stored
from siltbed.operators.dedup import KEY, repeated_keys, with_hash
from siltbed.operators.quality import EVENT_RULES, good_rows, quarantine
from siltbed.plans import store
from siltbed.plans.refine import clean_events, refine
from siltbed.sources.inbox import inbox_stream

CLEAN, LATE, REJECTED = "clean", "late", "quarantine"
LATENESS_SECONDS = 600
BATCH, NEWEST = "batch", "newest"


def read_sink(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed batches of a sink."""
    return _committed(spark, store.snapshot(spark, root).tables[name])


def _committed(spark: SparkSession, version: store.Version) -> DataFrame:
    rows = store.open_files(spark, version.path, version.schema)
    return rows.filter(F.col(BATCH) <= version.positions[BATCH]).drop(BATCH)


def _append(rows: DataFrame, root: str, name: str, batch: int, marks: dict[str, int]) -> store.Version:
    """Files of one batch beside those of the others; a repeated attempt replaces its own."""
    path = f"{root.rstrip('/')}/{name}"
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")
    schema = rows.withColumn(BATCH, F.lit(batch).cast("long")).schema
    return store.Version(path, schema.json(), positions=marks)


def refine_batch(
    inbox: DataFrame, batch: int, root: str, lateness: int = LATENESS_SECONDS, rules: Mapping[str, str] = EVENT_RULES,
    now: Column | None = None,
) -> bool:
    """Apply one micro-batch; False if it has been applied before.

    The watermark of a batch is the newest valid event of all batches before it, less ``lateness`` seconds, so
    rows of one batch never make each other late. A row on time is kept unless its key is among the
    clean rows that are still in reach of the watermark. A row behind it goes to the ledger unless a clean row
    has its key: then it is a copy and nothing is lost. Rows whose key is neither repeated in the batch nor
    among the clean rows go where their clock says, without a shuffle.
    """
    spark = inbox.sparkSession
    held = store.snapshot(spark, root)
    before = held.tables.get(CLEAN)
    marks = dict(before.positions) if before else {}
    if marks.get(BATCH, -1) >= batch:
        return False
    staged = stored(refine(inbox, rules, now), "ledger-batch")
    good = good_rows(staged)
    clock = F.unix_micros("event_time")
    floor = marks[NEWEST] - lateness * 1_000_000 if NEWEST in marks else None
    behind = F.lit(False) if floor is None else F.coalesce(clock < floor, F.lit(False))
    known = None if before is None else _committed(spark, before).select(KEY, "event_time")
    repeated = repeated_keys(good, known=known)
    single, others = with_hash(good, repeated, False), stored(with_hash(good, repeated), "ledger-repeated")
    fresh, late = clean_events(others.filter(~behind)), others.filter(behind)
    if known is not None:
        known = stored(with_hash(known, repeated), "ledger-known")
        # Only what can still be repeated on time.
        reach = known if floor is None else known.filter(F.col("event_time") >= F.timestamp_micros(F.lit(floor)))
        fresh = fresh.join(reach.select(KEY), KEY, "left_anti").select(fresh.columns)
        copies = known.join(late.select(KEY).distinct(), KEY, "left_semi").select(KEY).distinct()
        late = late.join(copies, KEY, "left_anti").select(late.columns)
    fresh, late = single.filter(~behind).unionByName(fresh), single.filter(behind).unionByName(late)
    newest = good.agg(F.max(clock)).first()[0]
    marks = {**marks, BATCH: batch} | ({NEWEST: max(newest, marks.get(NEWEST, newest))} if newest is not None else {})
    sinks = {CLEAN: fresh, LATE: late, REJECTED: quarantine(staged)}
    versions = {name: _append(rows, root, name, batch, marks) for name, rows in sinks.items()}
    store.commit(spark, root, versions, held.number)
    return True


def ledger_stream(
    spark: SparkSession, inbox_path: str, root: str, checkpoint: str, lateness: int = LATENESS_SECONDS,
    rules: Mapping[str, str] = EVENT_RULES, max_files: int | None = None, now: Column | None = None,
) -> None:
    """Process what is new in the inbox, batch by batch."""

    def step(rows: DataFrame, batch: int) -> None:
        refine_batch(rows, batch, root, lateness, rules, now)

    query = (
        inbox_stream(spark, inbox_path, max_files).writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
