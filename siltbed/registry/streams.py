"""Registered queries: the streaming forms, drained over the whole recast inbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.parse import parse_events
from siltbed.operators.dedup import event_key
from siltbed.plans.analytics import tumbling_counts
from siltbed.plans.refine import refine
from siltbed.registry.base import Registry
from siltbed.registry.oracle_events import on_events
from siltbed.session import work_dir
from siltbed.sources.inbox import decode_inbox, inbox_stream
from siltbed.sources.recast import TWICE, inbox, raw_changes
from siltbed.streaming import ledger_stream as ls
from siltbed.streaming import refine_stream as rs

R = Registry()


def _landed(spark: SparkSession, d: str) -> str:
    path = work_dir(spark, "inbox")
    inbox(spark, d).write.parquet(path)
    return path


def _drained(rows: DataFrame, name: str, times: int = 1) -> DataFrame:
    """Run a stream into a fresh sink, ``times`` times on one checkpoint, and read the sink."""
    spark = rows.sparkSession
    out, checkpoint = work_dir(spark, name), work_dir(spark, f"{name}-checkpoint")
    for _ in range(times):
        rs.drain([rs.append_sink(rows, out, checkpoint)])
    return spark.read.schema(rows.schema).parquet(out)


_KEY = "coalesce(CASE WHEN e % 71 <> 0 THEN concat('evt-', CAST(e AS VARCHAR)) END, concat('raw-', CAST(e AS VARCHAR)))"
_INBOX = f"SELECT {_KEY} AS event_key, us + copy * 1000000 AS produced_at FROM delivered"


@R.query("inbox_stream", on_events(_INBOX))
def _(spark, d):
    rows = inbox_stream(spark, _landed(spark, d))
    return _drained(rows.select("event_key", "produced_at"), "inbox-copy")


@R.query("append_sink", on_events("SELECT event_id, wiki, title FROM delivered"))
def _(spark, d):
    rows = parse_events(decode_inbox(inbox_stream(spark, _landed(spark, d))))
    return _drained(rows.select("event_id", "wiki", "title"), "typed")


@R.query("rerun_idempotent", on_events(f"SELECT event_key, count(*) AS deliveries FROM ({_INBOX}) GROUP BY 1"))
def _(spark, d):
    rows = inbox_stream(spark, _landed(spark, d))
    copied = _drained(rows.select("event_key"), "rerun", times=2)
    return copied.groupBy("event_key").agg(F.count("*").alias("deliveries"))


def _dedup(name: str, state: str) -> None:
    @R.query(name, on_events("SELECT event_id, meta_id, _parse_error FROM flagged"))
    def _(spark, d):
        raw = decode_inbox(inbox_stream(rs.disk_state(spark), _landed(spark, d)))
        rows = rs.dedup_stream(event_key(parse_events(raw)), state=state)
        return _drained(rows.select("event_id", "meta_id", "_parse_error"), name)


_dedup("dedup_stream", "unbounded")
_dedup("dedup_stream_bounded", "bounded")


@R.query(
    "stream_refine",
    on_events(
        """SELECT 'clean' AS sink, event_id, wiki, reasons FROM silver
UNION ALL SELECT 'quarantine', event_id, wiki, reasons FROM delivered WHERE NOT passed"""
    ),
)
def _(spark, d):
    out = work_dir(spark, "refined")
    paths = rs.stream_refine(spark, _landed(spark, d), out, f"{out}-checkpoints")
    clean, rejected = (
        spark.read.parquet(p).select(
            F.lit(n).alias("sink"), "event_id", "wiki",
            F.array_join("_dq_failure_reasons", ",").alias("reasons"),
        )
        for n, p in zip(("clean", "quarantine"), paths)
    )
    return clean.unionByName(rejected)


@R.query(
    "late_ledger",
    on_events("SELECT event_id, count(*) AS copies FROM delivered WHERE passed AND event_id % 25 = 1 GROUP BY 1"),
)
def _(spark, d):
    out = work_dir(spark, "refined")
    clean, _ = rs.stream_refine(spark, _landed(spark, d), out, f"{out}-checkpoints")
    kept = spark.read.parquet(clean).filter("event_id % 25 <> 1")
    lost = rs.late_ledger(refine(inbox(spark, d)), kept)
    return lost.groupBy("event_id").agg(F.count("*").alias("copies"))


_LATENESS = 3 * 86400


# Five deliveries; the second copy of an event comes one delivery after the first.
@R.query(
    "late_ledger_batches",
    on_events(
        f""", b AS (SELECT *, e % 4 + copy AS batch FROM delivered WHERE passed),
seen AS (SELECT batch, max(secs) AS newest FROM b GROUP BY 1),
floors AS (SELECT d.batch, (SELECT max(newest) FROM seen s WHERE s.batch < d.batch) - {_LATENESS} AS floor FROM seen d),
timed AS (SELECT b.*, coalesce(secs < floor, false) AS late FROM b JOIN floors USING (batch)),
firsts AS (SELECT *, bool_or(NOT late) OVER (PARTITION BY e) AS kept,
    row_number() OVER (PARTITION BY e ORDER BY batch) AS turn FROM timed)
SELECT 'clean' AS sink, event_id, secs AS epoch, count(*) AS copies FROM firsts WHERE kept AND turn = 1 GROUP BY ALL
UNION ALL SELECT 'late', event_id, secs, count(*) FROM firsts WHERE NOT kept GROUP BY ALL
UNION ALL SELECT 'quarantine', NULL, NULL, count(*) FROM delivered WHERE NOT passed"""
    ),
)
def _(spark, d):
    """Late rows, late copies of clean rows and copies across batches, then the last delivery once more."""
    landed, root = work_dir(spark, "deliveries"), work_dir(spark, "ledger")
    for delivery in range(5):
        # Chosen by ``e`` first, so that payloads are made for this delivery alone.
        mine = raw_changes(spark, d).filter(f"e % 4 = {delivery} OR e % 4 = {delivery - 1} AND {TWICE}")
        rows = mine.withColumn("copy", F.explode(F.expr(f"CASE WHEN {TWICE} THEN sequence(0, 1) ELSE array(0) END")))
        rows.filter(f"e % 4 + copy = {delivery}").select(
            "event_json", "event_key", (F.col("us") + F.col("copy") * 1000000).alias("produced_at")
        ).write.mode("append").parquet(landed)
        ls.ledger_stream(spark, landed, root, f"{root}-checkpoint", _LATENESS)
    if ls.refine_batch(inbox(spark, d), 4, root, _LATENESS):
        raise AssertionError("A batch was applied twice")
    parts = []
    for sink in (ls.CLEAN, ls.LATE):
        found = ls.read_sink(spark, root, sink).groupBy("event_id", F.unix_seconds("event_time").alias("epoch"))
        parts.append(found.agg(F.count("*").alias("copies")).withColumn("sink", F.lit(sink)))
    rejected = ls.read_sink(spark, root, ls.REJECTED).agg(F.count("*").alias("copies"), F.lit("quarantine").alias("sink"))
    return parts[0].unionByName(parts[1]).unionByName(rejected, allowMissingColumns=True)


# A window is final once the watermark (ten minutes behind the newest event) has passed its end.
@R.query(
    "hourly_windows_stream",
    on_events(
        """, w AS (SELECT event_timestamp_unix // 3600 * 3600 AS start_epoch, count(*) AS edits FROM silver GROUP BY 1)
SELECT start_epoch, edits FROM w WHERE start_epoch + 3600 <= (SELECT max(event_timestamp_unix) - 600 FROM silver)"""
    ),
)
def _(spark, d):
    out = work_dir(spark, "refined")
    clean, _ = rs.stream_refine(spark, _landed(spark, d), out, f"{out}-checkpoints")
    schema = spark.read.parquet(clean).schema
    events = spark.readStream.schema(schema).parquet(clean)
    counted = _drained(tumbling_counts(events, "1 hour", rs.LATENESS), "windows")
    return counted.select(F.unix_seconds("window_start").alias("start_epoch"), "edits")
