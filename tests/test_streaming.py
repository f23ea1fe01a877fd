"""Streams against batch, late data, state, reruns."""

import json

import pytest
from pyspark.sql import functions as F

from siltbed.operators.dedup import KEY
from siltbed.operators.quality import dq_flags
from siltbed.plans.analytics import tumbling_counts
from siltbed.plans.refine import clean_events, quarantined_events, refine
from siltbed.schemas import INBOX
from siltbed.sources.inbox import inbox_batch, inbox_stream
from siltbed.sources.recast import inbox as recast_inbox
from siltbed.streaming import refine_stream as rs

DATA = "/root/testdata/sf0.001"
T0 = 1_700_000_000


def event(key, minute=0, **changes):
    body = {
        "id": 1, "type": "edit", "timestamp": T0 + 60 * minute, "wiki": "enwiki", "title": key,
        "meta": {"id": key, "domain": "d"}, **changes,
    }
    return json.dumps(body)


def land(spark, path, *batches):
    """One file per batch, in order."""
    import time

    for batch in batches:
        rows = [(text, json.loads(text)["meta"]["id"], 1) for text in batch]
        spark.createDataFrame(rows, INBOX).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(1.1)  # files are read in order of their modification time


def keys(spark, path):
    return sorted(r[KEY] for r in spark.read.parquet(path).collect())


def test_stream_equals_batch(spark, tmp_path):
    recast_inbox(spark, DATA).repartition(3).write.parquet(str(tmp_path / "in"))
    clean, rejected = rs.stream_refine(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    flagged = refine(inbox_batch(spark, str(tmp_path / "in")))
    columns = ["event_id", "wiki", "title", KEY, "byte_change", "_dq_failure_reasons"]
    pairs = [(clean, clean_events(flagged)), (rejected, quarantined_events(flagged))]
    for path, batch in pairs:
        streamed = spark.read.parquet(path)
        assert set(streamed.columns) == set(batch.columns)
        a, b = streamed.select(columns), batch.select(columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_rerun_adds_nothing_and_new_files_are_picked_up(spark, tmp_path):
    args = [str(tmp_path / n) for n in ("in", "out", "ck")]
    land(spark, args[0], [event("a"), event("a"), event("b")])
    for _ in range(2):
        clean, rejected = rs.stream_refine(spark, *args)
        assert keys(spark, clean) == ["a", "b"]
    land(spark, args[0], [event("a", 1), event("c", 1), event("bad", wiki="")])
    clean, rejected = rs.stream_refine(spark, *args)
    assert keys(spark, clean) == ["a", "b", "c"] and keys(spark, rejected) == ["bad"]


@pytest.mark.parametrize("state,expected", [("unbounded", ["k", "x", "y"]), ("bounded", ["k", "k", "x", "y"])])
def test_state_modes(spark, tmp_path, state, expected):
    # The copy comes on time by its own clock, but long after the first one.
    land(spark, tmp_path / "in", [event("k")], [event("x", 60)], [event("y", 120)], [event("k", 121)])
    clean, _ = rs.stream_refine(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), state=state, max_files=1
    )
    assert keys(spark, clean) == expected


def test_late_rows_are_dropped_and_listed(spark, tmp_path):
    land(spark, tmp_path / "in", [event("a", 100)], [event("b", 101)], [event("late", 1), event("c", 102)])
    clean, rejected = rs.stream_refine(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1
    )
    assert keys(spark, clean) == ["a", "b", "c"]
    flagged = refine(inbox_batch(spark, str(tmp_path / "in")))
    assert [r[KEY] for r in rs.late_ledger(flagged, spark.read.parquet(clean)).collect()] == ["late"]


def test_valid_first_ignores_invalid_clocks(spark, tmp_path):
    batches = [[event("a"), event("bad", 10_000_000, wiki="")], [event("b", 1)], [event("c", 2)]]
    land(spark, tmp_path / "in", *batches)
    found = {}
    for first in (True, False):
        clean, _ = rs.stream_refine(
            spark, str(tmp_path / "in"), str(tmp_path / f"out{first}"), str(tmp_path / f"ck{first}"),
            valid_first=first, max_files=1,
        )
        found[first] = keys(spark, clean)
    # Lateness is judged by the watermark of the batch before, so the second batch still passes.
    assert found[True] == ["a", "b", "c"] and found[False] == ["a", "b"]


def test_a_late_copy_does_not_displace_one_on_time(spark, tmp_path):
    """Batches of one file: the last holds a late and a timely copy of one key."""
    for batch in ([event("a", 100)], [event("b", 101)], [event("k", 1), event("k", 102)]):
        land(spark, tmp_path / "in", batch)
    clean, _ = rs.stream_refine(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    assert keys(spark, clean) == ["a", "b", "k"]


def test_unknown_state_and_plans_without_python(spark):
    rows = spark.createDataFrame([("k", 1)], f"{KEY} string, id int")
    with pytest.raises(ValueError):
        rs.dedup_stream(rows.withColumn("event_time", F.current_timestamp()), state="sometimes")


def test_staged_form_and_windows(spark, tmp_path):
    land(spark, tmp_path / "in", [event("a"), event("b", 30), event("c", 200)])
    staged = rs.stage_typed(spark, str(tmp_path / "in"), str(tmp_path / "typed"), str(tmp_path / "ck"))
    typed = spark.read.parquet(staged)
    assert dq_flags(typed).count() == 3
    events = spark.readStream.schema(typed.schema).parquet(staged)
    counted = tumbling_counts(events, "1 hour", rs.LATENESS)
    rs.drain([rs.append_sink(counted, str(tmp_path / "w"), str(tmp_path / "ckw"))])
    assert spark.read.parquet(str(tmp_path / "w")).agg(F.sum("edits")).first()[0] == 2


def test_continuous_sink(spark, tmp_path):
    land(spark, tmp_path / "in", [event("a")])
    rows = inbox_stream(spark, str(tmp_path / "in"))
    query = rs.append_sink(rows, str(tmp_path / "out"), str(tmp_path / "ck"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_late_rows_reach_the_ledger_and_a_failed_batch_is_repeated(spark, tmp_path, monkeypatch):
    """Watermark of earlier batches only, copies in time and too late, and a run that fails before its commit."""
    from siltbed.plans import store
    from siltbed.streaming import ledger_stream as ls

    def batch(*events):
        rows = [
            (json.dumps({"id": i, "type": "edit", "namespace": 0, "title": f"T{i}", "user": "u", "bot": False, "wiki": "enwiki",
                         "timestamp": t, "meta": {"id": f"m{i}", "domain": "d", "dt": None}}), f"m{i}", t * 1_000_000)
            for i, t in events
        ]
        return spark.createDataFrame(rows, "event_json STRING, event_key STRING, produced_at BIGINT")

    root = str(tmp_path / "sinks")
    ids = lambda sink: sorted(r.event_id for r in ls.read_sink(spark, root, sink).collect())
    t = 1_700_000_000
    assert ls.refine_batch(batch((1, t), (2, t - 5000), (1, t)), 0, root, 600)
    assert ids(ls.CLEAN) == [1, 2] and ids(ls.LATE) == []  # nothing is late in the batch that moves the watermark
    second = batch((3, t - 700), (2, t - 5000), (4, t - 100), (1, t), (3, t - 700))
    real = store.commit
    monkeypatch.setattr(store, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ls.refine_batch(second, 1, root, 600)
    assert ids(ls.CLEAN) == [1, 2]  # files without a commit are not seen
    monkeypatch.setattr(store, "commit", real)
    assert ls.refine_batch(second, 1, root, 600) and not ls.refine_batch(second, 1, root, 600)
    # 2 is a late copy of a clean row, so nothing is lost; 3 is lost twice.
    assert ids(ls.CLEAN) == [1, 2, 4] and ids(ls.LATE) == [3, 3]
    assert ls.refine_batch(batch(), 2, root, 600) and ids(ls.CLEAN) == [1, 2, 4]
