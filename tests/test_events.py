"""Parsing, rules, keys, duplicates."""

import json

import pytest
from pyspark.sql import functions as F

from siltbed.operators import parse, quality
from siltbed.operators.dedup import KEY, dedup_batch, event_key
from siltbed.plans.refine import clean_events, quarantined_events, refine
from siltbed.schemas import INBOX, PAYLOAD, column_names
from siltbed.sources import capture, inbox

BASE = {
    "id": 7, "type": "edit", "namespace": 0, "title": "T", "timestamp": 1_700_000_000,
    "user": "someone", "bot": False, "minor": True, "wiki": "enwiki",
    "meta": {"id": "m-7", "domain": "en.example.org", "dt": "2023-11-14T22:13:20Z"},
    "length": {"old": 100, "new": 140},
    "_producer": {"source": "p", "producer_timestamp_utc": "2023-11-14T22:13:21+00:00"},
}


def event(**changes):
    return json.dumps({**BASE, **changes})


def parsed(spark, *texts, **kw):
    return parse.parse_events(spark.createDataFrame([(t,) for t in texts], "event_json STRING"), **kw)


def test_valid_event(spark):
    row = parsed(spark, event()).first()
    assert (row.event_id, row.editor_type, row.byte_change, row.abs_byte_change) == (7, "human", 40, 40)
    assert row.event_time == row.event_time_utc and row.producer_timestamp_utc is not None
    assert row._parse_error is False
    assert set(parse.FLAT_COLUMNS.values()) <= set(row.asDict())


@pytest.mark.parametrize(
    "text,event_id,error",
    [
        ("{not json", None, True),
        ('{"id":"abc","title":"t"}', None, True),
        ('{"id":1.5}', None, True),
        ('{"id":3,"meta":"str"}', 3, True),
        ("[1]", None, True),
        ("null", None, True),
        ("", None, False),
        ("   ", None, False),
        (None, None, False),
        ('{"id":5} trailing', 5, False),
    ],
)
def test_parse_truth_table(spark, text, event_id, error):
    row = parsed(spark, text).first()
    assert (row.event_id, row._parse_error) == (event_id, error)


def test_legacy_mode_flags_only_missing_values(spark):
    rows = parsed(spark, "{not json", "", None, event(), mode="legacy").collect()
    assert [r._parse_error for r in rows] == [False, True, True, False]
    assert "meta_id" not in rows[0].asDict()


def test_hostile_values_become_null(spark):
    huge = event(timestamp=10**17, meta={**BASE["meta"], "dt": "soon"})
    far = event(length={"old": -(2**63), "new": 5})
    edge = event(length={"old": 2**62, "new": -(2**62)})
    rows = parsed(spark, huge, far, edge).collect()
    assert rows[0].event_time is None and rows[0].event_time_utc is None
    assert rows[1].byte_change is None and rows[1].abs_byte_change is None
    assert rows[2].byte_change == -(2**63) and rows[2].abs_byte_change is None


def test_missing_parts(spark):
    old = {k: v for k, v in BASE.items() if k not in ("_producer", "bot")}
    row = parsed(spark, json.dumps(old)).first()
    assert row.producer_source is None and row.editor_type == "human" and not row._parse_error


def test_editor_and_titles(spark):
    assert parsed(spark, event(bot=True)).first().editor_type == "bot"
    titles = spark.createDataFrame([("Main_Page",), (" Python_Data ",), (None,)], "title STRING")
    assert [r.title for r in parse.clean_titles(titles).collect()] == ["main_page", "python_data"]


@pytest.mark.parametrize(
    "changes,reasons",
    [
        ({}, []),
        ({"id": None}, ["valid_event_id"]),
        ({"timestamp": None}, ["valid_event_time"]),
        ({"wiki": " "}, ["valid_wiki_domain"]),
        ({"wiki": None}, ["valid_wiki_domain"]),
        ({"meta": {"id": "x", "domain": ""}}, ["valid_wiki_domain"]),
        ({"length": {"old": -1, "new": 3}}, ["valid_length"]),
        ({"length": None}, []),
        ({"id": None, "length": {"old": 1, "new": -3}}, ["valid_event_id", "valid_length"]),
    ],
)
def test_rules(spark, changes, reasons):
    row = quality.dq_flags(parsed(spark, event(**changes))).first()
    assert row._dq_failure_reasons == reasons and row._dq_passed == (not reasons)


def test_undecided_rule_counts_as_broken(spark):
    rows = spark.createDataFrame([(None,), (3,)], "x INT")
    flags = [r._dq_passed for r in quality.dq_flags(rows, {"small": "x < 5"}).collect()]
    assert flags == [False, True]
    warned = quality.expect_warn(rows, {"small": "x < 5", "any": "true"}).collect()
    assert {r.rule: r.violations for r in warned} == {"small": 1, "any": 0}
    assert quality.expect_drop(rows, {"small": "x < 5"}).count() == 1


def test_future_rule_is_optional(spark):
    rules = {**quality.EVENT_RULES, **quality.future_time_rule()}
    raw = spark.createDataFrame([(event(timestamp=4_000_000_000), "k", 1)], INBOX)
    assert refine(raw, rules).first()._dq_failure_reasons == ["plausible_event_time"]


def test_observed_rules(spark):
    from pyspark.sql import Observation

    seen = Observation("rules")
    rows = quality.dq_flags(parsed(spark, event(), event(id=None)))
    counts = [F.count_if(~F.col("_dq_valid_event_id")).alias("bad")]
    rows.observe(seen, *counts).count()
    assert seen.get["bad"] == 1
    assert quality.observe_rules(rows, "n", quality.EVENT_RULES).count() == 2


def test_keys(spark):
    keyed = event_key(parsed(spark, event(), event(meta={"domain": "d"}), "{a", "{b")).collect()
    assert keyed[0][KEY] == "m-7"
    others = {r[KEY] for r in keyed[1:]}
    assert len(others) == 3 and all(len(k) == 64 for k in others)


def test_fallback_key_is_the_documented_digest(spark):
    from hashlib import sha256

    text = event(meta={"domain": "d"})
    row = event_key(parsed(spark, text, "{bad")).collect()
    assert row[0][KEY] == sha256(f"enwiki|7|1700000000|{text}".encode()).hexdigest()
    assert row[1][KEY] == sha256(b"|||{bad").hexdigest()


def test_duplicates(spark):
    keyed = event_key(parsed(spark, event(), event(), event(id=8, meta={**BASE["meta"], "id": "m-8"})))
    assert dedup_batch(keyed).count() == 2
    first = dedup_batch(keyed, order=[F.asc("event_id")])
    assert sorted(r.event_id for r in first.collect()) == [7, 8]


def test_valid_first_keeps_the_valid_twin(spark):
    twin = event(length={"old": -5, "new": 1}, timestamp=1_600_000_000)
    raw = spark.createDataFrame([(event(), "m-7", 1), (twin, "m-7", 2)], INBOX)
    flagged = refine(raw)
    assert clean_events(flagged).count() == 1
    assert clean_events(flagged, valid_first=False).count() == 0
    assert quarantined_events(flagged).first()._quality_status == "quarantined"


def test_decoders(spark):
    raw = spark.createDataFrame([(event(), "m-7", 1)], INBOX)
    contract = set(parse.CARRIED)
    assert set(inbox.decode_inbox(raw).columns) == contract
    bus = spark.createDataFrame(
        [(bytearray(b"{}"), "t", 1, 5)], "value BINARY, topic STRING, partition INT, offset BIGINT"
    ).withColumn("timestamp", F.current_timestamp())
    assert set(inbox.bronze_metadata(inbox.decode_bus(bus)).columns) == contract
    options = inbox.bus_options("host:9092", "changes", maxOffsetsPerTrigger="10")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10" and options["subscribe"] == "changes"


def test_schema_is_declared():
    assert column_names(PAYLOAD)[-3:] == ["meta", "length", "_producer"]


def test_admission_order(spark):
    texts = {
        "{": "malformed", "[]": "malformed", json.dumps({"type": "edit"}): "malformed",
        event(meta={"domain": "canary"}, type="log"): "canary",
        event(type="log"): "change_type", event(meta={"id": " ", "domain": "x.org"}): "domain",
        event(meta={"id": " ", "domain": "a.example.org"}): "missing_id", event(): None,
    }
    raw = spark.createDataFrame([(t,) for t in texts], "event_json STRING")
    labelled = capture.admit_events(raw, "edit", "example.org")
    assert {r.event_json: r.drop_reason for r in labelled.collect()} == texts
    counts = {r.outcome: r.events for r in capture.admission_metrics(labelled).collect()}
    assert counts["kept"] == 1 and counts["malformed"] == 3
    assert capture.observe_admission(labelled).count() == len(texts)


def test_stamp_keeps_unknown_fields(spark):
    raw = spark.createDataFrame([(event(extra={"deep": [1, None, "x"]}, big=2**70),)], "event_json STRING")
    row = capture.stamp_producer(raw, F.lit("2024-02-01").cast("timestamp")).first()
    out = json.loads(row.event_json)
    assert out["extra"] == {"deep": [1, None, "x"]} and out["big"] == 2**70
    assert out["_producer"]["source"] == capture.PRODUCER and row.event_key == "m-7"
    assert row.produced_at == 1_706_745_600_000_000


def test_validation_reports_every_rule(spark):
    good = (event(), "m-7", 5)
    assert capture.validate_batch(spark.createDataFrame([good], INBOX)).count() == 0
    bad = spark.createDataFrame([good, good, ("{", " ", 0), (event(type="log"), "z", None)], INBOX)
    found = {r.rule: r.violations for r in capture.validate_batch(bad).collect()}
    assert found == {
        "blank_key": 1, "repeated_key": 1, "bad_time": 2, "payload_not_object": 1,
        "key_mismatch": 1, "wrong_type": 1,
    }
    empty = {r.rule for r in capture.validate_batch(spark.createDataFrame([], INBOX)).collect()}
    assert empty == {"empty"}
    other = spark.createDataFrame([("x",)], "event_json STRING")
    assert capture.validate_batch(other).first().rule == "schema"


def test_replay_and_visibility(spark):
    records = spark.createDataFrame([("{}", k, t) for t, k in enumerate("abcde")], INBOX)
    twice = capture.replay_with_duplicates(records, 2, ["produced_at"])
    assert twice.count() == 7
    assert capture.first_wins(twice, "produced_at").count() == 5
    seen = capture.inbox_visibility(records, twice.filter("event_key <> 'c'")).first()
    assert (seen.expected_keys, seen.visible_keys, seen.complete) == (5, 4, False)
    assert capture.inbox_visibility(records, twice).first().complete


def test_backfill_is_repeatable(spark):
    history = spark.createDataFrame(
        [(event(),), (event(),), (None,), ("{x",)], "event_json STRING"
    ).withColumn("_ingested_at", F.lit(None).cast("timestamp"))
    held = spark.createDataFrame([("{x", "k", 1)], INBOX)
    copied = capture.backfill_missing(history, held)
    assert copied.count() == 3 and capture.backfill_coverage(history, held).first().missing == 3
    whole = held.unionByName(copied)
    assert capture.backfill_missing(history, whole).count() == 0
    assert capture.backfill_coverage(history, whole).first().missing == 0
