"""Only rows whose key may be repeated are moved; payloads are made on all cores."""

from pyspark.sql import functions as F

from siltbed.operators.checks import coverage_check
from siltbed.operators.dedup import KEY, repeated_keys, with_hash
from siltbed.plans.refine import clean_events, clean_staged, refine
from siltbed.sources.recast import inbox, raw_changes

DATA = "/root/testdata/sf0.001"


def test_repeated_keys_are_those_of_the_rows_alone(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), (None,)], f"{KEY} string")
    known = spark.createDataFrame([("b",), ("d",), ("d",)], f"{KEY} string")
    hashes = repeated_keys(rows, known=known)
    moved = [r[0] for r in with_hash(rows, hashes).orderBy(KEY).collect()]
    assert moved == [None, None, "a", "a", "b"]
    assert [r[0] for r in with_hash(rows, hashes, False).collect()] == ["c"]


def test_clean_staged_equals_clean_events_and_moves_few_rows(spark, tmp_path, monkeypatch):
    from siltbed.plans import refine as plan

    refine(inbox(spark, DATA)).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    moved = []
    monkeypatch.setattr(plan, "clean_events", lambda rows: moved.append(rows.count()) or clean_events(rows))
    found, wanted = clean_staged(staged), clean_events(staged)
    assert found.columns == wanted.columns and wanted.count() > 100
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    assert 0 < moved[0] < staged.count() / 10
    # Were all hashes to collide, the exact step would see every row, and the result would be the same.
    monkeypatch.setattr(plan, "repeated_keys", lambda rows: rows.select(F.xxhash64(KEY).alias("_hash")).distinct())
    again = clean_staged(staged)
    assert again.exceptAll(wanted).isEmpty() and wanted.exceptAll(again).isEmpty()


def test_coverage_counts_and_a_kept_row_without_payload(spark):
    """A rejected row without a payload that quarantine holds is not missing; before it was counted."""
    flagged = spark.createDataFrame(
        [("a", "1", True), ("a", "1", True), ("b", "2", True), ("c", "3", True), ("d", None, False), ("e", "5", False)],
        f"{KEY} string, event_json string, _dq_passed boolean",
    )
    good, bad = flagged.filter("_dq_passed"), flagged.filter("NOT _dq_passed")

    def counts(silver, rejected):
        return {r.check_name: r.violations for r in coverage_check(flagged, silver, rejected, KEY).collect()}

    names = ("clean_keys_missing", "silver_keys_repeated", "rejected_payloads_missing")
    assert counts(good.dropDuplicates([KEY]), bad) == dict.fromkeys(names, 0)
    assert counts(good.filter(f"{KEY} <> 'c'"), bad.filter("event_json IS NULL")) == dict.fromkeys(names, 1)
    assert counts(good.filter("false"), bad.filter("false")) == dict(zip(names, (3, 0, 2)))


def test_payloads_are_made_on_all_cores(spark):
    made = raw_changes(spark, DATA)
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert made.count() == spark.read.parquet(f"{DATA}/events.parquet").count()
