"""Plans and balance: what must hold when the tables are large and one key is hot."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siltbed.functions.joins import top_per_group
from siltbed.registry import all_registries
from siltbed.operators import chunks, facts
from siltbed.operators.dedup import dedup_batch
from siltbed.registry import events_gold

DATA = "/root/testdata/sf0.001"
# Queries that drain a stream, publish or store an index while they are built.
EAGER = re.compile("stream|append_sink|rerun|late_ledger|landing|publish|create_if|backup|feed_|corpus_commit|prepare_corpus|reference_history|generation_from_feed|retrieve_(vector|keyword|hybrid)")
PYTHON = {"md_sections", "md_blocks", "chunk_markdown"}
LIBRARY = {n: q for r in all_registries() for n, q in r.queries.items()}
LAZY = [n for n in LIBRARY if not EAGER.search(n)]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_no_cross_joins_and_no_row_at_a_time_python(spark, no_broadcast):
    for name in LAZY:
        text = plan(LIBRARY[name](spark, DATA))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
        assert "BatchEvalPython" not in text, name
        if name not in PYTHON:
            assert "Python" not in text and "InPandas" not in text, name


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(entry.queries()["merge_plan"](spark, DATA))
    schema = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schema and all("o_orderdate" not in s for s in schema)
    rows = spark.read.parquet(f"{DATA}/conversations.parquet")
    text = plan(entry.queries()["question_language"](spark, DATA))
    assert "EqualTo(role,user)" in text and "role" in rows.columns


def test_parsing_happens_once(spark):
    """A copied parse would appear in the filter above it."""
    text = events_gold.silver(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_small_dimension_is_broadcast_without_a_hint(spark):
    assert "BroadcastHashJoin" in plan(events_gold.fact(spark, DATA))


def test_duplicates_and_top_k_are_cut_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    for frame in (dedup_batch(rows, "k", [F.asc("id")]), top_per_group(rows, ["k"], [F.asc("id")], 3)):
        text = plan(frame)
        below = text[text.index("Exchange") :]
        assert "WindowGroupLimit" in below and text.count("WindowGroupLimit") >= 2


def test_lookups_are_broadcast_by_size_only(spark):
    """Below the threshold a lookup is broadcast; just above it both sides are shuffled."""
    clean = events_gold.silver(spark, DATA)
    projects = events_gold.projects(spark, DATA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert "BroadcastHashJoin" not in plan(facts.fact_edits(clean, projects))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fact_join_is_whole_on_the_shuffle_path(spark, no_broadcast):
    clean = events_gold.silver(spark, DATA)
    built = facts.fact_edits(clean, events_gold.projects(spark, DATA))
    assert built.count() == clean.count()


def test_fingerprint_never_collects(spark, no_broadcast):
    rows = spark.range(50).select(
        F.lit("c").alias("corpus_id"), *[F.col("id").cast("string").alias(f) for f in chunks.VERSION_FIELDS[:-1]],
        F.timestamp_seconds("id").alias("fetched_at"),
    )
    text = plan(chunks.generation(rows))
    assert "collect_list" not in text and "partial_sum" in text


def test_kpi_summary_reads_once_and_copies_no_row(spark, no_broadcast):
    from siltbed.plans import analytics

    columns = (
        "event_id LONG, title STRING, event_time TIMESTAMP, editor_type_key INT, byte_change LONG, abs_byte_change LONG, "
        "is_minor_edit BOOLEAN"
    )
    text = plan(analytics.kpi_summary(spark.createDataFrame([], columns)))
    assert "Expand" not in text and text.count("Scan") == 1 and "partial_" in text
    row = analytics.kpi_summary(spark.createDataFrame([], columns)).first()
    assert (row.total_edits, row.active_pages, row.bot_share, row.edits_per_minute) == (0, 0, None, None)
