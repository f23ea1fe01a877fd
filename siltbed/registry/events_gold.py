"""Registered queries: event refinement, star schema, analytics, checks, alerts, policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.masking import mask_ip, mask_user, register_masks
from siltbed.functions.plans import stored
from siltbed.operators import alerts, checks, dimensions, facts, parse, policies, quality
from siltbed.operators.dedup import KEY, dedup_batch, duplicate_payloads, event_key, key_kinds
from siltbed.plans import analytics as an
from siltbed.plans.refine import clean_events, quarantined_events, refine
from siltbed.registry.base import Registry
from siltbed.registry.oracle_events import LANGUAGE_CASE, on_events, on_reference, on_star
from siltbed.sources import inbox as src
from siltbed.sources.recast import event_base, inbox, raw_changes, reference, tables

R = Registry()


def fixed_now() -> Column:
    """The clock of every registered query, so that results can be repeated."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return refine(inbox(spark, d), now=fixed_now())


def silver(spark: SparkSession, d: str) -> DataFrame:
    return clean_events(flagged(spark, d))


def projects(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_project(reference(spark, d), now=fixed_now())


def calendar(spark: SparkSession, d: str) -> DataFrame:
    times = event_base(spark, d).select(F.timestamp_micros("us").alias("t"))
    return dimensions.dim_date(dimensions.calendar_bounds(times, "t"))


def fact(spark: SparkSession, d: str) -> DataFrame:
    return facts.fact_edits(silver(spark, d), projects(spark, d), now=fixed_now())


def editors(spark: SparkSession) -> DataFrame:
    return dimensions.dim_editor_type(spark)


# --- parsing -------------------------------------------------------------------------------

_PARSED = """event_id, event_type, namespace, title, event_timestamp_unix, "user", bot, minor, wiki,
  meta_id, domain, length_old, length_new, producer_source, _parse_error, editor_type,
  byte_change, abs_byte_change"""
_PARSED_COLUMNS = [c.strip().strip('"') for c in _PARSED.replace("\n", " ").split(",")]


@R.query("parse_events", on_events(f"SELECT {_PARSED} FROM delivered"))
def _(spark, d):
    return parse.parse_events(src.decode_inbox(inbox(spark, d))).select(_PARSED_COLUMNS)


@R.query(
    "event_times",
    on_events(
        "SELECT e, event_timestamp_unix AS event_epoch, utc_epoch, producer_epoch FROM flagged"
    ),
)
def _(spark, d):
    raw = raw_changes(spark, d).withColumn("payload", F.from_json("event_json", parse.PAYLOAD))
    return raw.select(
        "e", *[v.alias(n) for n, v in parse.event_times().items()]
    ).select(
        "e",
        F.unix_seconds("event_time").alias("event_epoch"),
        F.unix_seconds("event_time_utc").alias("utc_epoch"),
        F.unix_seconds("producer_timestamp_utc").alias("producer_epoch"),
    )


@R.query(
    "editor_class",
    on_events("SELECT bot, editor_type, count(*) AS n FROM delivered GROUP BY ALL"),
)
def _(spark, d):
    rows = parse.parse_events(src.decode_inbox(inbox(spark, d)))
    return rows.groupBy("bot", "editor_type").agg(F.count("*").alias("n"))


@R.query(
    "byte_deltas",
    on_events(
        "SELECT event_id, length_old, length_new, byte_change, abs_byte_change FROM flagged WHERE event_id IS NOT NULL"
    ),
)
def _(spark, d):
    raw = raw_changes(spark, d).drop("e", "us", "event_key")
    return (
        parse.parse_events(raw)
        .filter("event_id IS NOT NULL")
        .select("event_id", "length_old", "length_new", "byte_change", "abs_byte_change")
    )


# Legacy mode reads the same fields; it flags only rows without any JSON value.
@R.query(
    "legacy_parse",
    on_events(
        """SELECT event_id, event_type, title, wiki, domain, length_old, length_new, editor_type,
  false AS _parse_error FROM delivered"""
    ),
)
def _(spark, d):
    rows = parse.parse_events(src.decode_inbox(inbox(spark, d)), mode="legacy")
    return rows.select(
        "event_id", "event_type", "title", "wiki", "domain", "length_old", "length_new",
        "editor_type", "_parse_error",
    )


@R.query(
    "clean_titles",
    on_events("SELECT e, lower(trim(title)) AS title FROM flagged WHERE title IS NOT NULL"),
)
def _(spark, d):
    raw = raw_changes(spark, d).withColumn(
        "title", F.from_json("event_json", parse.PAYLOAD).getField("title")
    )
    return parse.clean_titles(raw.select("e", "title"))


@R.query(
    "null_fallbacks",
    on_events(
        """SELECT e, coalesce(minor, false) AS minor, coalesce(wiki, 'unknown') AS wiki,
  coalesce(event_timestamp_unix, 1706745600) AS event_epoch FROM flagged"""
    ),
)
def _(spark, d):
    raw = raw_changes(spark, d)
    parsed = parse.parse_events(raw.withColumn("_source", F.col("e").cast("string")), now=fixed_now())
    filled = parse.null_fallbacks(
        parsed, {"minor": False, "wiki": "unknown", "event_time": F.col("silver_ingested_at")}
    )
    return filled.select(
        F.col("_source").cast("long").alias("e"), "minor", "wiki",
        F.unix_seconds("event_time").alias("event_epoch"),
    )


# --- sources -------------------------------------------------------------------------------


@R.query(
    "decode_bus",
    on_events(
        """SELECT 'changes' AS kafka_topic, CAST(e % 8 AS INTEGER) AS kafka_partition, e AS kafka_offset,
  us // 1000000 AS enqueued_epoch, event_id FROM flagged"""
    ),
)
def _(spark, d):
    records = raw_changes(spark, d).select(
        F.col("event_json").cast("binary").alias("value"),
        F.lit("changes").alias("topic"),
        F.expr("CAST(e % 8 AS INT)").alias("partition"),
        F.col("e").alias("offset"),
        F.timestamp_micros("us").alias("timestamp"),
    )
    decoded = src.decode_bus(records)
    return decoded.select(
        "kafka_topic", "kafka_partition", "kafka_offset",
        F.unix_seconds("kafka_enqueued_at").alias("enqueued_epoch"),
        F.from_json("event_json", parse.PAYLOAD).getField("id").alias("event_id"),
    )


@R.query(
    "decode_inbox",
    on_events(
        """SELECT event_id, 'inbox_recent_change' AS _source, CAST(NULL AS VARCHAR) AS kafka_topic,
  CAST(NULL AS BIGINT) AS kafka_offset, 1706745600::BIGINT AS ingested_epoch, '2024-02-01' AS load_date
FROM delivered"""
    ),
)
def _(spark, d):
    return src.decode_inbox(inbox(spark, d), now=fixed_now()).select(
        F.from_json("event_json", parse.PAYLOAD).getField("id").alias("event_id"),
        "_source", "kafka_topic", "kafka_offset",
        F.unix_seconds("_ingested_at").alias("ingested_epoch"),
        F.col("_load_date").cast("string").alias("load_date"),
    )


@R.query(
    "bronze_metadata",
    on_events(
        """SELECT event_key, 'bus_recent_change' AS _source, '2024-02-01' AS load_date FROM (
  SELECT coalesce(CASE WHEN e % 71 <> 0 THEN concat('evt-', CAST(e AS VARCHAR)) END,
    concat('raw-', CAST(e AS VARCHAR))) AS event_key FROM delivered)"""
    ),
)
def _(spark, d):
    return src.bronze_metadata(inbox(spark, d), now=fixed_now()).select(
        "event_key", "_source", F.col("_load_date").cast("string").alias("load_date")
    )


# --- quality -------------------------------------------------------------------------------

_FLAGS = """_dq_valid_json, _dq_valid_event_id, _dq_valid_event_time, _dq_valid_wiki_domain,
_dq_valid_length, _dq_passed"""


@R.query(
    "dq_flags",
    on_events(
        """SELECT event_id, ok_json AS _dq_valid_json, ok_id AS _dq_valid_event_id, ok_time AS _dq_valid_event_time,
  ok_wiki AS _dq_valid_wiki_domain, ok_length AS _dq_valid_length, passed AS _dq_passed, reasons
FROM delivered"""
    ),
)
def _(spark, d):
    return flagged(spark, d).select(
        "event_id",
        *[c.strip() for c in _FLAGS.split(",")],
        F.array_join("_dq_failure_reasons", ",").alias("reasons"),
    )


@R.query(
    "event_rules",
    on_events(
        """SELECT count(*) FILTER (NOT ok_json) AS valid_json, count(*) FILTER (NOT ok_id) AS valid_event_id,
  count(*) FILTER (NOT ok_time) AS valid_event_time, count(*) FILTER (NOT ok_wiki) AS valid_wiki_domain,
  count(*) FILTER (NOT ok_length) AS valid_length FROM delivered"""
    ),
)
def _(spark, d):
    return flagged(spark, d).agg(
        *[F.count_if(~F.col(f"_dq_{name}")).alias(name) for name in quality.EVENT_RULES]
    )


@R.query(
    "reference_rules",
    on_reference(
        """SELECT wiki_code, wiki_code IS NOT NULL AS _dq_valid_wiki_code,
  site_url IS NULL OR site_url LIKE 'http%' AS _dq_valid_url,
  wiki_code IS NOT NULL AND (site_url IS NULL OR site_url LIKE 'http%') AS _dq_passed FROM ref"""
    ),
)
def _(spark, d):
    return quality.dq_flags(reference(spark, d), quality.REFERENCE_RULES).select(
        "wiki_code", "_dq_valid_wiki_code", "_dq_valid_url", "_dq_passed"
    )


@R.query(
    "split_good_bad",
    on_events("SELECT passed AS good, count(*) AS n, count(event_id) AS with_id FROM delivered GROUP BY 1"),
)
def _(spark, d):
    rows = flagged(spark, d)
    good = quality.good_rows(rows).select(F.lit(True).alias("good"), "event_id")
    bad = quality.bad_rows(rows).select(F.lit(False).alias("good"), "event_id")
    return good.unionByName(bad).groupBy("good").agg(
        F.count("*").alias("n"), F.count("event_id").alias("with_id")
    )


@R.query(
    "quarantine",
    on_events(
        "SELECT event_id, meta_id, wiki, reasons, 'quarantined' AS _quality_status FROM delivered WHERE NOT passed"
    ),
)
def _(spark, d):
    return quarantined_events(flagged(spark, d)).select(
        "event_id", "meta_id", "wiki",
        F.array_join("_dq_failure_reasons", ",").alias("reasons"), "_quality_status",
    )


@R.query(
    "reference_quarantine",
    on_reference(
        "SELECT wiki_code, site_url, 'quarantined' AS _quality_status FROM ref WHERE site_url NOT LIKE 'http%'"
    ),
)
def _(spark, d):
    rows = quality.dq_flags(reference(spark, d), quality.REFERENCE_RULES)
    return quality.quarantine(rows).select("wiki_code", "site_url", "_quality_status")


@R.query(
    "expect_warn",
    on_events(
        """SELECT 'titled' AS rule, count(*) FILTER (title IS NULL OR trim(title) = '') AS violations, count(*) AS total_rows FROM delivered
UNION ALL SELECT 'sized', count(*) FILTER (byte_change IS NULL), count(*) FROM delivered
UNION ALL SELECT 'grown', count(*) FILTER (byte_change IS NULL OR byte_change < 0), count(*) FROM delivered"""
    ),
)
def _(spark, d):
    rules = {
        "titled": "length(trim(title)) > 0",
        "sized": "byte_change IS NOT NULL",
        "grown": "byte_change >= 0",
    }
    return quality.expect_warn(flagged(spark, d), rules)


@R.query(
    "expect_drop",
    on_events("SELECT event_id, wiki, length_new FROM delivered WHERE passed"),
)
def _(spark, d):
    return quality.expect_drop(
        parse.parse_events(src.decode_inbox(inbox(spark, d))), quality.EVENT_RULES
    ).select("event_id", "wiki", "length_new")


@R.query(
    "rejects_by_reason",
    on_events(
        """SELECT reason, count(*) AS rejected FROM (
  SELECT unnest(string_split(reasons, ',')) AS reason FROM delivered WHERE NOT passed) GROUP BY 1"""
    ),
)
def _(spark, d):
    return quality.rejects_by_reason(quarantined_events(flagged(spark, d)))


@R.query(
    "rejects_by_reason_set",
    on_events("SELECT reasons, count(*) AS rejected FROM delivered WHERE NOT passed GROUP BY 1"),
)
def _(spark, d):
    found = quality.rejects_by_reason_set(quarantined_events(flagged(spark, d)))
    return found.select(F.array_join("_dq_failure_reasons", ",").alias("reasons"), "rejected")


@R.query(
    "parse_error_rate",
    on_events('SELECT _parse_error, count(*) AS "rows" FROM delivered GROUP BY 1'),
)
def _(spark, d):
    return quality.parse_error_rate(flagged(spark, d))


# --- deduplication -------------------------------------------------------------------------


@R.query(
    "event_key",
    on_events(
        """SELECT key_kind, count(*) AS "rows", count(DISTINCT e) AS keys FROM (
  SELECT e, CASE WHEN meta_id IS NOT NULL THEN 'meta_id' ELSE 'content_hash' END AS key_kind FROM delivered)
GROUP BY 1"""
    ),
)
def _(spark, d):
    return key_kinds(flagged(spark, d))


@R.query(
    "dedup_batch",
    on_events("SELECT event_id, meta_id, _parse_error FROM flagged"),
)
def _(spark, d):
    rows = event_key(parse.parse_events(src.decode_inbox(inbox(spark, d))))
    return dedup_batch(rows).select("event_id", "meta_id", "_parse_error")


@R.query(
    "duplicate_payloads",
    on_events("SELECT event_id, count(*) AS deliveries FROM delivered GROUP BY e, event_id HAVING count(*) > 1"),
)
def _(spark, d):
    found = duplicate_payloads(inbox(spark, d))
    return found.select(
        F.from_json("event_json", parse.PAYLOAD).getField("id").alias("event_id"), "deliveries"
    )


@R.query(
    "clean_events",
    on_events(
        """SELECT event_id, event_type, wiki, domain, title, "user", editor_type, byte_change FROM silver"""
    ),
)
def _(spark, d):
    return silver(spark, d).select(
        "event_id", "event_type", "wiki", "domain", "title", "user", "editor_type", "byte_change"
    )


# --- dimensions and fact -------------------------------------------------------------------


@R.query(
    "dim_date",
    on_star(
        """SELECT date_key, CAST(calendar_date AS VARCHAR) AS calendar_date, "year", "quarter", "month",
  month_name, "day", day_of_week, day_name, is_weekend FROM dim_date"""
    ),
)
def _(spark, d):
    return calendar(spark, d).withColumn("calendar_date", F.col("calendar_date").cast("string"))


@R.query(
    "dim_project",
    on_star(
        "SELECT project_key, wiki_code, language_code, language_name, project_name, site_url FROM dim_project"
    ),
)
def _(spark, d):
    return projects(spark, d).drop("gold_updated_at")


@R.query(
    "language_names",
    on_reference(f"SELECT wiki_code, language_code, {LANGUAGE_CASE} AS language_name FROM ref"),
)
def _(spark, d):
    code = F.coalesce("language_code", F.lit("unknown"))
    return reference(spark, d).select(
        "wiki_code", "language_code", dimensions.language_name(code).alias("language_name")
    )


# A published list that knows every second code of the test tables.
@R.query(
    "language_names_listed",
    on_reference("""SELECT wiki_code, coalesce(language_code, 'unknown') AS language_code,
  CASE WHEN language_code IS NULL THEN 'Other / Technical' WHEN ascii(right(language_code, 1)) % 2 = 0 THEN concat('Name of ', language_code)
    ELSE concat('ISO: ', upper(language_code)) END AS language_name FROM ref
UNION ALL SELECT 'unknown', 'unknown', 'Other / Technical'"""),
)
def _(spark, d):
    rows = reference(spark, d)
    known = rows.select("language_code").distinct().filter(F.ascii(F.right("language_code", F.lit(1))) % 2 == 0)
    names = known.select(F.upper("language_code").alias("language_code"), F.concat(F.lit("Name of "), "language_code").alias("language_name"))
    return dimensions.dim_project(rows, fixed_now(), names).select("wiki_code", "language_code", "language_name")


@R.query(
    "language_code_census",
    on_reference("SELECT language_code, count(*) AS projects FROM ref GROUP BY 1"),
)
def _(spark, d):
    return dimensions.language_code_census(reference(spark, d))


@R.query(
    "dim_editor_type",
    on_star(
        """SELECT d.editor_type_key, d.is_bot, d.editor_type_desc, count(*) AS facts
FROM dim_editor d JOIN fact f USING (editor_type_key) GROUP BY ALL"""
    ),
)
def _(spark, d):
    used = fact(spark, d).groupBy("editor_type_key").agg(F.count("*").alias("facts"))
    return editors(spark).join(used, "editor_type_key")


@R.query(
    "fact_edits",
    on_star(
        """SELECT event_id, date_key, project_key, editor_type_key, "user", title, event_epoch,
  length_old, length_new, byte_change, abs_byte_change, is_minor_edit FROM fact"""
    ),
)
def _(spark, d):
    return (
        fact(spark, d)
        .withColumn("event_epoch", F.unix_seconds("event_time"))
        .drop("event_time", "gold_ingested_at")
    )


@R.query(
    "fact_preflight",
    on_star(
        """SELECT (SELECT count(*) FROM dim_date) AS dates, (SELECT count(*) FROM dim_editor) AS editor_types,
  (SELECT count(*) FROM dim_project WHERE wiki_code <> 'unknown') AS projects,
  (SELECT count(*) FROM dim_project WHERE wiki_code = 'unknown') AS fallback_projects, true AS ready"""
    ),
)
def _(spark, d):
    return facts.fact_preflight(calendar(spark, d), editors(spark), projects(spark, d))


@R.query(
    "reference_gate",
    on_reference(
        """SELECT count(*) AS projects, count(DISTINCT wiki_code) AS unique_projects,
  count(*) > 0 AND count(*) = count(DISTINCT wiki_code) AS publishable FROM ref"""
    ),
)
def _(spark, d):
    return facts.reference_gate(reference(spark, d))


# --- analytics -----------------------------------------------------------------------------


@R.query(
    "top_languages",
    on_star(
        """SELECT p.language_name, p.project_name,
  CAST(sum(CASE WHEN ed.editor_type_desc = 'Bot' THEN 1 ELSE 0 END) AS BIGINT) AS bot_edits,
  CAST(sum(CASE WHEN ed.editor_type_desc = 'Human' THEN 1 ELSE 0 END) AS BIGINT) AS human_edits,
  count(f.event_id) AS total_edits, CAST(sum(f.abs_byte_change) AS BIGINT) AS total_bytes_altered
FROM fact f JOIN dim_project p USING (project_key) JOIN dim_editor ed USING (editor_type_key)
JOIN dim_date dd USING (date_key) GROUP BY 1, 2 ORDER BY total_edits DESC, 1, 2 LIMIT 40"""
    ),
)
def top_languages(spark, d):
    return an.top_languages(
        fact(spark, d), projects(spark, d), editors(spark), calendar(spark, d)
    )


@R.query(
    "bot_vs_human",
    on_star(
        """SELECT editor_type_desc, count(event_id) AS total_edits, round(avg(abs_byte_change), 1) AS avg_byte_change,
  CAST(round(sum(CASE WHEN is_minor_edit THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS DOUBLE) AS minor_edit_pct
FROM fact JOIN dim_editor USING (editor_type_key) GROUP BY 1"""
    ),
)
def _(spark, d):
    return an.bot_vs_human(fact(spark, d), editors(spark))


@R.query(
    "edits_timeline",
    on_star(
        """SELECT CAST(event_epoch // 60 * 60 AS BIGINT) AS minute_epoch, editor_type_desc, count(event_id) AS edits_count
FROM fact JOIN dim_editor USING (editor_type_key) GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 60"""
    ),
)
def _(spark, d):
    line = an.edits_timeline(fact(spark, d), editors(spark))
    return line.select(
        F.unix_seconds("event_minute").alias("minute_epoch"), "editor_type_desc", "edits_count"
    )


@R.query(
    "bot_share_by_language",
    on_star(
        """SELECT language_name, count(*) AS edits,
  CAST(round(100.0 * sum(CASE WHEN editor_type_key = 1 THEN 1 ELSE 0 END) / count(*), 1) AS DOUBLE) AS bot_pct
FROM fact JOIN dim_project USING (project_key) GROUP BY 1"""
    ),
)
def _(spark, d):
    return an.bot_share_by_language(fact(spark, d), projects(spark, d))


@R.query(
    "most_edited_pages",
    on_star(
        """SELECT wiki_code, title, count(*) AS edits, CAST(sum(byte_change) AS BIGINT) AS net_bytes
FROM fact JOIN dim_project USING (project_key) GROUP BY 1, 2 ORDER BY edits DESC, 1, 2 LIMIT 20"""
    ),
)
def _(spark, d):
    return an.most_edited_pages(fact(spark, d), projects(spark, d))


@R.query(
    "largest_edits",
    on_star(
        """SELECT event_epoch, title, byte_change FROM (
  SELECT * FROM fact ORDER BY abs_byte_change DESC NULLS LAST, event_id LIMIT 20)"""
    ),
)
def _(spark, d):
    return an.largest_edits(fact(spark, d)).select(
        F.unix_seconds("event_time").alias("event_epoch"), "title", "byte_change"
    )


@R.query(
    "hour_of_day",
    on_star(
        "SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day, count(*) AS edits FROM fact GROUP BY 1"
    ),
)
def _(spark, d):
    return an.hour_of_day(fact(spark, d))


@R.query(
    "weekend_split",
    on_star("SELECT is_weekend, count(*) AS edits FROM fact JOIN dim_date USING (date_key) GROUP BY 1"),
)
def _(spark, d):
    return an.weekend_split(fact(spark, d), calendar(spark, d))


@R.query(
    "fallback_events",
    on_star(
        """SELECT count(*) AS fallback_events FROM fact JOIN dim_project USING (project_key)
WHERE wiki_code = 'unknown'"""
    ),
)
def _(spark, d):
    return an.fallback_events(fact(spark, d), projects(spark, d))


@R.query(
    "kpi_summary",
    on_star(
        """SELECT count(event_id) AS total_edits,
  round(sum(CASE WHEN editor_type_key = 1 THEN 1 ELSE 0 END)::DOUBLE / count(event_id), 4) AS bot_share,
  round(sum(abs_byte_change)::DOUBLE / count(abs_byte_change), 2) AS avg_edit_size,
  CAST(sum(byte_change) AS BIGINT) AS net_content_change,
  round(sum(CASE WHEN is_minor_edit THEN 1 ELSE 0 END)::DOUBLE / count(*), 4) AS minor_edit_ratio,
  round(count(event_id)::DOUBLE / count(DISTINCT event_epoch // 60), 4) AS edits_per_minute,
  count(DISTINCT title) AS active_pages FROM fact"""
    ),
)
def _(spark, d):
    return an.kpi_summary(fact(spark, d))


@R.query(
    "editor_split",
    on_star(
        "SELECT CASE WHEN bot THEN 'Bot' ELSE 'Human' END AS editor_type, count(*) AS total_edits FROM silver GROUP BY 1"
    ),
)
def _(spark, d):
    return an.editor_split(silver(spark, d))


@R.query(
    "top_editors",
    on_star(
        """SELECT "user", CASE WHEN bot THEN 'Bot' ELSE 'Human' END AS editor_type, count(*) AS total_edits
FROM silver GROUP BY 1, 2 ORDER BY total_edits DESC, 1, 2 LIMIT 10"""
    ),
)
def _(spark, d):
    return an.top_editors(silver(spark, d))


@R.query(
    "change_size_stats",
    on_star(
        """SELECT CASE WHEN bot THEN 'Bot' ELSE 'Human' END AS editor_type,
  round(avg(abs_byte_change), 1) AS avg_changed_bytes, max(abs_byte_change) AS max_changed_bytes
FROM silver GROUP BY 1"""
    ),
)
def _(spark, d):
    return an.change_size_stats(silver(spark, d))


@R.query(
    "edits_by_language_raw",
    on_star(
        """SELECT coalesce(r.language_code, s.wiki) AS language, coalesce(r.project_name, 'Other project') AS project,
  CAST(sum(CASE WHEN s.bot THEN 1 ELSE 0 END) AS BIGINT) AS bot_edits,
  CAST(sum(CASE WHEN s.bot = false THEN 1 ELSE 0 END) AS BIGINT) AS human_edits, count(*) AS total_edits
FROM silver s LEFT JOIN ref r ON s.wiki = r.wiki_code GROUP BY 1, 2 ORDER BY total_edits DESC, 1, 2 LIMIT 20"""
    ),
)
def _(spark, d):
    return an.edits_by_language_raw(silver(spark, d), reference(spark, d))


@R.query(
    "top_domains",
    on_star("SELECT domain, count(*) AS edits FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def _(spark, d):
    return an.top_domains(silver(spark, d))


@R.query(
    "language_filtered",
    on_star(
        """SELECT language_code, language_name, count(*) AS edits FROM fact JOIN dim_project USING (project_key)
WHERE language_code NOT IN ('commons', 'wikidata') GROUP BY 1, 2"""
    ),
)
def _(spark, d):
    return an.language_filtered(fact(spark, d), projects(spark, d))


def _windows(name: str, width: str, seconds: int) -> None:
    @R.query(
        name,
        on_events(
            f"""SELECT event_timestamp_unix // {seconds} * {seconds} AS start_epoch,
  event_timestamp_unix // {seconds} * {seconds} + {seconds} AS end_epoch, count(*) AS edits
FROM silver GROUP BY 1, 2"""
        ),
    )
    def _(spark, d):
        return an.tumbling_counts(silver(spark, d), width).select(
            F.unix_seconds("window_start").alias("start_epoch"),
            F.unix_seconds("window_end").alias("end_epoch"),
            "edits",
        )


_windows("hourly_windows", "1 hour", 3600)
_windows("minute_windows", "1 minute", 60)


@R.query(
    "latest_rows",
    on_events(
        """SELECT event_key, produced_at FROM (SELECT us + copy * 1000000 AS produced_at,
  CASE WHEN e % 71 <> 0 THEN concat('evt-', CAST(e AS VARCHAR)) ELSE concat('raw-', CAST(e AS VARCHAR)) END AS event_key
  FROM delivered) ORDER BY produced_at DESC, event_key LIMIT 5"""
    ),
)
def _(spark, d):
    return an.latest_rows(inbox(spark, d).drop("event_json"), "produced_at", ["event_key"])


# --- checks and alerts ---------------------------------------------------------------------


def _broken_star(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The star with faults: projects lost and doubled, days lost, fact rows doubled."""
    number = F.expr("try_cast(regexp_extract(wiki_code, '_([0-9]+)wiki', 1) AS INT)")
    all_projects = projects(spark, d).withColumn("_n", number)
    kept = all_projects.filter("coalesce(_n % 6 <> 2, true)")
    doubled = kept.unionByName(all_projects.filter("_n % 8 = 1")).drop("_n")
    dates = calendar(spark, d).filter("date_key % 5 <> 0")
    clean = stored(silver(spark, d), "clean-events")
    facts_ = facts.fact_edits(clean, projects(spark, d), now=fixed_now())
    more = stored(facts_.unionByName(facts_.filter("event_id % 40 = 3")), "facts")
    return clean, more, doubled, dates


_BROKEN = """,
n_projects AS (SELECT *, TRY_CAST(regexp_extract(wiki_code, '_([0-9]+)wiki', 1) AS INTEGER) AS num FROM dim_project),
bad_projects AS (SELECT * FROM n_projects WHERE coalesce(num % 6 <> 2, true)
  UNION ALL SELECT * FROM n_projects WHERE num % 8 = 1),
bad_dates AS (SELECT * FROM dim_date WHERE date_key % 5 <> 0),
bad_fact AS (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE event_id % 40 = 3)
"""


def on_broken(body: str) -> str:
    return on_star("").rstrip() + _BROKEN + body


_UNIQUE = """SELECT 'unique_project_keys' AS check_name, count(*) AS violations FROM (
  SELECT project_key FROM bad_projects GROUP BY 1 HAVING count(*) > 1)"""
_PROJECT_RI = """SELECT 'project_referential_integrity' AS check_name, count(*) AS violations FROM bad_fact f
WHERE NOT EXISTS (SELECT 1 FROM bad_projects p WHERE p.project_key = f.project_key)"""
_DATE_RI = """SELECT 'date_referential_integrity' AS check_name, count(*) AS violations FROM bad_fact f
WHERE NOT EXISTS (SELECT 1 FROM bad_dates p WHERE p.date_key = f.date_key)"""
_RECONCILE = """SELECT 'silver_gold_reconciliation' AS check_name,
  abs((SELECT count(*) FROM silver) - (SELECT count(*) FROM bad_fact)) AS violations"""


@R.query("check_unique_project_keys", on_broken(_UNIQUE))
def _(spark, d):
    return checks.check_unique_project_keys(_broken_star(spark, d)[2])


@R.query("check_project_ri", on_broken(_PROJECT_RI))
def _(spark, d):
    _, more, some, _ = _broken_star(spark, d)
    return checks.check_project_ri(more, some)


@R.query("check_date_ri", on_broken(_DATE_RI))
def _(spark, d):
    _, more, _, days = _broken_star(spark, d)
    return checks.check_date_ri(more, days)


@R.query("check_silver_gold", on_broken(_RECONCILE))
def _(spark, d):
    clean, more, _, _ = _broken_star(spark, d)
    return checks.check_silver_gold(clean, more)


@R.query("gold_checks", on_broken(" UNION ALL ".join([_UNIQUE, _PROJECT_RI, _DATE_RI, _RECONCILE])))
def _(spark, d):
    clean, more, some, days = _broken_star(spark, d)
    return checks.gold_checks(clean, more, some, days)


@R.query(
    "gold_not_empty",
    on_star("SELECT 'gold_not_empty' AS check_name, CAST(count(*) = 0 AS BIGINT) AS violations FROM fact"),
)
def _(spark, d):
    return checks.gold_not_empty(fact(spark, d))


@R.query(
    "reference_checks",
    on_broken(
        """SELECT (SELECT count(*) FROM ref) AS source_projects,
  (SELECT count(*) FROM bad_projects WHERE wiki_code <> 'unknown') AS published_projects,
  (SELECT count(DISTINCT project_key) FROM bad_projects) AS unique_keys,
  (SELECT count(*) FROM bad_projects WHERE wiki_code = 'unknown') AS fallback_projects,
  (SELECT count(*) FROM ref r WHERE NOT EXISTS (
    SELECT 1 FROM bad_projects p WHERE p.project_key = md5(r.wiki_code))) AS missing_projects,
  false AS passed"""
    ),
)
def _(spark, d):
    return checks.reference_checks(reference(spark, d), _broken_star(spark, d)[2])


@R.query(
    "coverage_check",
    on_events(
        """SELECT 'clean_keys_missing' AS check_name, count(*) AS violations FROM silver WHERE event_id % 30 = 4
UNION ALL SELECT 'silver_keys_repeated', count(*) FROM silver WHERE event_id % 30 <> 4 AND event_id % 45 = 2
UNION ALL SELECT 'rejected_payloads_missing', count(*) FROM flagged WHERE NOT passed AND event_id % 7 = 0"""
    ),
)
def _(spark, d):
    # As the job does it: the inbox is parsed once, and the check reads files.
    rows = stored(flagged(spark, d), "flagged-events")
    clean = clean_events(rows).filter("event_id % 30 <> 4")
    clean = stored(clean.unionByName(clean.filter("event_id % 45 = 2")), "clean-events")
    kept = quarantined_events(rows).filter("coalesce(event_id % 7 <> 0, true)")
    return checks.coverage_check(rows, clean, kept, KEY)


_ALERT_NOW = "TIMESTAMP '2024-01-20 00:00:00'"


@R.query(
    "alert_quarantine",
    on_events(
        """SELECT 'quarantine_records' AS alert, count(*) AS value FROM delivered
WHERE NOT passed AND secs >= epoch_us(TIMESTAMP '2024-01-20 00:00:00') // 1000000 - 3600 AND event_timestamp_unix IS NOT NULL"""
    ),
)
def _(spark, d):
    rejected = quarantined_events(flagged(spark, d))
    return alerts.alert_quarantine(rejected, F.expr(_ALERT_NOW), time="event_time")


def _short_history(spark: SparkSession, d: str) -> DataFrame:
    rows = reference(spark, d)
    closed = F.when(F.col("n_nationkey") % 4 == 1, fixed_now())
    return rows.filter("n_nationkey % 9 <> 2").withColumn("__END_AT", closed)


_MISSING = "SELECT count(*) FROM ref WHERE n_nationkey % 9 = 2 OR n_nationkey % 4 = 1"


@R.query(
    "alert_reconciliation",
    on_reference(f"SELECT 'missing_reference_records' AS alert, ({_MISSING}) AS value"),
)
def _(spark, d):
    return alerts.alert_reconciliation(reference(spark, d), _short_history(spark, d))


def _aged_projects(spark: SparkSession, d: str) -> DataFrame:
    """Projects dated by the latest event on them."""
    seen = silver(spark, d).groupBy(F.col("wiki").alias("wiki_code")).agg(
        F.max("event_time").alias("gold_updated_at")
    )
    return projects(spark, d).drop("gold_updated_at").join(seen, "wiki_code", "left")


_STALE = """SELECT CAST(coalesce(max(secs) < epoch_us(TIMESTAMP '2024-02-01 00:00:00') // 1000000 - 48 * 3600, true) AS BIGINT)
FROM silver WHERE n < 25"""


@R.query("alert_freshness", on_events(f"SELECT 'stale_reference' AS alert, ({_STALE}) AS value"))
def _(spark, d):
    return alerts.alert_freshness(_aged_projects(spark, d), fixed_now())


@R.query(
    "alert_eval",
    on_star(
        f"""SELECT * FROM (
  SELECT 'missing_reference_records' AS alert, ({_MISSING}) AS value, 'GREATER_THAN' AS operator, 0.0::DOUBLE AS threshold
  UNION ALL SELECT 'stale_reference', ({_STALE}), 'NOT_EQUAL', 0.0::DOUBLE) WHERE value > threshold OR (operator = 'NOT_EQUAL' AND value <> threshold)"""
    ),
)
def _(spark, d):
    values = alerts.alert_reconciliation(reference(spark, d), _short_history(spark, d)).unionByName(
        alerts.alert_freshness(_aged_projects(spark, d), fixed_now())
    )
    rules = spark.createDataFrame(
        [("missing_reference_records", "GREATER_THAN", 0.0), ("stale_reference", "NOT_EQUAL", 0.0),
         ("quarantine_records", "GREATER_THAN", 0.0)],
        "alert STRING, operator STRING, threshold DOUBLE",
    )
    return alerts.alert_eval(values, rules)


# --- policies ------------------------------------------------------------------------------


@R.query(
    "mask_user",
    on_star("""SELECT event_id, concat(substr("user", 1, 2), '***') AS "user" FROM fact"""),
)
def _(spark, d):
    return fact(spark, d).select("event_id", mask_user(F.col("user")).alias("user"))


@R.query(
    "mask_ip",
    on_star(
        r"""SELECT event_id, CASE WHEN regexp_full_match("user", '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}')
  THEN regexp_replace("user", '^([0-9]{1,3}\.[0-9]{1,3})\..*$', '\1.xxx.xxx')
  WHEN "user" LIKE '%:%' THEN concat(substr("user", 1, 9), '::xxxx') ELSE "user" END AS "user" FROM fact"""
    ),
)
def _(spark, d):
    return fact(spark, d).select("event_id", mask_ip(F.col("user")).alias("user"))


@R.query(
    "sql_policies",
    on_star(
        """SELECT * FROM (SELECT 'reader' AS seen_by, concat(substr("user", 1, 2), '***') AS "user", editor_type_key, count(*) AS edits
  FROM fact WHERE editor_type_key IN (1, 2) GROUP BY ALL
UNION ALL SELECT 'auditor', "user", editor_type_key, count(*) FROM fact GROUP BY ALL)"""
    ),
)
def _(spark, d):
    """The SQL functions as mask and row filter of a view, as a SQL user would put them there."""
    register_masks(spark)
    fact(spark, d).createOrReplaceTempView("policy_facts")
    views = {"reader": "false", "auditor": "true"}
    seen = []
    for role, privileged in views.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW facts_for_{role} AS SELECT * EXCEPT (user), mask_user(user, {privileged}) AS user "
            f"FROM policy_facts WHERE edit_visible(editor_type_key, {privileged})"
        )
        seen.append(spark.sql(
            f"SELECT '{role}' AS seen_by, user, editor_type_key, count(*) AS edits FROM facts_for_{role} GROUP BY ALL"
        ))
    return checks.all_checks(seen)


@R.query(
    "row_policy",
    on_star(
        """SELECT policy, count(*) AS visible, CAST(sum(abs_byte_change) AS BIGINT) AS bytes FROM (
  SELECT 'current' AS policy, * FROM fact WHERE editor_type_key IN (1, 2)
  UNION ALL SELECT 'humans_only', * FROM fact WHERE editor_type_key = 2
  UNION ALL SELECT 'privileged', * FROM fact) GROUP BY 1"""
    ),
)
def _(spark, d):
    rows = fact(spark, d)
    seen = [
        policies.row_policy(rows, False, "current").withColumn("policy", F.lit("current")),
        policies.row_policy(rows, False, "humans_only").withColumn("policy", F.lit("humans_only")),
        policies.row_policy(rows, True).withColumn("policy", F.lit("privileged")),
    ]
    return checks.all_checks(seen).groupBy("policy").agg(
        F.count("*").alias("visible"), F.sum("abs_byte_change").alias("bytes")
    )


@R.query(
    "secured_view",
    on_star(
        """SELECT concat(substr("user", 1, 2), '***') AS "user", count(*) AS edits FROM fact
WHERE editor_type_key = 2 GROUP BY 1"""
    ),
)
def _(spark, d):
    policies.secured_view(fact(spark, d), "secured_facts", policy="humans_only")
    return spark.table("secured_facts").groupBy("user").agg(F.count("*").alias("edits"))
