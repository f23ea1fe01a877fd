"""Activity analytics over the star schema and over clean events.

Facts are aggregated to their keys before any dimension is joined: the joins then see a few rows
per key, so neither their cost nor their balance depends on how many events one project has.
Every top-k has a total order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.dimensions import UNKNOWN
from siltbed.operators.facts import BOT_KEY

# Project codes that are not languages.
NOT_LANGUAGES = ("commons", "wikidata")


def count_where(condition: Column) -> Column:
    """Conditional count; unlike ``count_if`` it is a sum of 0/1, NULL counts as 0."""
    return F.sum(F.when(condition, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    return F.round(part * 100.0 / whole, 1)


def top_languages(
    facts: DataFrame, projects: DataFrame, editors: DataFrame, dates: DataFrame, k: int | None = 40
) -> DataFrame:
    """Bot, human and total edits and bytes per language and project."""
    keyed = facts.groupBy("project_key", "editor_type_key", "date_key").agg(
        F.count("event_id").alias("n"), F.count("*").alias("n_rows"),
        F.sum("abs_byte_change").alias("bytes"),
    )
    named = (
        keyed.join(dates.select("date_key"), "date_key", "left_semi")
        .join(editors.select("editor_type_key", "editor_type_desc"), "editor_type_key")
        .join(projects.select("project_key", "language_name", "project_name"), "project_key")
    )
    rows_of = lambda kind: F.sum(
        F.when(F.col("editor_type_desc") == kind, F.col("n_rows")).otherwise(0)
    )
    ranked = (
        named.groupBy("language_name", "project_name")
        .agg(
            rows_of("Bot").alias("bot_edits"),
            rows_of("Human").alias("human_edits"),
            F.sum("n").alias("total_edits"),
            F.sum("bytes").alias("total_bytes_altered"),
        )
        .orderBy(F.desc("total_edits"), "language_name", "project_name")
    )
    return ranked if k is None else ranked.limit(k)


def bot_vs_human(facts: DataFrame, editors: DataFrame) -> DataFrame:
    keyed = facts.groupBy("editor_type_key").agg(
        F.count("event_id").alias("n"),
        F.count("*").alias("n_rows"),
        F.sum("abs_byte_change").alias("bytes"),
        F.count("abs_byte_change").alias("sized"),
        count_where(F.col("is_minor_edit")).alias("minor"),
    )
    return (
        keyed.join(editors, "editor_type_key")
        .groupBy("editor_type_desc")
        .agg(
            F.sum("n").alias("total_edits"),
            F.round(F.sum("bytes") / F.sum("sized"), 1).alias("avg_byte_change"),
            percent(F.sum("minor"), F.sum("n_rows")).cast("double").alias("minor_edit_pct"),
        )
    )


def edits_timeline(facts: DataFrame, editors: DataFrame, k: int | None = 60) -> DataFrame:
    """Edits per minute and editor kind, newest first."""
    keyed = facts.groupBy(
        F.date_trunc("minute", "event_time").alias("event_minute"), "editor_type_key"
    ).agg(F.count("event_id").alias("edits_count"))
    line = (
        keyed.join(editors.select("editor_type_key", "editor_type_desc"), "editor_type_key")
        .groupBy("event_minute", "editor_type_desc")
        .agg(F.sum("edits_count").alias("edits_count"))
        .orderBy(F.desc("event_minute"), "editor_type_desc")
    )
    return line if k is None else line.limit(k)


def _by_project(facts: DataFrame, *aggregates: Column) -> DataFrame:
    return facts.groupBy("project_key").agg(F.count("*").alias("edits"), *aggregates)


def bot_share_by_language(facts: DataFrame, projects: DataFrame) -> DataFrame:
    keyed = _by_project(facts, count_where(F.col("editor_type_key") == BOT_KEY).alias("bots"))
    return (
        keyed.join(projects.select("project_key", "language_name"), "project_key")
        .groupBy("language_name")
        .agg(
            F.sum("edits").alias("edits"),
            percent(F.sum("bots"), F.sum("edits")).cast("double").alias("bot_pct"),
        )
        .orderBy(F.desc("edits"), "language_name")
    )


def language_filtered(
    facts: DataFrame, projects: DataFrame, excluded: Sequence[str] = NOT_LANGUAGES
) -> DataFrame:
    """Edits per language without the codes that are not languages."""
    languages = projects.filter(~F.col("language_code").isin(*excluded)).select(
        "project_key", "language_code", "language_name"
    )
    return (
        _by_project(facts)
        .join(languages, "project_key")
        .groupBy("language_code", "language_name")
        .agg(F.sum("edits").alias("edits"))
        .orderBy(F.desc("edits"), "language_code")
    )


def most_edited_pages(facts: DataFrame, projects: DataFrame, k: int = 20) -> DataFrame:
    pages = facts.groupBy("project_key", "title").agg(
        F.count("*").alias("edits"), F.sum("byte_change").alias("net_bytes")
    )
    codes = projects.select("project_key", "wiki_code")
    return (
        pages.join(codes, ["project_key"], "inner")
        .select("wiki_code", "title", "edits", "net_bytes")
        .orderBy(F.desc("edits"), F.asc_nulls_first("wiki_code"), F.asc_nulls_first("title"))
        .limit(k)
    )


def largest_edits(facts: DataFrame, k: int = 20) -> DataFrame:
    return (
        facts.select("event_id", "event_time", "title", "byte_change", "abs_byte_change")
        .orderBy(F.desc_nulls_last("abs_byte_change"), "event_id")
        .limit(k)
        .select("event_time", "title", "byte_change")
    )


def hour_of_day(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(F.hour("event_time").alias("hour_of_day"))
        .agg(F.count("*").alias("edits"))
        .orderBy("hour_of_day")
    )


def weekend_split(facts: DataFrame, dates: DataFrame) -> DataFrame:
    daily = facts.groupBy("date_key").agg(F.count("*").alias("edits"))
    return (
        daily.join(dates.select("date_key", "is_weekend"), "date_key")
        .groupBy("is_weekend")
        .agg(F.sum("edits").alias("edits"))
    )


def fallback_events(facts: DataFrame, projects: DataFrame) -> DataFrame:
    """Events that no project claims."""
    unknown = projects.filter(F.col("wiki_code") == UNKNOWN).select("project_key")
    return (
        _by_project(facts)
        .join(unknown, "project_key")
        .agg(F.coalesce(F.sum("edits"), F.lit(0)).alias("fallback_events"))
    )


def kpi_summary(facts: DataFrame, approximate: bool = False) -> DataFrame:
    """The seven headline metrics in one row.

    The exact form reads the facts once and copies no row. The first aggregate has a row per title with its
    sums and the minutes in which it was edited (at most one per minute, however hot the title); the
    second a row per minute, to which each title brings its sums once. Counting the rows of both
    gives the distinct titles and minutes. ``approximate`` uses sketches instead.
    """
    minute = F.date_trunc("minute", "event_time")
    sums = {
        "edits": F.count("event_id"), "rows": F.count("*"), "bots": count_where(F.col("editor_type_key") == BOT_KEY),
        "minor": count_where(F.col("is_minor_edit")), "sizes": F.count("abs_byte_change"),
        "size": F.sum("abs_byte_change"), "net": F.sum("byte_change"),
    }
    if approximate:
        counted = facts.agg(
            *[c.alias(n) for n, c in sums.items()], F.approx_count_distinct(minute).alias("minutes"),
            F.approx_count_distinct("title").alias("titles"),
        )
    else:
        titles = facts.groupBy("title").agg(*[c.alias(n) for n, c in sums.items()], F.collect_set(minute).alias("_minutes"))
        met = titles.select("*", F.posexplode_outer("_minutes").alias("_place", "_minute"))
        once_each = F.coalesce("_place", F.lit(0)) == 0
        minutes = met.groupBy("_minute").agg(
            *[F.sum(F.when(once_each, F.col(n))).alias(n) for n in sums],
            count_where(once_each & F.col("title").isNotNull()).alias("titles"),
        )
        counted = minutes.agg(
            *[F.sum(n).alias(n) for n in (*sums, "titles")], F.count("_minute").alias("minutes")
        )
        zero = ("edits", "rows", "bots", "minor", "sizes", "titles")
        counted = counted.withColumns({n: F.coalesce(n, F.lit(0)) for n in zero})
    part = lambda x, y: F.col(x) / F.when(F.col(y) != 0, F.col(y))
    return counted.select(
        F.col("edits").alias("total_edits"),
        F.round(part("bots", "edits"), 4).alias("bot_share"),
        F.round(part("size", "sizes"), 2).alias("avg_edit_size"),
        F.col("net").alias("net_content_change"),
        F.round(part("minor", "rows"), 4).alias("minor_edit_ratio"),
        F.round(part("edits", "minutes"), 4).alias("edits_per_minute"),
        F.col("titles").alias("active_pages"),
    )


def editor_split(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("bot"), "Bot").otherwise("Human")
    return events.groupBy(kind.alias("editor_type")).agg(F.count("*").alias("total_edits"))


def top_editors(events: DataFrame, k: int = 10) -> DataFrame:
    kind = F.when(F.col("bot"), "Bot").otherwise("Human").alias("editor_type")
    return (
        events.groupBy("user", kind)
        .agg(F.count("*").alias("total_edits"))
        .orderBy(F.desc("total_edits"), F.asc_nulls_first("user"), "editor_type")
        .limit(k)
    )


def change_size_stats(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("bot"), "Bot").otherwise("Human").alias("editor_type")
    return events.groupBy(kind).agg(
        F.round(F.avg("abs_byte_change"), 1).alias("avg_changed_bytes"),
        F.max("abs_byte_change").alias("max_changed_bytes"),
    )


def edits_by_language_raw(
    events: DataFrame, reference: DataFrame, k: int | None = 20, default: str = "Other project"
) -> DataFrame:
    """Edits per language of the raw reference list; a NULL bot flag counts only in the total."""
    keyed = events.groupBy("wiki").agg(
        count_where(F.col("bot")).alias("bots"),
        count_where(~F.col("bot")).alias("humans"),
        F.count("*").alias("n"),
    )
    listed = reference.select(F.col("wiki_code").alias("wiki"), "language_code", "project_name")
    ranked = (
        keyed.join(listed, "wiki", "left")
        .groupBy(
            F.coalesce("language_code", "wiki").alias("language"),
            F.coalesce("project_name", F.lit(default)).alias("project"),
        )
        .agg(
            F.sum("bots").alias("bot_edits"),
            F.sum("humans").alias("human_edits"),
            F.sum("n").alias("total_edits"),
        )
        .orderBy(F.desc("total_edits"), "language", "project")
    )
    return ranked if k is None else ranked.limit(k)


def top_domains(events: DataFrame, k: int = 10) -> DataFrame:
    return (
        events.groupBy("domain")
        .agg(F.count("*").alias("edits"))
        .orderBy(F.desc("edits"), F.asc_nulls_first("domain"))
        .limit(k)
    )


def tumbling_counts(events: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """Events per time window; with a watermark it runs on a stream in append mode."""
    timed = events if watermark is None else events.withWatermark("event_time", watermark)
    counted = timed.groupBy(F.window("event_time", width).alias("w")).agg(
        F.count("*").alias("edits")
    )
    flat = counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "edits"
    )
    return flat if events.isStreaming else flat.orderBy("window_start")


def latest_rows(rows: DataFrame, time: str, ties: Sequence[str], k: int = 5) -> DataFrame:
    """Newest rows; only ``k`` rows per task leave the map side."""
    return rows.orderBy(F.desc(time), *ties).limit(k)
