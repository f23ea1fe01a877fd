"""Dimension tables of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.languages import language_name

UNKNOWN = "unknown"
DEFAULT_PROJECT = "Wikipedia"
FALLBACK_LANGUAGE = "Other / Technical"


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar with one row per day between ``first_day`` and ``last_day`` of a one-row frame."""
    day = F.col("calendar_date")
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias(
            "calendar_date"
        )
    )
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def calendar_between(spark: SparkSession, first: str = "2025-01-01", last: str = "2027-12-31") -> DataFrame:
    """Fixed bounds for ``dim_date``."""
    return spark.range(1).select(
        F.to_date(F.lit(first)).alias("first_day"), F.to_date(F.lit(last)).alias("last_day")
    )


def calendar_bounds(rows: DataFrame, *times: str) -> DataFrame:
    """Whole calendar years that cover every given time column of the rows.

    Give the ingest time too where rows without an event time are dated by it.
    """
    lows = [F.min(c) for c in times]
    highs = [F.max(c) for c in times]
    low = lows[0] if len(lows) == 1 else F.least(*lows)
    high = highs[0] if len(highs) == 1 else F.greatest(*highs)
    return rows.agg(low.alias("lo"), high.alias("hi")).select(
        F.to_date(F.date_trunc("year", "lo")).alias("first_day"),
        F.last_day(F.add_months(F.date_trunc("year", "hi"), 11)).alias("last_day"),
    )


def date_key(value: Column) -> Column:
    """``yyyyMMdd`` as INT, by integer arithmetic instead of text formatting."""
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def project_key(wiki_code: Column) -> Column:
    return F.md5(F.coalesce(wiki_code, F.lit(UNKNOWN)))


def dim_project(
    active: DataFrame,
    now: Column | None = None,
    names: DataFrame | None = None,
    fallback_name: str = "Other project",
    fallback_url: str | None = None,
) -> DataFrame:
    """Active reference rows plus the fallback row that unmapped events use, in one frame.

    ``names`` (``language_code``, ``language_name``) is a published list that replaces the built-in naming
    rule: codes that it lacks become ``ISO: <CODE>``. Codes are compared without regard to case.
    """
    now = F.current_timestamp() if now is None else now
    code = F.coalesce(F.col("language_code"), F.lit(UNKNOWN))
    projects = active.select(
        project_key(F.col("wiki_code")).alias("project_key"),
        "wiki_code",
        code.alias("language_code"),
        F.coalesce("project_name", F.lit(DEFAULT_PROJECT)).alias("project_name"),
        "site_url",
    )
    if names is None:
        named = projects.withColumn("language_name", language_name(F.col("language_code")))
    else:
        listed = names.select(
            F.lower("language_code").alias("_code"), F.col("language_name").alias("_name")
        ).dropDuplicates(["_code"])
        unlisted = F.when(F.col("_code") == UNKNOWN, FALLBACK_LANGUAGE).otherwise(
            F.concat(F.lit("ISO: "), F.upper("language_code"))
        )
        named = (
            projects.withColumn("_code", F.lower("language_code")).join(listed, ["_code"], "left")
            .withColumn("language_name", F.coalesce("_name", unlisted))
            .drop("_code", "_name")
        )
    columns = [
        "project_key", "wiki_code", "language_code", "language_name", "project_name", "site_url",
    ]
    fallback = active.sparkSession.range(1).select(
        F.md5(F.lit(UNKNOWN)).alias("project_key"),
        F.lit(UNKNOWN).alias("wiki_code"),
        F.lit(UNKNOWN).alias("language_code"),
        F.lit(FALLBACK_LANGUAGE).alias("language_name"),
        F.lit(fallback_name).alias("project_name"),
        F.lit(fallback_url).cast("string").alias("site_url"),
    )
    return (
        named.select(columns).unionByName(fallback).withColumn("gold_updated_at", now)
    )


def language_code_census(reference: DataFrame) -> DataFrame:
    """Projects per language code."""
    return (
        reference.groupBy("language_code")
        .agg(F.count("*").alias("projects"))
        .orderBy(F.desc("projects"), F.asc_nulls_first("language_code"))
    )


def dim_editor_type(spark: SparkSession) -> DataFrame:
    """The two kinds of editor, as an inline table whose size the planner knows."""
    return spark.sql(
        "SELECT * FROM VALUES (1, true, 'Bot'), (2, false, 'Human') "
        "AS t(editor_type_key, is_bot, editor_type_desc)"
    )
