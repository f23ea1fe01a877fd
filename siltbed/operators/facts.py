"""The edit fact table and the conditions for building it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.dimensions import UNKNOWN, date_key
from siltbed.operators.parse import absolute, byte_delta

BOT_KEY, HUMAN_KEY = 1, 2


def fact_edits(clean: DataFrame, projects: DataFrame, now: Column | None = None) -> DataFrame:
    """One fact row per clean event.

    The join uses the code itself, not a hash of it: the dimension carries the hash, so no MD5
    is computed per event. An event without a code meets the fallback row, one with an unmapped
    code keeps no match and gets the fallback key.
    """
    now = F.current_timestamp() if now is None else now
    events = clean.withColumn("_code", F.coalesce("wiki", F.lit(UNKNOWN)))
    # A reference row without a code has the same key as the fallback row: one of them is enough.
    codes = projects.select(
        F.coalesce("wiki_code", F.lit(UNKNOWN)).alias("_code"), "project_key"
    ).dropDuplicates(["_code"])
    joined = events.join(codes, ["_code"], "left")
    change = byte_delta(F.col("length_old"), F.col("length_new"))
    return joined.select(
        "event_id",
        date_key(F.coalesce("event_time", "silver_ingested_at")).alias("date_key"),
        F.coalesce("project_key", F.md5(F.lit(UNKNOWN))).alias("project_key"),
        F.when(F.col("bot"), BOT_KEY).otherwise(HUMAN_KEY).alias("editor_type_key"),
        "user",
        "title",
        "event_time",
        "length_old",
        "length_new",
        change.alias("byte_change"),
        absolute(change).alias("abs_byte_change"),
        F.coalesce("minor", F.lit(False)).alias("is_minor_edit"),
        now.alias("gold_ingested_at"),
    )


def fact_preflight(dates: DataFrame, editor_types: DataFrame, projects: DataFrame) -> DataFrame:
    """One row of dimension sizes; ``ready`` says whether the fact may be built."""
    parts = [
        dates.select(F.lit("dates").alias("part")),
        editor_types.select(F.lit("editor_types").alias("part")),
        projects.select(
            F.when(F.col("wiki_code") == UNKNOWN, "fallback_projects")
            .when(F.col("wiki_code").isNotNull(), "projects")
            .alias("part")
        ),
    ]
    names = ("dates", "editor_types", "projects", "fallback_projects")
    sizes = reduce(DataFrame.unionByName, parts).agg(
        *[F.count_if(F.col("part") == name).alias(name) for name in names]
    )
    return sizes.withColumn(
        "ready",
        (F.least("dates", "editor_types", "projects") > 0) & (F.col("fallback_projects") == 1),
    )


def reference_gate(active: DataFrame) -> DataFrame:
    """One row; ``publishable`` only for a non-empty list with unique, present codes."""
    return active.agg(
        F.count("*").alias("projects"), F.countDistinct("wiki_code").alias("unique_projects")
    ).withColumn(
        "publishable",
        (F.col("projects") > 0) & (F.col("projects") == F.col("unique_projects")),
    )
