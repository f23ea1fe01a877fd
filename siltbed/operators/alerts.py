"""Monitoring values and their thresholds. ``now`` is an argument, so results can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.dimensions import UNKNOWN


def _value(rows: DataFrame, name: str, value: Column) -> DataFrame:
    return rows.agg(value.cast("long").alias("value")).select(F.lit(name).alias("alert"), "value")


def alert_quarantine(
    rejected: DataFrame, now: Column | None = None, time: str = "silver_ingested_at", hours: int = 1
) -> DataFrame:
    """Rows rejected during the last hours."""
    now = F.current_timestamp() if now is None else now
    recent = rejected.filter(F.col(time) >= now - F.expr(f"INTERVAL {hours} HOURS"))
    return _value(recent, "quarantine_records", F.count("*"))


def alert_reconciliation(snapshot: DataFrame, history: DataFrame) -> DataFrame:
    """Snapshot rows without an active history row; a row without a code always counts."""
    active = history.filter("__END_AT IS NULL").select("wiki_code").distinct()
    missing = snapshot.join(active, "wiki_code", "left_anti")
    return _value(missing, "missing_reference_records", F.count("*"))


def alert_freshness(
    projects: DataFrame, now: Column | None = None, hours: int = 48
) -> DataFrame:
    """1 if the newest real project row is absent or too old."""
    now = F.current_timestamp() if now is None else now
    newest = F.max("gold_updated_at")
    stale = F.coalesce(newest < now - F.expr(f"INTERVAL {hours} HOURS"), F.lit(True))
    return _value(
        projects.filter(F.col("wiki_code") != UNKNOWN), "stale_reference", stale.cast("int")
    )


def alert_eval(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Values against rules (``alert``, ``operator``, ``threshold``); returns the firing rows."""
    fires = (
        F.when(F.col("operator") == "GREATER_THAN", F.col("value") > F.col("threshold"))
        .when(F.col("operator") == "NOT_EQUAL", F.col("value") != F.col("threshold"))
        .otherwise(F.raise_error(F.concat(F.lit("Unknown operator "), F.col("operator"))))
    )
    return values.join(rules, "alert").filter(fires).select("alert", "value", "operator", "threshold")
