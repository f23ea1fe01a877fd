"""Upserts on plain Parquet: compute a plan, then the new state or the change feed from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.joins import null_safe_equal

ACTION = "_action"
INSERT, UPDATE, UNCHANGED, KEEP, DELETE = "insert", "update", "unchanged", "keep", "delete"


def merge_plan(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of the new state with what happens to it.

    ``insert``: only in the source. ``update``: some non-key value differs (NULL equals NULL).
    ``unchanged``: identical in both. ``keep``: only in the target. Keys are unique on each side.
    """
    columns = target.columns
    values = [c for c in columns if c not in keys]
    t = target.withColumn("_here", F.lit(True)).alias("t")
    s = source.select(columns).withColumn("_here", F.lit(True)).alias("s")
    paired = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")
    old, new = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    action = (
        F.when(~new, KEEP)
        .when(~old, INSERT)
        .when(null_safe_equal("t", "s", values), UNCHANGED)
        .otherwise(UPDATE)
    )
    return paired.select(
        *[F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns],
        action.alias(ACTION),
    )


def merge_apply(plan: DataFrame) -> DataFrame:
    """The table after the merge."""
    return plan.filter(F.col(ACTION) != DELETE).drop(ACTION)


def merge_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy(F.col(ACTION).alias("action")).agg(F.count("*").alias("rows"))


def change_feed(plan: DataFrame) -> DataFrame:
    """Only the rows that a downstream reader has to act on."""
    return plan.filter(F.col(ACTION).isin(INSERT, UPDATE, DELETE))


def chunk_diff(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("chunk_id",)) -> DataFrame:
    """Changed or new rows, and removed keys, between two complete states."""
    plan = merge_plan(before, after, keys)
    removed = F.when(F.col(ACTION) == KEEP, DELETE).otherwise(F.col(ACTION))
    return change_feed(plan.withColumn(ACTION, removed))


def replace_within(
    target: DataFrame, source: DataFrame, keys: Sequence[str], scope: str
) -> DataFrame:
    """Merge plan in which the source replaces everything in the scopes it mentions.

    Target rows of those scopes that the source no longer has are deleted; rows of other scopes
    stay. The scopes are few, so they are looked up with a salt against scopes of any size.
    """
    scopes = source.select(scope).distinct().withColumn("_replaced", F.lit(True))
    plan = merge_plan(target, source, keys)
    marked = plan.join(scopes, [scope], "left")
    gone = (F.col(ACTION) == KEEP) & F.col("_replaced").isNotNull()
    return marked.withColumn(ACTION, F.when(gone, DELETE).otherwise(F.col(ACTION))).drop("_replaced")


def unchanged_rerun(plan: DataFrame) -> DataFrame:
    """One row: a rerun is idle if nothing is inserted, updated or deleted."""
    busy = F.count_if(F.col(ACTION).isin(INSERT, UPDATE, DELETE))
    return plan.agg(
        F.count_if(F.col(ACTION) == UNCHANGED).alias("unchanged_rows"), busy.alias("changes")
    ).withColumn("idle", F.col("changes") == 0)
