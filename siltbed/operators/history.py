"""Type-2 history from snapshots of a keyed list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.joins import null_safe_equal

START, END = "__START_AT", "__END_AT"
# Key and tracked columns of the project list.
PROJECT_KEYS = ("wiki_code",)
PROJECT_TRACKED = ("project_name", "language_code", "site_url")


def duplicate_snapshot_keys(
    snapshots: DataFrame, keys: Sequence[str] = PROJECT_KEYS, version: str | None = None
) -> DataFrame:
    """Keys that a snapshot holds more than once; such a snapshot must be refused."""
    groups = [*keys, version] if version else list(keys)
    return snapshots.groupBy(*groups).agg(F.count("*").alias("copies")).filter("copies > 1")


def snapshot_order_guard(history: DataFrame, at: Column) -> DataFrame:
    """One row: ``accepted`` unless the history already holds something newer than ``at``."""
    newest = history.agg(F.greatest(F.max(START), F.max(END)).alias("newest"))
    return newest.select("newest", F.coalesce(F.col("newest") <= at, F.lit(True)).alias("accepted"))


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    at: Column,
    keys: Sequence[str] = PROJECT_KEYS,
    tracked: Sequence[str] = PROJECT_TRACKED,
) -> DataFrame:
    """History after one snapshot.

    New key: open row. Tracked change: close the open row and open another. Absent key: close.
    Untracked change: update the open row. One full outer join on the key, whose values are
    unique on both sides; closed rows pass by without a shuffle.
    """
    columns = [c for c in history.columns if c not in (START, END)]
    closed = history.filter(F.col(END).isNotNull())
    old = history.filter(F.col(END).isNull()).withColumn("_here", F.lit(True)).alias("o")
    new = snapshot.select(columns).withColumn("_here", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    paired = old.join(new, on, "full")
    had, has = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    same = had & has & null_safe_equal("o", "n", tracked)

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns], start.alias(START), end.alias(END)
        )

    open_end = F.lit(None).cast(history.schema[END].dataType)
    start = F.col(f"o.{START}")
    rows = F.array_compact(
        F.array(
            F.when(had & ~same, row("o", start, at)),
            F.when(has & ~same, row("n", at, open_end)),
            F.when(same, row("n", start, open_end)),
        )
    )
    return closed.unionByName(paired.select(F.inline(rows)))


def scd2_from_snapshots(
    snapshots: DataFrame,
    version: str,
    keys: Sequence[str] = PROJECT_KEYS,
    tracked: Sequence[str] = PROJECT_TRACKED,
) -> DataFrame:
    """The same history from stacked snapshots in one job.

    A row starts a new version when the key was absent from the snapshot before, or a tracked
    value changed. Windows are per key: a key has at most one row per snapshot.
    """
    carried = [c for c in snapshots.columns if c not in (*keys, *tracked, version)]
    # The distinct version numbers are few (one per snapshot), whatever the size of a snapshot.
    order = Window.orderBy(version)
    calendar = snapshots.select(version).distinct().withColumn("_next", F.lead(version).over(order))
    dated = snapshots.join(calendar, [version], "inner")
    per_key = Window.partitionBy(*keys).orderBy(version)
    before = {c: F.lag(c).over(per_key) for c in tracked}
    unchanged = F.lag("_next").over(per_key).eqNullSafe(F.col(version))
    for name in tracked:
        unchanged = unchanged & F.col(name).eqNullSafe(before[name])
    runs = dated.withColumn("_starts", F.when(unchanged, 0).otherwise(1)).withColumn(
        "_run", F.sum("_starts").over(per_key)
    )
    newest = F.max_by(F.struct(*[F.col(c) for c in (*tracked, *carried, "_next")]), F.col(version))
    grouped = runs.groupBy(*keys, "_run").agg(F.min(version).alias(START), newest.alias("_row"))
    return grouped.select(
        *keys,
        *[F.col(f"_row.{c}").alias(c) for c in (*tracked, *carried)],
        START,
        F.col("_row._next").alias(END),
    )


def scd2_active(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def scd2_as_of(history: DataFrame, at: Column) -> DataFrame:
    """Rows valid at a point in time."""
    return history.filter((F.col(START) <= at) & (F.col(END).isNull() | (F.col(END) > at)))
