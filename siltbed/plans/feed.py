"""Change feeds of published tables, and readers that follow them.

Each commit of a keyed table can carry what changed: ``insert`` and ``delete`` rows, and for an update the
row ``before`` and the row after it (``update``). A reader keeps the number of the last commit it has
applied together with its own table, in one commit, so a repeated delivery changes nothing and a
failed run is repeated from where the table stands.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.joins import null_safe_equal
from siltbed.operators.merge import ACTION, DELETE, INSERT, UPDATE
from siltbed.plans import store

BEFORE, COMMIT = "before", "_commit"


def sign() -> Column:
    """1 for a feed row that is there after its commit, -1 for one that no longer is."""
    return F.when(F.col(ACTION).isin(INSERT, UPDATE), 1).otherwise(-1)


def changes_between(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All that turns one state into another; keys are unique in each. Unchanged rows do not appear.

    A row with a NULL in its key is matched with the row of the same key.
    """
    columns = after.columns
    values = [c for c in columns if c not in keys]
    old = before.select(columns).withColumn("_here", F.lit(True)).alias("t")
    new = after.withColumn("_here", F.lit(True)).alias("s")
    paired = old.join(new, null_safe_equal("t", "s", keys), "full")
    was, now = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    same = was & now & null_safe_equal("t", "s", values)
    sides = {side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns]) for side in ("t", "s")}
    entry = lambda action, side: F.struct(F.lit(action).alias(ACTION), sides[side].alias("row"))
    entries = (
        F.when(~was, F.array(entry(INSERT, "s")))
        .when(~now, F.array(entry(DELETE, "t")))
        .otherwise(F.array(entry(BEFORE, "t"), entry(UPDATE, "s")))
    )
    return paired.filter(~same).select(F.explode(entries).alias("e")).select("e.row.*", f"e.{ACTION}")


def publish_changes(
    after: DataFrame, name: str, root: str, keys: Sequence[str], gate: Callable[[DataFrame], None] | None = None
) -> store.Snapshot:
    """Publish a new state together with its change feed; refused if the table moved meanwhile."""
    spark = after.sparkSession
    now = store.snapshot(spark, root)
    version = _with_feed(spark, root, name, after, keys, now, gate)
    return store.commit(spark, root, {name: version}, now.number)


def _with_feed(spark, root, name, after, keys, now, gate=None) -> store.Version:
    version = store.write_version(after, root, name)
    written = store.open_files(spark, version.path, version.schema)
    if gate is not None:
        gate(written)
    old = now.tables.get(name)
    before = written.filter("false") if old is None else store.open_files(spark, old.path, old.schema)
    feed = store.write_version(changes_between(before, written, keys), root, f"{name}_changes")
    return replace(version, changes=feed.path, changes_schema=feed.schema)


def changes_since(spark: SparkSession, root: str, name: str, position: int) -> tuple[DataFrame | None, int]:
    """Feed rows of the commits after ``position``, with ``_commit``, and the new position (None: nothing new)."""
    found = store.commits_since(spark, root, name, position)
    parts = [
        store.open_files(spark, v.changes, v.changes_schema).withColumn(COMMIT, F.lit(number).cast("long"))
        for number, v in found if v.changes
    ]
    if len(parts) < len(found):
        raise ValueError(f"{name} was published without a change feed since commit {position}")
    return (reduce(DataFrame.unionByName, parts), found[-1][0]) if parts else (None, position)


def net_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of several commits only the last change of every key; what the key was before is left out."""
    values = [c for c in changes.columns if c not in (COMMIT, ACTION)]
    last = changes.filter(F.col(ACTION) != BEFORE).groupBy(*keys).agg(
        F.max_by(F.struct(*values, ACTION), F.col(COMMIT)).alias("_last")
    )
    return last.select("_last.*")


def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the changes. Applying the same changes again gives the same state."""
    last = net_changes(changes, keys)
    on = null_safe_equal("t", "c", keys)
    kept = state.alias("t").join(last.select(*keys).alias("c"), on, "left_anti")
    return kept.unionByName(last.filter(F.col(ACTION) != DELETE).drop(ACTION).select(state.columns))


def follow(
    spark: SparkSession, source: tuple[str, str], root: str, name: str, keys: Sequence[str],
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Bring a table up to date with the feed of another; returns the number of commits applied.

    ``derive`` maps feed rows to rows of the table, row by row (it keeps the key and ``_action``).
    Position and rows are committed together, against the snapshot they were read from.
    """
    from_root, from_name = source
    label = f"{from_root.rstrip('/')}/{from_name}"
    now = store.snapshot(spark, root)
    mine = now.tables.get(name)
    position = mine.positions.get(label, 0) if mine else 0
    changes, upto = changes_since(spark, from_root, from_name, position)
    if changes is None:
        return 0
    if derive is not None:
        changes = derive(changes)
    empty = changes.filter("false").drop(ACTION, COMMIT)
    state = store.open_files(spark, mine.path, mine.schema) if mine else empty
    version = _with_feed(spark, root, name, apply_changes(state, changes, keys), keys, now)
    positions = {**(mine.positions if mine else {}), label: upto}
    store.commit(spark, root, {name: replace(version, positions=positions)}, now.number)
    return len(store.commits_since(spark, from_root, from_name, position))
