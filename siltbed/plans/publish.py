"""Publication on Parquet: write a new version, check it, then move the readers over.

A version is a folder of its own, and a commit file next to the data says which version is current
(``store``), so every session finds it. A check that fails leaves the commit where it was. Sessions that
work in SQL can put a view over the current version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from siltbed.plans import store

Gate = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Publication:
    """Rows to publish, a gate that raises if the written rows are not fit, and the partition columns."""

    rows: DataFrame
    gate: Gate | None = None
    partition_by: Sequence[str] | None = None


def exists(spark: SparkSession, root: str, name: str) -> bool:
    return store.check_name(name) in store.snapshot(spark, root).tables


def publish_all(
    spark: SparkSession, root: str, tables: dict[str, Publication], expected: int | None = None
) -> dict[str, DataFrame]:
    """Publish several tables as one: all files are written and gated before any becomes visible."""
    versions = {}
    for name, table in tables.items():
        version = store.write_version(table.rows, root, name, table.partition_by)
        if table.gate is not None:
            table.gate(store.open_files(spark, version.path, version.schema))
        versions[name] = version
    store.commit(spark, root, versions, expected)
    return {name: store.open_files(spark, v.path, v.schema) for name, v in versions.items()}


def publish_table(
    rows: DataFrame, name: str, root: str, gate: Gate | None = None, partition_by: Sequence[str] | None = None,
    expected: int | None = None,
) -> DataFrame:
    """Write ``rows`` as a new version of ``name``, gate it, and point readers at it.

    The gate reads the written files, not the plan, so the checked rows are the published rows.
    Earlier versions stay until an operator removes them, for readers that still hold them.
    """
    return publish_all(rows.sparkSession, root, {name: Publication(rows, gate, partition_by)}, expected)[name]


def create_if_absent(spark: SparkSession, name: str, ddl: str, root: str) -> bool:
    """Publish an empty typed table only where none exists. Returns whether it was created."""
    if exists(spark, root, name):
        return False
    publish_table(spark.createDataFrame([], ddl), name, root)
    return True


def snapshot_backup(rows: DataFrame, path: str) -> None:
    """Copy a table once; a second run leaves the first copy alone."""
    rows.write.mode("ignore").parquet(path)


def published_or_none(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The published table, or None before its first publication."""
    return store.read_table(spark, root, name) if exists(spark, root, name) else None


def view_of(spark: SparkSession, root: str, name: str, view: str | None = None) -> DataFrame:
    """A temporary view over the current version, for SQL in this session."""
    rows = store.read_table(spark, root, name)
    rows.createOrReplaceTempView(store.check_name(view or name))
    return rows
