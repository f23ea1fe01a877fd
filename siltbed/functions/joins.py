"""Joins and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group.

    The filter directly above ``row_number`` lets Spark cut each group to ``k`` rows inside
    every map task (WindowGroupLimit), so a hot group never reaches a single task whole. It does
    so for ``k`` below ``spark.sql.optimizer.windowGroupLimitThreshold``; raise that for more.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def null_safe_equal(left: str, right: str, columns: Sequence[str]) -> Column:
    """``left.c <=> right.c`` for every column, folded with AND."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition
