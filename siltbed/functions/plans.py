"""Control over how often a plan or an expression is evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.session import work_dir


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression runs exactly once per row.

    Catalyst may copy an expression into every later filter and field access. A one-element
    explode keeps it where it is: nothing is pushed below or merged into a generator.
    """
    return rows.withColumn(name, F.explode(F.array(value)))


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows from a table of their own below the shared work folder.

    What several plans read is computed once, a lost executor repeats nothing above the table, and
    Catalyst sees its true size, so it is broadcast in a join only below the session's threshold.
    """
    path = work_dir(rows.sparkSession, purpose)
    rows.write.mode("errorifexists").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
