"""Hilbert-curve sharding: order rows by several metadata columns at once and cut the curve into runs.

Each dimension is quantised at quantiles of all its values, the cell numbers become one Hilbert
index, and the rows, sorted by that index, are cut into shards whose row counts differ by one at
most. Neighbours on the curve are near in every dimension, so files written per shard have narrow
minima and maxima in all of them and a reader that filters on any dimension skips most files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import distinct_name, work_table

CURVE = "hilbert"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points, one row per point, ``bits`` bits per dimension.

    Skilling's method: the points become the transposed form of the index in place, bit by bit.
    """
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(n):
            set_ = (x[i] & step) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        flips = np.where(x[n - 1] & step, flips ^ (step - 1), flips)
        step >>= 1
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ flips) >> bit) & 1)
    return out


def string_cuts(rows: DataFrame, name: str, bits: int) -> list[str]:
    """At most ``2**bits - 1`` values that cut the rows into even runs of whole strings, in their order.

    Exact over all rows: values are counted, sorted by ranges, and a value is a cut where the running count
    passes a share of the total, as often as it passes one, so that few values still spread over all
    cells. What reaches the driver is a number per task and the cuts.
    """
    value = F.col(f"`{name}`").cast("string")
    counts = rows.groupBy(value.alias("v")).agg(F.count("*").alias("n")).filter("v IS NOT NULL")
    ranged = work_table(counts.repartitionByRange("v").withColumn("r", F.spark_partition_id()), "hilbert-values")
    sizes = sorted(tuple(r) for r in ranged.groupBy("r").agg(F.sum("n")).collect())
    total, before, starts = sum(n for _, n in sizes), 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    if not total:
        return []
    offsets = rows.sparkSession.createDataFrame(starts, "r int, _before long")
    running = F.sum("n").over(Window.partitionBy("r").orderBy("v")) + F.col("_before")
    share = lambda count: F.floor(count * 2**bits / total)
    # One row per task of the sort: a size fixed by the job, not by the data.
    placed = ranged.join(F.broadcast(offsets), "r").withColumn("_upto", running)
    times = share(F.col("_upto")) - share(F.col("_upto") - F.col("n"))
    passed = placed.withColumn("_times", times).filter((F.col("_times") > 0) & (F.col("_upto") < total))
    return sorted(v for v, times in passed.select("v", "_times").collect() for _ in range(times))


def ordinal(rows: DataFrame, name: str) -> Column:
    """A number that orders like the column, for columns that are no strings."""
    kind = rows.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _below(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut < value)).cast("double")


def cells(rows: DataFrame, dimensions: Sequence[str], bits: int) -> list[tuple[Column, list[float]]]:
    """For every dimension a number and the cut points between its cells.

    Strings are compared whole: their number is that of the cuts below them. Numbers and times are cut
    at quantiles over all rows.
    """
    strings = [d for d in dimensions if isinstance(rows.schema[d].dataType, T.StringType)]
    others = [d for d in dimensions if d not in strings]
    cuts = cell_numbers(rows, others, bits) if others else []
    found = {d: (ordinal(rows, d), c) for d, c in zip(others, cuts, strict=True)}
    for name in strings:
        values = string_cuts(rows, name, bits)
        column = F.col(f"`{name}`").cast("string")
        listed = F.array(*[F.lit(v) for v in values]).cast("array<string>")
        found[name] = (F.when(column.isNotNull(), _below(listed, column)), [float(i) for i in range(len(values))])
    return [found[d] for d in dimensions]


def cell_numbers(rows: DataFrame, dimensions: Sequence[str], bits: int) -> list[list[float]]:
    """Cut points of every dimension: at most ``2**bits - 1`` quantiles over all rows."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = rows.agg(*[
        F.percentile_approx(ordinal(rows, d), shares, 10_000).alias(f"q{i}")
        for i, d in enumerate(dimensions)
    ]).first()
    return [sorted(cuts) if cuts else [] for cuts in found]


def hilbert_shards(
    rows: DataFrame,
    dimensions: Sequence[str],
    shards: int,
    key: str,
    tie: Sequence[str] = (),
    bits: int = 5,
) -> DataFrame:
    """``rows`` with ``hilbert`` (curve index), ``shard`` and ``slot`` (place in the shard, from 0).

    Shards are runs of the curve; with ``n = shards * q + r`` rows the first ``r`` shards have
    ``q + 1`` rows and the others ``q``, so an empty table has none and a table with fewer rows than
    shards leaves the last shards empty. Rows of one cell follow ``tie``, then ``key``; rows equal
    in all of these take neighbouring slots in no particular order. Strings are cut as whole strings, so a
    common prefix takes nothing from a dimension. NULL in a dimension is in the lowest cell. Any other column is carried along untouched; a column already
    called ``hilbert``, ``shard`` or ``slot`` is refused.

    No row meets all others: the sort is by ranges that include the key, so one hot cell or value
    spreads over many tasks, and global numbers are the row's place in its range plus the sizes of
    the ranges before it (one number per task).
    """
    clash = {CURVE, "shard", "slot"} & {c.lower() for c in rows.columns}
    if clash:
        raise ValueError(f"The rows already have columns {sorted(clash)}")
    spark = rows.sparkSession
    placed = cells(rows, dimensions, bits)
    cuts = [c for _, c in placed]

    def index(values: pd.DataFrame) -> pd.Series:
        columns = []
        for at, name in enumerate(values):
            v = values[name].to_numpy(dtype=float)
            cell = np.searchsorted(np.asarray(cuts[at], dtype=float), v, side="left")
            columns.append(np.where(np.isnan(v), 0, cell))
        return pd.Series(hilbert_index(np.stack(columns, axis=1), bits))

    curve = F.pandas_udf(index, "long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [CURVE, *tie, key]
    ranges, place = distinct_name(rows, "_range"), distinct_name(rows, "_place")
    indexed = rows.withColumn(CURVE, curve(F.struct(*[
        number.alias(f"d{i}") for i, (number, _) in enumerate(placed)
    ])))
    ranged = work_table(
        indexed.repartitionByRange(tasks, *order).withColumn(ranges, F.spark_partition_id()),
        "hilbert-ranges",
    )
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy(ranges).count().collect())
    total = sum(n for _, n in sizes)
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    offsets = spark.createDataFrame(starts, f"{ranges} int, _before long")
    numbered = ranged.withColumn(
        place, F.row_number().over(Window.partitionBy(ranges).orderBy(*order)) - 1
    )
    rank = F.col("_before") + F.col(place)
    small, more = divmod(total, shards)
    edge = more * (small + 1)
    shard = F.when(rank < edge, F.floor(rank / (small + 1)))
    slot = F.when(rank < edge, rank % (small + 1))
    if small:
        shard = shard.otherwise(more + F.floor((rank - edge) / small))
        slot = slot.otherwise((rank - edge) % small)
    # One row per task of the sort: a size fixed by the job, not by the data.
    placed = numbered.join(F.broadcast(offsets), ranges)
    return placed.select(
        *[F.col(f"`{c}`") for c in rows.columns], CURVE,
        shard.cast("int").alias("shard"), slot.cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows along the curve, so that file statistics are narrow."""
    (sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
