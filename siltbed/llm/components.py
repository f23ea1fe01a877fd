"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import work_table


def _to_minimum(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """One star step: the neighbours of every node (all, or those not above it) move to the smallest of them."""
    both = edges if only_smaller else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(lowest, "a")
    if only_smaller:
        pairs = moved.select("b", "m").unionByName(lowest.select(F.col("a").alias("b"), "m"))
    else:
        pairs = moved.filter("b > a").select("b", "m")
    return pairs.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of ``edges`` (``a``, ``b``).

    Edges go both ways; loops, repeats and NULL ends are harmless. Nodes without edges do not appear.
    Every round is written to the shared work folder, so a lost executor costs one round at most, and
    the number of rounds grows with the logarithm of the longest chain. A node with very many
    neighbours is handled by partial aggregates and by AQE's splitting of skewed joins.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = work_table(edges.filter("a <> b").select(high, low).distinct(), "components")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or not state[0]:
            break
        mark = tuple(state)
        now = work_table(_to_minimum(_to_minimum(now, False), True), "components")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
