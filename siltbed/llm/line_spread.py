"""Line dedup by distinct-site spread: remove lines that stand on many different sites.

A HyperLogLog sketch of the sites is kept per line hash and merged by ordinary aggregation, so a line
that stands in a third of all documents costs one small sketch per task. Lines whose estimate is too
near the threshold to call get an exact distinct count. Then the lines go from the documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import distinct_name, marked, work_table

LG_K = 8
SIGMAS = 5


def _lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """One row per line of at least ``min_chars`` characters, with a 96-bit key of the line."""
    split = docs.select("_rid", "_key", "_site", F.posexplode(F.split(F.col(text), "\n", -1)).alias("_line", "_value"))
    return split.filter(F.length("_value") >= min_chars).select(
        "_rid", "_key", "_site", "_line", F.xxhash64("_value").alias("_h1"), F.hash("_value").alias("_h2"),
    )


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Keys (``_h1``, ``_h2``) of the lines that stand on at least ``min_sites`` distinct sites."""
    sketched = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", LG_K)).alias("_sites")
    )
    error = SIGMAS * 1.04 / math.sqrt(2**LG_K)
    low, high = min_sites / (1 + error), min_sites / max(1 - error, 0.01)
    near = work_table(sketched.filter(F.col("_sites") >= math.floor(low)), "line-sketches")
    sure = near.filter(F.col("_sites") > math.ceil(high)).select("_h1", "_h2")
    close = near.filter(F.col("_sites") <= math.ceil(high)).select("_h1", "_h2")
    counted = (
        lines.join(close, ["_h1", "_h2"], "left_semi")
        .groupBy("_h1", "_h2").agg(F.countDistinct("_site").alias("_sites"))
        .filter(F.col("_sites") >= min_sites).select("_h1", "_h2")
    )
    return sure.unionByName(counted)


def copied_texts(slim: DataFrame, text: str, min_sites: int) -> DataFrame:
    """The rows (``_rid``, ``_key``) whose whole text stands on at least ``min_sites`` distinct sites."""
    texts = slim.filter(F.col(text).isNotNull()).select(
        "_rid", "_key", "_site", F.xxhash64(text).alias("_t1"), F.hash(text).alias("_t2")
    )
    # Counted per text and site first, so a text that stands everywhere is few rows in any task.
    counted = texts.groupBy("_t1", "_t2").agg(F.countDistinct("_site").alias("_sites"))
    wide = work_table(counted.filter(F.col("_sites") >= min_sites).select("_t1", "_t2"), "line-copied-texts")
    return texts.join(wide, ["_t1", "_t2"], "left_semi").select("_rid", "_key")


def drop_spread_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    min_chars: int = 1,
    keep_copies: bool = False,
) -> DataFrame:
    """``docs`` with the lines removed that stand on ``min_sites`` sites or more.

    Lines end at a line feed and are compared as they are; lines shorter than ``min_chars`` stay, which by
    default are the empty ones. Every document loses every such line, whatever remains of it. With
    ``keep_copies`` documents whose whole text itself stands on ``min_sites`` sites are left whole (for near-duplicate
    removal, which keeps one of them). The remaining lines keep their order. Adds ``n_lines`` and ``n_removed``; ``n_removed`` is 0 and the
    text unchanged where nothing goes, and a NULL text stays NULL with no lines. NULL is no site.
    Rows equal in key and text are treated alike; other columns pass through, and columns called
    ``n_lines`` or ``n_removed`` are refused.
    """
    if {"n_lines", "n_removed"} & {c.lower() for c in docs.columns}:
        raise ValueError("The rows already have a column n_lines or n_removed")
    rid = distinct_name(docs, "_rid")
    hit = {c: distinct_name(docs, f"_hit{c}") for c in ("_rid", "_key", "_gone")}
    rows = docs.withColumn(rid, F.xxhash64(F.col(key), F.col(text)))
    slim = rows.select(F.col(rid).alias("_rid"), F.col(key).alias("_key"), F.col(site).cast("string").alias("_site"), text)
    lines = _lines(slim, text, min_chars)
    spread = work_table(spread_lines(lines, min_sites), "spread-lines")
    # Rows equal in key and text give the same lines twice: the set of line numbers is the same.
    hits = (
        lines.join(spread, ["_h1", "_h2"], "left_semi")
        .groupBy("_rid", "_key", "_line").agg(F.count("*"))
        .groupBy("_rid", "_key").agg(F.collect_list("_line").alias("_gone"))
        .select(*[F.col(c).alias(n) for c, n in hit.items()])
    )
    if keep_copies:
        copies = copied_texts(slim, text, min_sites).select("_rid", "_key").distinct()
        copied = (F.col(hit["_rid"]) == F.col("_rid")) & F.col(hit["_key"]).eqNullSafe(F.col("_key"))
        hits = hits.join(work_table(copies, "line-copies"), copied, "left_anti")
    hits = work_table(hits, "line-hits")
    same = (F.col(rid) == F.col(hit["_rid"])) & F.col(key).eqNullSafe(F.col(hit["_key"]))
    # Texts that lose nothing stay where they are.
    flag = distinct_name(rows, "_maybe")
    rows = marked(rows, F.col(rid), hits, F.col(hit["_rid"]), flag)
    untouched = rows.filter(f"NOT `{flag}`").withColumn(hit["_gone"], F.lit(None).cast("array<int>"))
    joined = rows.filter(flag).join(hits, same, "left").drop(hit["_rid"], hit["_key"]).unionByName(untouched)
    gone = F.col(hit["_gone"])
    kept_whole = gone.isNull()
    parts = F.split(F.col(text), "\n", -1)
    numbers = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    left = F.array_join(F.transform(numbers, lambda i: F.get(parts, i)), "\n")
    shown = [
        F.when(kept_whole, F.col(text)).otherwise(left).alias(text) if c == text else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return joined.select(
        *shown,
        F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.when(kept_whole, 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
    )
