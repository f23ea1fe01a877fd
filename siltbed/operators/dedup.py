"""Event identity and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.functions.plans import stored
from siltbed.functions.text import digest

KEY = "_event_key"
# Parts of the fallback key, joined with "|", a missing part as an empty string.
FALLBACK_PARTS = ("wiki", "event_id", "event_timestamp_unix", "event_json")


def event_key(rows: DataFrame, column: str = KEY) -> DataFrame:
    """The event's own id, else a hash of its identifying content."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FALLBACK_PARTS]
    return rows.withColumn(
        column, F.coalesce(F.col("meta_id"), digest(F.concat_ws("|", *parts)))
    )


def dedup_batch(
    rows: DataFrame, key: str = KEY, order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key. Without an order any copy may stay; with one the first stays.

    Both forms drop copies inside each map task before the shuffle, so a key with a large
    share of the rows costs one row per task.
    """
    if order is None:
        return rows.dropDuplicates([key])
    return top_per_group(rows, [key], order, 1, "_copy").drop("_copy")


def repeated_keys(rows: DataFrame, key: str = KEY, known: DataFrame | None = None) -> DataFrame:
    """Hashes of the keys that occur more than once in ``rows``, or in ``rows`` and in ``known``; for rows that lie in files.

    Eight bytes of each key are shuffled. Two keys of one hash count as repeated too, so an exact step on
    the rows of these hashes (``with_hash``) and none on the others gives the exact result.
    """
    seen = rows.select(F.xxhash64(key).alias("_hash"), F.lit(True).alias("_own"))
    if known is not None:
        seen = seen.unionByName(known.select(F.xxhash64(key).alias("_hash"), F.lit(False).alias("_own")))
    counted = seen.groupBy("_hash").agg(F.count("*").alias("_n"), F.max("_own").alias("_own"))
    return stored(counted.filter("_own AND _n > 1").select("_hash"), "repeated-keys")


def with_hash(rows: DataFrame, hashes: DataFrame, found: bool = True, key: str = KEY) -> DataFrame:
    """Rows whose key has one of the hashes, or (``found=False``) none of them."""
    how = "left_semi" if found else "left_anti"
    return rows.withColumn("_hash", F.xxhash64(key)).join(hashes, "_hash", how).select(rows.columns)


def duplicate_payloads(rows: DataFrame, column: str = "event_json") -> DataFrame:
    """Values delivered more than once."""
    return (
        rows.groupBy(column)
        .agg(F.count("*").alias("deliveries"))
        .filter(F.col("deliveries") > 1)
    )


def key_kinds(rows: DataFrame, key: str = KEY) -> DataFrame:
    """How many rows carry their own id and how many rely on the fallback hash."""
    kind = F.when(F.col("meta_id").isNotNull(), "meta_id").otherwise("content_hash")
    return rows.groupBy(kind.alias("key_kind")).agg(
        F.count("*").alias("rows"), F.countDistinct(key).alias("keys")
    )
