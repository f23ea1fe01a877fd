"""Raw events -> flagged rows -> clean and quarantined rows. Batch and stream share this plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.dedup import KEY, dedup_batch, event_key, repeated_keys, with_hash
from siltbed.operators.parse import parse_events
from siltbed.operators.quality import EVENT_RULES, dq_flags, good_rows, quarantine
from siltbed.sources.inbox import decode_inbox


def refine(
    inbox: DataFrame, rules: Mapping[str, str] = EVENT_RULES, now: Column | None = None
) -> DataFrame:
    """Decode, parse, key and flag; no row is lost and none is merged."""
    return dq_flags(event_key(parse_events(decode_inbox(inbox, now=now), now=now)), rules)


def clean_events(flagged: DataFrame, valid_first: bool = True) -> DataFrame:
    """Valid rows, one per key.

    ``valid_first=False`` removes duplicates before the rules are applied, as older jobs did;
    an invalid copy can then displace its valid twin.
    """
    # With identical validity any copy may stay; the order only makes reruns repeatable.
    order = [F.col("event_time").asc_nulls_last(), F.xxhash64("event_json")]
    if valid_first:
        return dedup_batch(good_rows(flagged), KEY, order)
    return good_rows(dedup_batch(flagged, KEY, order))


def clean_staged(staged: DataFrame) -> DataFrame:
    """``clean_events`` of rows that lie in files: only rows whose key may be repeated are moved."""
    good = good_rows(staged)
    repeated = repeated_keys(good)
    return with_hash(good, repeated, False).unionByName(clean_events(with_hash(good, repeated)))


def quarantined_events(flagged: DataFrame) -> DataFrame:
    return quarantine(flagged)
