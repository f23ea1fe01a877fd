"""Rule flags, quarantine and expectations. A rule is a name and a SQL predicate."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule names and predicates.
EVENT_RULES = {
    "valid_json": "NOT _parse_error",
    "valid_event_id": "event_id IS NOT NULL",
    "valid_event_time": "event_time IS NOT NULL",
    "valid_wiki_domain": "length(trim(wiki)) > 0 AND length(trim(domain)) > 0",
    "valid_length": "coalesce(length_old, 0) >= 0 AND coalesce(length_new, 0) >= 0",
}
REFERENCE_RULES = {
    "valid_wiki_code": "wiki_code IS NOT NULL",
    "valid_url": "site_url IS NULL OR startswith(site_url, 'http')",
}
SNAPSHOT_EXPECTATIONS = {
    "valid_wiki_code": "wiki_code IS NOT NULL",
    "valid_project_name": "project_name IS NOT NULL",
}


def holds(predicate: str) -> Column:
    """A predicate that cannot be decided counts as broken."""
    return F.expr(f"coalesce({predicate}, false)")


def future_time_rule(tolerance: str = "1 DAY") -> dict[str, str]:
    """Optional extra rule: a clean row far in the future would push the watermark past everyone."""
    return {
        "plausible_event_time": f"event_time <= coalesce(bronze_ingested_at, current_timestamp()) + INTERVAL {tolerance}"
    }


def dq_flags(rows: DataFrame, rules: Mapping[str, str] = EVENT_RULES) -> DataFrame:
    """One ``_dq_<rule>`` per rule, ``_dq_passed`` and the failed names in rule order."""
    flagged = rows.withColumns({f"_dq_{name}": holds(text) for name, text in rules.items()})
    passed = " AND ".join(f"_dq_{name}" for name in rules)
    reasons = ", ".join(f"CASE WHEN NOT _dq_{name} THEN '{name}' END" for name in rules)
    return flagged.withColumns(
        {
            "_dq_passed": F.expr(passed),
            "_dq_failure_reasons": F.expr(f"array_compact(array({reasons}))"),
        }
    )


def good_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter("_dq_passed")


def bad_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter("NOT _dq_passed")


def quarantine(flagged: DataFrame) -> DataFrame:
    """Rejected rows, every delivered copy of them."""
    return bad_rows(flagged).withColumn("_quality_status", F.lit("quarantined"))


def expect_warn(rows: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Violations per rule from one pass over the rows; nothing is dropped."""
    counted = rows.agg(
        *[F.count_if(~holds(text)).alias(name) for name, text in rules.items()],
        F.count("*").alias("_rows"),
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    )
    return counted.select(F.inline(pairs), F.col("_rows").alias("total_rows"))


def observe_rules(rows: DataFrame, name: str, rules: Mapping[str, str]) -> DataFrame:
    """The same counts as a side effect of another job (batch or stream)."""
    return rows.observe(
        name, *[F.count_if(~holds(text)).alias(rule) for rule, text in rules.items()]
    )


def expect_drop(rows: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep rows that satisfy every rule."""
    return rows.filter(reduce(lambda a, b: a & b, [holds(text) for text in rules.values()]))


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    return (
        rejected.select(F.explode("_dq_failure_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rejected"))
        .orderBy(F.desc("rejected"), "reason")
    )


def rejects_by_reason_set(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy("_dq_failure_reasons")
        .agg(F.count("*").alias("rejected"))
        .orderBy(F.desc("rejected"), "_dq_failure_reasons")
    )


def parse_error_rate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_parse_error").agg(F.count("*").alias("rows"))
