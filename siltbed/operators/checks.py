"""Publication checks. Each is a frame of (``check_name``, ``violations``); a gate raises."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.operators.dimensions import UNKNOWN, project_key


class CheckFailed(AssertionError):
    """A gate found violations."""


def _counted(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def check_unique_keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Key values that occur more than once."""
    return _counted(rows.groupBy(key).count().filter("count > 1"), name)


def check_unique_project_keys(projects: DataFrame) -> DataFrame:
    return check_unique_keys(projects, "project_key", "unique_project_keys")


def fact_keys(facts: DataFrame) -> DataFrame:
    """Facts counted per project and day: all that the checks need to know about them."""
    return facts.groupBy("project_key", "date_key").agg(F.count("*").alias("n"))


def check_foreign_key(keyed: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Fact rows without a dimension row, from facts counted per key (``n``)."""
    counts = keyed.groupBy(key).agg(F.sum("n").alias("n"))
    orphans = counts.join(dimension.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def check_project_ri(facts: DataFrame, projects: DataFrame) -> DataFrame:
    return _project_ri(fact_keys(facts), projects)


def _project_ri(keyed: DataFrame, projects: DataFrame) -> DataFrame:
    return check_foreign_key(keyed, projects, "project_key", "project_referential_integrity")


def check_date_ri(facts: DataFrame, dates: DataFrame) -> DataFrame:
    return _date_ri(fact_keys(facts), dates)


def _date_ri(keyed: DataFrame, dates: DataFrame) -> DataFrame:
    return check_foreign_key(keyed, dates, "date_key", "date_referential_integrity")


def check_silver_gold(silver: DataFrame, facts: DataFrame) -> DataFrame:
    """Difference between the number of clean events and the number of facts."""
    return _reconcile(silver, facts.agg(F.count("*").alias("n")))


def _reconcile(silver: DataFrame, counted: DataFrame) -> DataFrame:
    clean = silver.agg(F.count("*").alias("signed"))
    both = clean.unionByName(counted.agg((-F.coalesce(F.sum("n"), F.lit(0))).alias("signed")))
    return both.agg(F.abs(F.sum("signed")).alias("violations")).select(
        F.lit("silver_gold_reconciliation").alias("check_name"), "violations"
    )


def gold_not_empty(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("n")).select(
        F.lit("gold_not_empty").alias("check_name"),
        F.when(F.col("n") == 0, 1).otherwise(0).cast("long").alias("violations"),
    )


def all_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Several checks as one job."""
    return reduce(DataFrame.unionByName, checks)


def gold_checks(
    silver: DataFrame, facts: DataFrame, projects: DataFrame, dates: DataFrame
) -> DataFrame:
    """All publication checks. The facts are read once: three checks share their key counts."""
    keyed = fact_keys(facts)
    return all_checks(
        [
            check_unique_project_keys(projects),
            _project_ri(keyed, projects),
            _date_ri(keyed, dates),
            _reconcile(silver, keyed),
        ]
    )


def reference_checks(active: DataFrame, projects: DataFrame) -> DataFrame:
    """One row that compares the active history with the published dimension."""
    published = (
        projects.select("project_key").distinct().withColumn("_published", F.lit(True))
    )
    source = (
        active.select(project_key(F.col("wiki_code")).alias("project_key"))
        .join(published, "project_key", "left")
        .agg(
            F.count("*").alias("source_projects"),
            F.count_if(F.col("_published").isNull()).alias("missing_projects"),
        )
    )
    target = projects.agg(
        F.count_if(F.col("wiki_code") != UNKNOWN).alias("published_projects"),
        F.countDistinct("project_key").alias("unique_keys"),
        F.count_if(F.col("wiki_code") == UNKNOWN).alias("fallback_projects"),
    )
    # Two one-row frames side by side, without a join.
    columns = (
        "source_projects", "published_projects", "unique_keys", "fallback_projects",
        "missing_projects",
    )
    merged = source.unionByName(target, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in columns]
    )
    return merged.withColumn(
        "passed",
        (F.col("source_projects") > 0)
        & (F.col("published_projects") == F.col("source_projects"))
        & (F.col("unique_keys") == F.col("published_projects") + 1)
        & (F.col("fallback_projects") == 1)
        & (F.col("missing_projects") == 0),
    )


def _both_sides(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Every value with whether the left side has it, and how many rows of the right side; one shuffle for both."""
    marked = left.select(value, F.lit(True).alias("_left"), F.lit(0).alias("_right")).unionByName(
        right.select(value, F.lit(False).alias("_left"), F.lit(1).alias("_right"))
    )
    return marked.groupBy(value).agg(F.max("_left").alias("_left"), F.sum("_right").alias("_right"))


def coverage_check(flagged: DataFrame, silver: DataFrame, rejected: DataFrame, key: str) -> DataFrame:
    """What the refinement lost: clean keys without a Silver row (late drops too), repeated
    Silver keys, and rejected payloads missing from quarantine."""
    keys = _both_sides(flagged.filter("_dq_passed"), silver, key).agg(
        F.count_if(F.expr("_left AND _right = 0")).alias("clean_keys_missing"),
        F.count_if(F.col("_right") > 1).alias("silver_keys_repeated"),
    )
    payloads = _both_sides(flagged.filter("NOT _dq_passed"), rejected, "event_json").agg(
        F.count_if(F.expr("_left AND _right = 0")).alias("rejected_payloads_missing")
    )

    def listed(counts: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in counts.columns]
        return counts.select(F.inline(F.array(*pairs)))

    return all_checks([listed(keys), listed(payloads)])


def require_clean(checks: DataFrame) -> None:
    """Raise if any check has violations; reads one row per failed check."""
    failed = {r["check_name"]: r["violations"] for r in checks.filter("violations <> 0").collect()}
    if failed:
        raise CheckFailed(f"Checks failed: {failed}")


def require_true(row: DataFrame, column: str) -> None:
    """Raise unless the flag of a one-row gate frame holds."""
    found = row.first()
    if found is None or not found[column]:
        raise CheckFailed(f"Gate {column} failed: {found.asDict() if found else 'no row'}")
