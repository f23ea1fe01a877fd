"""Row and column policies as frame transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.masking import mask_ip, mask_user
from siltbed.operators.facts import HUMAN_KEY

# Editor kinds that a reader without privileges may see, per policy.
VISIBLE = {"current": (1, 2), "humans_only": (HUMAN_KEY,)}
MASKS = {"handle": mask_user, "network": mask_ip}


def row_policy(facts: DataFrame, privileged: bool = False, policy: str = "current") -> DataFrame:
    if privileged:
        return facts
    return facts.filter(F.col("editor_type_key").isin(*VISIBLE[policy]))


def column_policy(
    facts: DataFrame, privileged: bool = False, mask: str = "handle", column: str = "user"
) -> DataFrame:
    return facts.withColumn(column, MASKS[mask](F.col(column), privileged))


def secured(
    facts: DataFrame, privileged: bool = False, policy: str = "current", mask: str = "handle"
) -> DataFrame:
    """What a reader of the given role sees: row filter first, then the mask."""
    return column_policy(row_policy(facts, privileged, policy), privileged, mask)


def secured_view(facts: DataFrame, view: str, **role: object) -> None:
    """Name the secured frame for SQL. Rebuild it after each publication."""
    secured(facts, **role).createOrReplaceTempView(view)
