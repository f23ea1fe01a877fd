"""Column masks and row predicates. Group membership is an argument, not a platform call."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# What a reader without privileges sees.
HANDLE_KEEP, HANDLE_TAIL = 2, "***"
IPV4, IPV4_TAIL = r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$", ".xxx.xxx"
IPV6_KEEP, IPV6_TAIL = 9, "::xxxx"


def _flag(privileged: bool | Column) -> Column:
    return privileged if isinstance(privileged, Column) else F.lit(privileged)


def mask_user(user: Column, privileged: bool | Column = False) -> Column:
    """Handle reduced to its first characters."""
    masked = F.concat(F.substring(user, 1, HANDLE_KEEP), F.lit(HANDLE_TAIL))
    return F.when(_flag(privileged), user).otherwise(masked)


def mask_ip(user: Column, privileged: bool | Column = False) -> Column:
    """Only network addresses are reduced; account names stay for attribution."""
    network = F.substring_index(user, ".", 2)
    masked = (
        F.when(user.rlike(IPV4), F.concat(network, F.lit(IPV4_TAIL)))
        .when(user.contains(":"), F.concat(F.substring(user, 1, IPV6_KEEP), F.lit(IPV6_TAIL)))
        .otherwise(user)
    )
    return F.when(_flag(privileged), user).otherwise(masked)


def register_masks(spark: SparkSession) -> None:
    """The same masks for SQL users, as plain SQL functions (no Python at run time)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_user(handle STRING, privileged BOOLEAN) "
        f"RETURN IF(privileged, handle, concat(substring(handle, 1, {HANDLE_KEEP}), '{HANDLE_TAIL}'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION edit_visible(editor_type_key INT, privileged BOOLEAN) "
        "RETURN privileged OR editor_type_key IN (1, 2)"
    )
