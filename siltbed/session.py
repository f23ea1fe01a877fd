"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# UTC everywhere: date keys and hours must not depend on where a job runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python line of every column costs more than planning a wide query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "siltbed", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session; executor sizing and shuffle width stay the cluster's choice."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the time zone, which decides results, to a session somebody else created."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset the warehouse serves, as every executor can reach it too. Machine-local
    temporary folders are never used: on a cluster the other executors would not see them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
