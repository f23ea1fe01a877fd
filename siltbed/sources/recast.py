"""Recast of the test tables into change events, reference lists and corpus inputs.

The event fields are stated as SQL text over ``e`` (event id), ``u`` (user), ``k`` (number in
``props``), ``et`` (type), ``v`` (value), ``secs`` (epoch second) and ``n`` (``u % 30``); the text
uses only what Spark and DuckDB compute alike, so that the oracles can start from the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.session import pin_session

EVENT_FIELDS = {
    "id": "CASE WHEN e % 89 <> 0 THEN e END",
    "type": "CASE WHEN et IN ('click', 'view') THEN 'edit' WHEN et = 'purchase' THEN 'new' "
    "WHEN et = 'signup' THEN 'categorize' ELSE 'log' END",
    "namespace": "CAST(CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS BIGINT)",
    "title": "CASE WHEN e % 401 = 7 THEN '  ' ELSE concat('Page ', CAST(e * 31 % 400 AS VARCHAR(20))) END",
    "comment": "concat('change ', CAST(k AS VARCHAR(20)))",
    "timestamp": "CASE WHEN e % 113 <> 0 THEN secs END",
    "user": "CASE WHEN u % 10 = 0 THEN concat('10.20.', CAST(u AS VARCHAR(20)), '.7') "
    "WHEN u % 10 = 1 THEN concat('2001:db8::', CAST(u AS VARCHAR(20))) "
    "ELSE concat('user_', CAST(u AS VARCHAR(20))) END",
    "bot": "CASE WHEN e % 17 <> 0 THEN u % 5 = 0 END",
    "minor": "CASE WHEN e % 19 <> 0 THEN k < 30 END",
    "wiki": "CASE WHEN e % 131 = 0 THEN '' WHEN n < 25 THEN concat('nation_', CAST(n AS VARCHAR(20)), 'wiki') "
    "ELSE concat('zz', CAST(n AS VARCHAR(20)), 'wiki') END",
    "meta_id": "CASE WHEN e % 71 <> 0 THEN concat('evt-', CAST(e AS VARCHAR(20))) END",
    "domain": "CASE WHEN e % 97 = 0 THEN 'canary' ELSE concat(CAST(n AS VARCHAR(20)), '.example.org') END",
    "length_old": "CASE WHEN et <> 'purchase' THEN CAST(floor(v * 100) AS BIGINT) END",
    "length_new": "CAST(floor(v * 100) AS BIGINT) + k * 10 - 450",
    "source": "CASE WHEN e % 3 <> 0 THEN 'recent-change' END",
}
BROKEN_TEXT = "e % 211 = 0"
TWICE = "e % 50 = 1"


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; the session is pinned to UTC first."""
    rows = pin_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return rows


def event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short names that ``EVENT_FIELDS`` refers to."""
    micros = "unix_micros(CAST(ts AS TIMESTAMP))"
    return tables(spark, sf_dir, "events").selectExpr(
        "event_id AS e",
        "user_id AS u",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "event_type AS et",
        "value AS v",
        f"{micros} AS us",
        f"{micros} div 1000000 AS secs",
        "user_id % 30 AS n",
    )


def raw_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One undelivered event per row: ``e``, ``us`` and the payload text."""
    fields = {k: v.replace("VARCHAR(20)", "STRING") for k, v in EVENT_FIELDS.items()}
    stamp = "date_format(timestamp_seconds(secs), \"yyyy-MM-dd'T'HH:mm:ss'{}'\")"
    dt = f"CASE WHEN e % 61 = 0 THEN 'not a date' ELSE {stamp.format('Z')} END"
    nested = ("meta_id", "domain", "length_old", "length_new", "source")
    payload = ", ".join(
        [f"'{name}', {text}" for name, text in fields.items() if name not in nested]
        + [
            f"'meta', named_struct('id', {fields['meta_id']}, 'domain', {fields['domain']}, 'dt', {dt})",
            f"'length', named_struct('old', {fields['length_old']}, 'new', {fields['length_new']})",
            f"'_producer', CASE WHEN e % 3 <> 0 THEN named_struct('source', {fields['source']}, "
            f"'producer_timestamp_utc', {stamp.format('+00:00')}) END",
        ]
    )
    # Few bytes of the table make much text to write and parse, so its file blocks would keep few cores busy.
    width = 4 * spark.sparkContext.defaultParallelism
    return event_base(spark, sf_dir).repartition(width, "e").selectExpr(
        "e",
        "us",
        f"CASE WHEN {BROKEN_TEXT} THEN concat('{{not-json ', CAST(e AS STRING)) "
        f"ELSE to_json(named_struct({payload})) END AS event_json",
        f"coalesce({fields['meta_id']}, concat('raw-', CAST(e AS STRING))) AS event_key",
    )


def inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered events: some arrive twice, the second copy one second later."""
    copies = F.expr(f"CASE WHEN {TWICE} THEN sequence(0, 1) ELSE array(0) END")
    return (
        raw_changes(spark, sf_dir)
        .withColumn("copy", F.explode(copies))
        .select(
            "event_json",
            "event_key",
            (F.col("us") + F.col("copy") * 1000000).alias("produced_at"),
        )
    )


# The reference list: one project per nation.
LANGUAGE_CODES = (
    "en de fr es it pt ru zh ja ko ar fa tr pl nl sv uk cs hu zz commons wikidata ? yue simple"
).split()


def _nation_code(name: str) -> str:
    return f"concat(replace(lower({name}), ' ', '_'), 'wiki')"


REFERENCE_FIELDS = {
    "wiki_code": _nation_code("n_name"),
    "project_name": "n_name",
    "language_code": "CASE "
    + " ".join(
        f"WHEN n_nationkey = {i} THEN {'NULL' if c == '?' else repr(c)}"
        for i, c in enumerate(LANGUAGE_CODES)
    )
    + " END",
    "site_url": "CASE WHEN n_nationkey % 11 = 6 THEN NULL WHEN n_nationkey % 11 = 5 "
    f"THEN concat('www.', {_nation_code('n_name')}, '.example.org') "
    f"ELSE concat('https://', {_nation_code('n_name')}, '.example.org') END",
}


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir, "nation").select(
        "n_nationkey", *[F.expr(text).alias(name) for name, text in REFERENCE_FIELDS.items()]
    )


# Three snapshots of a project list with one row per customer: v2 drops and renames, v3 restores.
SNAPSHOT_FIELDS = {
    1: ("true", "c_name", "c_mktsegment"),
    2: ("c_custkey % 7 <> 3", "CASE WHEN c_custkey % 5 = 0 THEN concat(c_name, ' (new)') ELSE c_name END",
        "CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_mktsegment END"),
    3: ("true", "CASE WHEN c_custkey % 5 = 0 AND c_custkey % 10 <> 0 THEN concat(c_name, ' (new)') ELSE c_name END",
        "c_mktsegment"),
}
CUSTOMER_CODE = "concat('cust', CAST(c_custkey AS VARCHAR(20)), 'wiki')"
CUSTOMER_LANGUAGE = "CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE concat('l', CAST(c_nationkey AS VARCHAR(20))) END"


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked snapshots: version, code, three tracked columns and an untracked one (``note``)."""
    customers = tables(spark, sf_dir, "customer")

    def one(version: int) -> DataFrame:
        present, name, note = SNAPSHOT_FIELDS[version]
        return customers.filter(present).select(
            F.lit(version).alias("version"),
            F.expr(CUSTOMER_CODE.replace("VARCHAR(20)", "STRING")).alias("wiki_code"),
            F.expr(name).alias("project_name"),
            F.expr(CUSTOMER_LANGUAGE.replace("VARCHAR(20)", "STRING")).alias("language_code"),
            F.concat(F.lit("https://"), F.col("c_custkey").cast("string")).alias("site_url"),
            F.expr(note).alias("note"),
        )

    return reduce(DataFrame.unionByName, [one(v) for v in SNAPSHOT_FIELDS])
