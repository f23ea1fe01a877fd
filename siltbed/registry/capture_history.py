"""Registered queries: capture and landing, type-2 history, merge plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.operators import history as hist
from siltbed.operators import merge
from siltbed.registry.base import Registry
from siltbed.registry.events_gold import fixed_now
from siltbed.registry.oracle_events import on_events
from siltbed.schemas import PAYLOAD
from siltbed.session import work_dir
from siltbed.sources import capture, sites
from siltbed.sources.recast import (
    CUSTOMER_CODE,
    CUSTOMER_LANGUAGE,
    SNAPSHOT_FIELDS,
    inbox,
    raw_changes,
    snapshots,
    tables,
)

R = Registry()
NOW_MICROS = 1706745600000000

# --- admission -----------------------------------------------------------------------------

_REASON = """CASE WHEN _parse_error THEN 'malformed' WHEN domain = 'canary' THEN 'canary'
  WHEN event_type <> 'edit' THEN 'change_type' WHEN domain NOT LIKE '%5.example.org' THEN 'domain'
  WHEN meta_id IS NULL THEN 'missing_id' END"""


def _labelled(spark, d):
    return capture.admit_events(raw_changes(spark, d), "edit", "5.example.org")


@R.query("admit_events", on_events(f"SELECT e, {_REASON} AS drop_reason FROM flagged"))
def _(spark, d):
    return _labelled(spark, d).select("e", "drop_reason")


@R.query(
    "admission_metrics",
    on_events(f"SELECT coalesce({_REASON}, 'kept') AS outcome, count(*) AS events FROM flagged GROUP BY 1"),
)
def _(spark, d):
    return capture.admission_metrics(_labelled(spark, d))


@R.query(
    "stamp_producer",
    on_events(
        f"""SELECT meta_id AS event_key, {NOW_MICROS} AS produced_at, event_id, title, length_new, "user",
  'recent-change' AS source, '2024-02-01T00:00:00.000000Z' AS stamped_at FROM flagged WHERE {_REASON} IS NULL"""
    ),
)
def _(spark, d):
    kept = capture.admitted(_labelled(spark, d))
    stamped = capture.stamp_producer(kept, fixed_now())
    return stamped.withColumn("p", F.explode(F.array(F.from_json("event_json", PAYLOAD)))).select(
        "event_key", "produced_at", F.col("p.id").alias("event_id"), "p.title",
        F.col("p.length.new").alias("length_new"), "p.user", "p._producer.source",
        F.col("p._producer.producer_timestamp_utc").alias("stamped_at"),
    )


_KEY = "coalesce(CASE WHEN e % 71 <> 0 THEN concat('evt-', CAST(e AS VARCHAR)) END, concat('raw-', CAST(e AS VARCHAR)))"
_INBOX = f"SELECT e, event_id, {_KEY} AS event_key, us + copy * 1000000 AS produced_at FROM delivered"


@R.query(
    "first_wins_capture",
    on_events(f"SELECT event_key, min(produced_at) AS produced_at FROM ({_INBOX}) GROUP BY 1"),
)
def _(spark, d):
    return capture.first_wins(inbox(spark, d), "produced_at").select("event_key", "produced_at")


@R.query(
    "validate_batch",
    on_events(
        f""", rec AS (SELECT *, CASE WHEN e % 37 = 0 THEN ' ' WHEN e % 43 = 0 THEN 'same' ELSE {_KEY} END AS k2
  FROM flagged)
SELECT * FROM (
  SELECT 'blank_key' AS rule, count(*) FILTER (trim(k2) = '') AS violations FROM rec
  UNION ALL SELECT 'repeated_key', count(*) FROM (SELECT k2 FROM rec GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'bad_time', count(*) FILTER (e % 41 = 0) FROM rec
  UNION ALL SELECT 'payload_not_object', count(*) FILTER (_parse_error) FROM rec
  UNION ALL SELECT 'key_mismatch', count(*) FILTER (NOT _parse_error AND meta_id IS DISTINCT FROM k2) FROM rec
  UNION ALL SELECT 'wrong_type', count(*) FILTER (NOT _parse_error AND event_type <> 'edit') FROM rec
) WHERE violations > 0"""
    ),
)
def _(spark, d):
    key = F.when(F.expr("e % 37 = 0"), " ").when(F.expr("e % 43 = 0"), "same")
    records = raw_changes(spark, d).select(
        "event_json",
        key.otherwise(F.col("event_key")).alias("event_key"),
        F.when(F.expr("e % 41 = 0"), 0).otherwise(F.col("us")).alias("produced_at"),
    )
    return capture.validate_batch(records)


@R.query(
    "replay_with_duplicates",
    on_events(
        f""", i AS ({_INBOX})
SELECT event_key, produced_at FROM i
UNION ALL SELECT * FROM (SELECT event_key, produced_at FROM i ORDER BY produced_at, event_key LIMIT 20)"""
    ),
)
def _(spark, d):
    return capture.replay_with_duplicates(
        inbox(spark, d).select("event_key", "produced_at"), 20, ["produced_at", "event_key"]
    )


_SEEN = f", i AS ({_INBOX}), seen AS (SELECT * FROM i WHERE produced_at // 1000000 % 13 <> 0)"


@R.query(
    "inbox_visibility",
    on_events(
        f"""{_SEEN}
SELECT (SELECT count(DISTINCT event_key) FROM i) AS expected_keys,
  (SELECT count(DISTINCT event_key) FROM seen) AS visible_keys, false AS complete"""
    ),
)
def _(spark, d):
    seen = inbox(spark, d).filter("produced_at div 1000000 % 13 <> 0")
    return capture.inbox_visibility(raw_changes(spark, d), seen)


@R.query(
    "missing_keys",
    on_events(f"{_SEEN} SELECT DISTINCT event_key FROM i WHERE event_key NOT IN (SELECT event_key FROM seen)"),
)
def _(spark, d):
    seen = inbox(spark, d).filter("produced_at div 1000000 % 13 <> 0")
    return capture.missing_keys(raw_changes(spark, d), seen)


def _history(spark, d) -> DataFrame:
    """Older raw table: some rows have no text, some no ingest time."""
    return raw_changes(spark, d).select(
        F.expr("CASE WHEN e % 300 <> 0 THEN event_json END").alias("event_json"),
        F.expr("CASE WHEN e % 23 <> 0 THEN timestamp_micros(us) END").alias("_ingested_at"),
    )


def _held(spark, d) -> DataFrame:
    return raw_changes(spark, d).filter("e % 6 <> 0").select("event_json")


_LOST = "e % 6 = 0 OR e % 300 = 0"


@R.query(
    "backfill_missing",
    on_events(
        f"""SELECT CASE WHEN e % 300 <> 0 THEN event_id END AS event_id,
  CASE WHEN e % 300 <> 0 AND meta_id IS NOT NULL THEN meta_id ELSE 'hash' END AS event_key,
  CASE WHEN e % 23 <> 0 THEN us ELSE {NOW_MICROS} END AS produced_at FROM flagged WHERE {_LOST}"""
    ),
)
def _(spark, d):
    found = capture.backfill_missing(_history(spark, d), _held(spark, d), fixed_now())
    return found.select(
        F.from_json("event_json", PAYLOAD).getField("id").alias("event_id"),
        F.when(F.length("event_key") == 64, "hash").otherwise(F.col("event_key")).alias("event_key"),
        "produced_at",
    )


@R.query("backfill_coverage", on_events(f"SELECT count(*) AS missing FROM flagged WHERE {_LOST}"))
def _(spark, d):
    return capture.backfill_coverage(_history(spark, d), _held(spark, d))


# --- reference landing ---------------------------------------------------------------------


def _listings(spark, d) -> DataFrame:
    """One small site listing per customer: a language block and one special site."""
    site = F.struct(
        F.expr(CUSTOMER_CODE.replace("VARCHAR(20)", "STRING")).alias("dbname"),
        F.col("c_name").alias("sitename"),
        F.concat(F.lit("https://"), F.col("c_custkey").cast("string")).alias("url"),
    )
    twin = F.struct(
        F.concat(site["dbname"], F.lit("_b")).alias("dbname"),
        F.lit(None).cast("string").alias("sitename"),
        site["url"].alias("url"),
    )
    special = F.struct(
        F.concat(site["dbname"], F.lit("_s")).alias("dbname"),
        F.col("c_mktsegment").alias("sitename"),
        site["url"].alias("url"),
        F.expr("CASE WHEN c_custkey % 4 = 0 THEN 'meta' END").alias("code"),
    )
    block = F.struct(
        F.expr("CASE WHEN c_custkey % 6 <> 0 THEN lower(c_mktsegment) END").alias("code"),
        F.array(site, twin).alias("site"),
    )
    listing = F.struct(F.lit(3).alias("count"), block.alias("0"), F.array(special).alias("specials"))
    return tables(spark, d, "customer").select(
        F.to_json(F.struct(listing.alias("sitematrix"))).alias("listing_json")
    )


_SITES = """WITH c AS (SELECT *, concat('cust', CAST(c_custkey AS VARCHAR), 'wiki') AS code,
  concat('https://', CAST(c_custkey AS VARCHAR)) AS url FROM customer)
SELECT code AS wiki_code, c_name AS project_name,
  CASE WHEN c_custkey % 6 <> 0 THEN lower(c_mktsegment) ELSE 'unknown' END AS language_code, url AS site_url FROM c
UNION ALL SELECT concat(code, '_b'), NULL,
  CASE WHEN c_custkey % 6 <> 0 THEN lower(c_mktsegment) ELSE 'unknown' END, url FROM c
UNION ALL SELECT concat(code, '_s'), c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN 'meta' ELSE 'special' END, url FROM c"""


@R.query("flatten_sites", _SITES)
def _(spark, d):
    return sites.flatten_sites(_listings(spark, d))


@R.query(
    "batch_metadata",
    "SELECT wiki_code, 'reference-batch' AS _batch_run_id, 1706745600::BIGINT AS ingest_epoch FROM (" + _SITES + ")",
)
def _(spark, d):
    rows = sites.batch_metadata(sites.flatten_sites(_listings(spark, d)), now=fixed_now())
    return rows.select(
        "wiki_code", "_batch_run_id", F.unix_seconds("_ingest_timestamp").alias("ingest_epoch")
    )


@R.query(
    "landing_lineage",
    f"""SELECT count(*) AS listings, CAST(sum(n) AS BIGINT) AS sites, true AS traced, '2024-02-01' AS load_date
FROM (SELECT 3 AS n FROM customer)""",
)
def _(spark, d):
    path = work_dir(spark, "landing")
    _listings(spark, d).write.text(path)
    landed = sites.landed_files(spark, path, fixed_now(), whole=False)
    copy = work_dir(spark, "bronze")
    sites.land(landed, copy)
    bronze = spark.read.parquet(copy)
    # One entry per site in the listing text itself.
    return bronze.agg(
        F.count("*").alias("listings"),
        F.sum(F.size(F.regexp_extract_all("listing_json", F.lit('("dbname")'), F.lit(1)))).alias("sites"),
        F.every(F.col("source_file").startswith("file:") | F.col("source_file").contains("/")).alias("traced"),
        F.max(F.col("load_date").cast("string")).alias("load_date"),
    )


# --- type-2 history ------------------------------------------------------------------------


def reference_snapshots(spark, d) -> DataFrame:
    """The stacked snapshots as they arrive: in the second, some addresses are no links."""
    broken = (F.col("version") == 2) & F.col("site_url").endswith("7")
    return snapshots(spark, d).withColumn("site_url", F.when(broken, F.lit("none")).otherwise(F.col("site_url")))


def _snap_sql() -> str:
    parts = [
        f"SELECT {v} AS version, {CUSTOMER_CODE} AS wiki_code, {name} AS project_name, "
        f"{CUSTOMER_LANGUAGE} AS language_code, concat('https://', CAST(c_custkey AS VARCHAR)) AS site_url, "
        f"{note} AS note FROM customer WHERE {present}"
        for v, (present, name, note) in SNAPSHOT_FIELDS.items()
    ]
    return " UNION ALL ".join(parts)


HISTORY = f"""WITH snap AS ({_snap_sql()}),
marked AS (SELECT *, CASE WHEN lag(version) OVER w = version - 1
    AND lag(project_name) OVER w IS NOT DISTINCT FROM project_name
    AND lag(language_code) OVER w IS NOT DISTINCT FROM language_code
    AND lag(site_url) OVER w IS NOT DISTINCT FROM site_url THEN 0 ELSE 1 END AS starts
  FROM snap WINDOW w AS (PARTITION BY wiki_code ORDER BY version)),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY wiki_code ORDER BY version) AS run FROM marked),
hist AS (SELECT wiki_code, arg_max(project_name, version) AS project_name, max(language_code) AS language_code,
    max(site_url) AS site_url, arg_max(note, version) AS note, min(version) AS "__START_AT",
    CASE WHEN max(version) < 3 THEN max(version) + 1 END AS "__END_AT"
  FROM runs GROUP BY wiki_code, run)
"""


def _built(spark, d) -> DataFrame:
    return hist.scd2_from_snapshots(snapshots(spark, d), "version")


@R.query("scd2_from_snapshots", HISTORY + "SELECT * FROM hist")
def _(spark, d):
    return _built(spark, d)


@R.query("scd2_apply", HISTORY + "SELECT * FROM hist")
def _(spark, d):
    stacked = snapshots(spark, d)
    first = stacked.filter("version = 1").drop("version")
    start = first.withColumns({"__START_AT": F.lit(1), "__END_AT": F.lit(None).cast("int")})
    return reduce(
        lambda h, v: hist.scd2_apply(
            h, stacked.filter(F.col("version") == v).drop("version"), F.lit(v)
        ),
        (2, 3),
        start,
    )


@R.query("scd2_active", HISTORY + 'SELECT wiki_code, project_name, note FROM hist WHERE "__END_AT" IS NULL')
def _(spark, d):
    return hist.scd2_active(_built(spark, d)).select("wiki_code", "project_name", "note")


@R.query(
    "scd2_as_of",
    HISTORY
    + """SELECT wiki_code, project_name, language_code FROM hist
WHERE "__START_AT" <= 2 AND ("__END_AT" IS NULL OR "__END_AT" > 2)""",
)
def _(spark, d):
    return hist.scd2_as_of(_built(spark, d), F.lit(2)).select(
        "wiki_code", "project_name", "language_code"
    )


@R.query(
    "duplicate_snapshot_keys",
    """SELECT c_nationkey, c_mktsegment, count(*) AS copies FROM customer GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, d):
    return hist.duplicate_snapshot_keys(
        tables(spark, d, "customer"), ["c_nationkey"], "c_mktsegment"
    )


@R.query(
    "snapshot_order_guard",
    HISTORY
    + """SELECT max(greatest("__START_AT", coalesce("__END_AT", 0))) AS newest,
  max(greatest("__START_AT", coalesce("__END_AT", 0))) <= 2 AS accepted FROM hist""",
)
def _(spark, d):
    return hist.snapshot_order_guard(_built(spark, d), F.lit(2))


# --- merge plans ---------------------------------------------------------------------------

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "price"]
_OLD_STATUS = "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END"
_NEW_PRICE = "CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 9 = 0 THEN 5 ELSE 0 END"


def orders_before(spark, d) -> DataFrame:
    return tables(spark, d, "orders").filter("o_orderkey % 10 <> 3").select(
        "o_orderkey", "o_custkey", F.expr(_OLD_STATUS).alias("o_orderstatus"),
        F.expr("CAST(floor(o_totalprice) AS BIGINT)").alias("price"),
    )


def orders_after(spark, d) -> DataFrame:
    return tables(spark, d, "orders").filter("o_orderkey % 10 <> 7").select(
        "o_orderkey", "o_custkey", F.expr(_OLD_STATUS).alias("o_orderstatus"),
        F.expr(_NEW_PRICE).alias("price"),
    )


def _plan(spark, d) -> DataFrame:
    return merge.merge_plan(orders_before(spark, d), orders_after(spark, d), ["o_orderkey"])


PLAN = f"""WITH t AS (SELECT o_orderkey, o_custkey, {_OLD_STATUS} AS o_orderstatus,
    CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders WHERE o_orderkey % 10 <> 3),
s AS (SELECT o_orderkey, o_custkey, {_OLD_STATUS} AS o_orderstatus, {_NEW_PRICE} AS price
  FROM orders WHERE o_orderkey % 10 <> 7),
plan AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
    CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
    coalesce(s.price, t.price) AS price,
    CASE WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.o_orderkey IS NULL THEN 'insert'
      WHEN s.price = t.price THEN 'unchanged' ELSE 'update' END AS _action
  FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey)
"""


@R.query("merge_plan", PLAN + "SELECT * FROM plan")
def _(spark, d):
    return _plan(spark, d)


@R.query("merge_apply", PLAN + "SELECT o_orderkey, o_custkey, o_orderstatus, price FROM plan")
def _(spark, d):
    return merge.merge_apply(_plan(spark, d))


@R.query("merge_counts", PLAN + 'SELECT _action AS action, count(*) AS "rows" FROM plan GROUP BY 1')
def _(spark, d):
    return merge.merge_counts(_plan(spark, d))


@R.query("change_feed", PLAN + "SELECT * FROM plan WHERE _action IN ('insert', 'update')")
def _(spark, d):
    return merge.change_feed(_plan(spark, d))


@R.query(
    "chunk_diff",
    PLAN
    + """SELECT o_orderkey, price, CASE _action WHEN 'keep' THEN 'delete' ELSE _action END AS _action
FROM plan WHERE _action <> 'unchanged'""",
)
def _(spark, d):
    found = merge.chunk_diff(orders_before(spark, d), orders_after(spark, d), ["o_orderkey"])
    return found.select("o_orderkey", "price", "_action")


# The customers 0, 3, 6, ... are the corpora that the source replaces.
@R.query(
    "replace_within_corpus",
    PLAN.replace("FROM orders WHERE o_orderkey % 10 <> 7)", "FROM orders WHERE o_orderkey % 10 <> 7 AND o_custkey % 3 = 0)")
    + """SELECT o_orderkey, o_custkey, price, CASE WHEN _action = 'keep'
  AND o_custkey IN (SELECT o_custkey FROM s) THEN 'delete' ELSE _action END AS _action FROM plan""",
)
def _(spark, d):
    source = orders_after(spark, d).filter("o_custkey % 3 = 0")
    plan = merge.replace_within(orders_before(spark, d), source, ["o_orderkey"], "o_custkey")
    return plan.select("o_orderkey", "o_custkey", "price", "_action")


@R.query(
    "unchanged_rerun",
    PLAN + "SELECT (SELECT count(*) FROM plan) AS unchanged_rows, 0::BIGINT AS changes, true AS idle",
)
def _(spark, d):
    state = merge.merge_apply(_plan(spark, d))
    return merge.unchanged_rerun(merge.merge_plan(state, state, ["o_orderkey"]))
