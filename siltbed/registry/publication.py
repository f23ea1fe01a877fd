"""Registered queries: jobs and publication on plain Parquet, change feeds and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators import checks, chunks, corpus, merge
from siltbed.operators.dimensions import calendar_bounds
from siltbed.plans import feed, jobs, store
from siltbed.plans.publish import (
    Publication, create_if_absent, publish_all, publish_table, published_or_none, snapshot_backup,
)
from siltbed.registry.base import Registry
from siltbed.registry.capture_history import HISTORY, orders_after, orders_before, reference_snapshots
from siltbed.registry.corpus_answers import GENERATION_SQL, PIECES, RANKED, START, END, USABLE, chunked, page_responses, print_sql
from siltbed.registry.events_gold import fixed_now, flagged
from siltbed.registry.oracle_events import on_events, on_star
from siltbed.schemas import FACT
from siltbed.session import work_dir
from siltbed.sources.recast import event_base, inbox, reference, tables

R = Registry()


def _published(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """All jobs on the recast inbox: events, then dimensions, then the facts from the published files."""
    root = work_dir(spark, "gold")
    jobs.publish_events(flagged(spark, d), root)
    active = reference(spark, d).drop("n_nationkey")
    jobs.publish_reference(active, root, fixed_now())
    times = event_base(spark, d).select(F.timestamp_micros("us").alias("t"))
    jobs.publish_calendar(spark, calendar_bounds(times, "t"), root)
    return jobs.publish_facts(spark, root, fixed_now()), root


_BY_DAY = """SELECT date_key, editor_type_key, count(*) AS edits, CAST(sum(byte_change) AS BIGINT) AS net_bytes
FROM fact GROUP BY 1, 2"""


def _by_day(facts: DataFrame) -> DataFrame:
    return facts.groupBy("date_key", "editor_type_key").agg(
        F.count("*").alias("edits"), F.sum("byte_change").alias("net_bytes")
    )


@R.query("publish_table", on_star(_BY_DAY))
def _(spark, d):
    return _by_day(_published(spark, d)[0])


@R.query("publish_gate_keeps_last", on_star(_BY_DAY))
def _(spark, d):
    """A second publication with doubled rows fails its gate; readers keep the first."""
    facts, root = _published(spark, d)

    clean = store.read_table(spark, root, jobs.CLEAN)

    def gate(written: DataFrame) -> None:
        checks.require_clean(checks.check_silver_gold(clean, written))

    try:
        publish_table(facts.unionByName(facts), jobs.FACT, root, gate, ["date_key"])
    except checks.CheckFailed:
        return _by_day(store.read_table(spark.newSession(), root, jobs.FACT))
    raise AssertionError("The gate let doubled facts through")


@R.query("create_if_absent", on_star(_BY_DAY))
def _(spark, d):
    """Setup after a publication changes nothing."""
    _, root = _published(spark, d)
    if create_if_absent(spark, jobs.FACT, FACT, root):
        raise AssertionError("Setup replaced a published table")
    return _by_day(store.read_table(spark, root, jobs.FACT))


@R.query("snapshot_backup", on_events("SELECT count(*) AS copied FROM delivered"))
def _(spark, d):
    """The second copy, of no rows, is ignored."""
    path = work_dir(spark, "backup")
    rows = inbox(spark, d)
    snapshot_backup(rows, path)
    snapshot_backup(rows.filter("false"), path)
    return spark.read.parquet(path).agg(F.count("*").alias("copied"))


@R.query("publish_conflict", on_star("SELECT 'second publisher' AS told, count(*) AS edits FROM fact"))
def _(spark, d):
    """Two publishers start from one snapshot: the first wins, the second is told and changes nothing."""
    facts, root = _published(spark, d)
    number = store.snapshot(spark, root).number
    versions = {name: store.write_version(rows, root, jobs.FACT, ["date_key"])
                for name, rows in (("first", facts), ("second", facts.unionByName(facts)))}
    store.commit(spark, root, {jobs.FACT: versions["first"]}, number)
    try:
        store.commit(spark, root, {jobs.FACT: versions["second"]}, number)
    except store.Conflict:
        rows = store.read_table(spark.newSession(), root, jobs.FACT)
        return rows.agg(F.lit("second publisher").alias("told"), F.count("*").alias("edits"))
    raise AssertionError("Both publishers won")


@R.query(
    "publish_events",
    on_events("""SELECT 'clean_events' AS "table", count(*) AS "rows" FROM silver
UNION ALL SELECT 'quarantined_events', count(*) FROM delivered WHERE NOT passed"""),
)
def _(spark, d):
    root = work_dir(spark, "events")
    found = jobs.publish_events(flagged(spark, d), root)
    counts = [rows.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, rows in found.items()]
    return checks.all_checks(counts)


_RAW_HISTORY = HISTORY.replace("FROM snap WINDOW", "FROM snap WHERE NOT (version = 2 AND site_url LIKE '%7') WINDOW")


@R.query(
    "reference_history",
    _RAW_HISTORY + """SELECT wiki_code, project_name, language_code, site_url, note, "__START_AT"::BIGINT AS start_version,
  "__END_AT"::BIGINT AS end_version, 'history' AS part FROM hist
UNION ALL SELECT wiki_code, project_name, language_code, 'none', note, NULL, NULL, 'quarantine' FROM snap
WHERE version = 2 AND site_url LIKE '%7'""",
)
def _(spark, d):
    """Three raw snapshots, one run of the job for each; quarantined rows are those of the second."""
    root, raw = work_dir(spark, "history"), reference_snapshots(spark, d)
    rejected = []
    for version in (1, 2, 3):
        one = raw.filter(F.col("version") == version).drop("version")
        rejected.append(jobs.publish_history(one, F.timestamp_seconds(F.lit(version)), root)[jobs.REJECTED_REFERENCE])
    columns = ["wiki_code", "project_name", "language_code", "site_url", "note"]
    past = store.read_table(spark, root, jobs.HISTORY).select(
        *columns, F.unix_seconds("__START_AT").alias("start_version"), F.unix_seconds("__END_AT").alias("end_version"),
        F.lit("history").alias("part"),
    )
    bad = checks.all_checks([r.select(columns) for r in rejected]).withColumns(
        {c: F.lit(None).cast("bigint") for c in ("start_version", "end_version")}
    )
    return past.unionByName(bad.withColumn("part", F.lit("quarantine")))


# --- change feeds --------------------------------------------------------------------------


def _order_versions(spark, d) -> list[DataFrame]:
    """Three states of the orders, as rows come, change and go; the third moves back some prices of the second."""
    first, second = orders_before(spark, d), orders_after(spark, d)
    third = second.filter("o_orderkey % 13 <> 5").withColumn(
        "price", F.when(F.col("o_orderkey") % 17 == 4, F.col("price") + 1).otherwise(F.col("price"))
    )
    return [first, second, third]


_V3 = """
third AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 17 = 4 THEN price + 1 ELSE price END AS price
  FROM s WHERE o_orderkey % 13 <> 5)"""


def _states() -> str:
    from siltbed.registry.capture_history import PLAN

    return PLAN[: PLAN.index("plan AS (")] + _V3.lstrip("\n")


@R.query(
    "feed_follow",
    _states() + " SELECT *, 'each' AS reader FROM third UNION ALL SELECT *, 'late' FROM third UNION ALL SELECT *, 'again' FROM third",
)
def _(spark, d):
    """A reader that follows every commit, one that comes late, and one that gets all of it once more."""
    root, key = work_dir(spark, "orders"), ["o_orderkey"]
    readers = {name: work_dir(spark, f"orders-{name}") for name in ("each", "late", "again")}
    source = (root, "orders")
    for state in _order_versions(spark, d):
        feed.publish_changes(state, "orders", root, key)
        if feed.follow(spark, source, readers["each"], "orders_copy", key) != 1:
            raise AssertionError("A commit was not applied")
    if feed.follow(spark, source, readers["late"], "orders_copy", key) != 3:
        raise AssertionError("The late reader missed a commit")
    feed.follow(spark, source, readers["again"], "orders_copy", key)
    rows, _ = feed.changes_since(spark, root, "orders", 0)
    held = store.read_table(spark, readers["again"], "orders_copy")
    publish_table(feed.apply_changes(held, rows, key), "orders_copy", readers["again"])
    if feed.follow(spark, source, readers["each"], "orders_copy", key):
        raise AssertionError("A delivery was applied twice")
    parts = [store.read_table(spark, r, "orders_copy").withColumn("reader", F.lit(n)) for n, r in readers.items()]
    return checks.all_checks(parts)


@R.query(
    "feed_rows",
    _states() + """, joined AS (
  SELECT 2::BIGINT AS _commit, t AS o, s AS n FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
  UNION ALL SELECT 3, s, third FROM s FULL JOIN third ON s.o_orderkey = third.o_orderkey),
changed AS (SELECT *, o.o_orderkey IS NULL AS came, n.o_orderkey IS NULL AS went FROM joined
  WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.price <> n.price),
rows AS (SELECT _commit, o AS r, CASE WHEN went THEN 'delete' ELSE 'before' END AS _action FROM changed WHERE NOT came
  UNION ALL SELECT _commit, n, CASE WHEN came THEN 'insert' ELSE 'update' END FROM changed WHERE NOT went)
SELECT r.o_orderkey, r.o_custkey, r.o_orderstatus, r.price, _action, _commit FROM rows""",
)
def _(spark, d):
    root = work_dir(spark, "orders")
    for state in _order_versions(spark, d):
        feed.publish_changes(state, "orders", root, ["o_orderkey"])
    return feed.changes_since(spark, root, "orders", 1)[0]


_CHANGED = f"""WITH {PIECES.strip()},
second AS (SELECT * REPLACE (CASE WHEN doc_id % 13 = 4 THEN 'x' ELSE revision END AS revision,
    CASE WHEN doc_id % 3 = 1 THEN 'moved' ELSE corpus_id END AS corpus_id) FROM chunked WHERE doc_id % 7 <> 2)"""


@R.query(
    "generation_from_feed",
    _CHANGED + f" SELECT corpus_id, {GENERATION_SQL} AS generation, count(*) AS chunk_count FROM second GROUP BY 1",
)
def _(spark, d):
    """Versions after inserts, updates, deletes and moves between corpora, from the first state and the feed alone."""
    columns = ["chunk_id", "document_id", "corpus_id", "content_hash", "revision", "source_url", "fetched_at"]
    first = chunked(spark, d).select(columns)
    doc = F.substring("document_id", 5, 20).cast("long")
    second = first.filter(doc % 7 != 2).withColumns({
        "revision": F.when(doc % 13 == 4, "x").otherwise(F.col("revision")),
        "corpus_id": F.when(doc % 3 == 1, "moved").otherwise(F.col("corpus_id")),
    })
    root = work_dir(spark, "chunks")
    feed.publish_changes(first, "chunks", root, ["chunk_id"])
    publish_table(chunks.generation_state(store.read_table(spark, root, "chunks")), "chunk_versions", root)
    position = store.snapshot(spark, root).number
    feed.publish_changes(second, "chunks", root, ["chunk_id"])
    changes, _ = feed.changes_since(spark, root, "chunks", position)
    state = store.read_table(spark, root, "chunk_versions")
    return chunks.generation_of(chunks.update_generation(state, changes, feed.sign()))


# --- the corpus job ------------------------------------------------------------------------

_WIKI, _LIMIT, _BUDGET = "nation_15wiki", 12, 30


def _answers(spark, d) -> DataFrame:
    return page_responses(spark, d).select(
        F.concat(F.lit("Page "), F.col("doc_id").cast("string")).alias("title"), "response_json"
    )


def _prepare(spark, d, root: str, limit: int = _LIMIT, answers: DataFrame | None = None) -> DataFrame:
    events = store.read_table(spark, root, jobs.CLEAN)
    answers = _answers(spark, d) if answers is None else answers
    start, end = (f"{t}+00:00" for t in (START, END))
    return jobs.prepare_corpus(spark, root, events, answers, start, end, limit, _BUDGET, wiki=_WIKI, now=fixed_now())


_JOB = f"""{RANKED}, {USABLE.strip().removeprefix("WITH ")},
found AS (SELECT r.title, r."rank", u.doc_id, CASE WHEN u.reject_reason IS NULL THEN replace(u.document_id, 'enwiki', '{_WIKI}') END AS document_id, u.body
  FROM ranked r LEFT JOIN used u ON r.title = concat('Page ', CAST(u.doc_id AS VARCHAR))
  WHERE r.wiki = '{_WIKI}' AND r."rank" <= {_BUDGET}),
firsts AS (SELECT *, document_id IS NOT NULL AND "rank" = min("rank") OVER (PARTITION BY document_id) AS is_new FROM found),
walk AS (SELECT *, sum(CAST(is_new AS INTEGER)) OVER (ORDER BY "rank") AS docs FROM firsts),
chosen AS (SELECT * FROM walk WHERE is_new AND docs <= {_LIMIT} AND (SELECT max(docs) FROM walk) >= {_LIMIT}),
parts AS (SELECT document_id, i, substr(body, CAST(i * 1800 + 1 AS BIGINT), 1800) AS piece FROM (
  SELECT *, unnest(generate_series(0, (length(body) - 1) // 1800)) AS i FROM chosen)),
made AS (SELECT '{corpus.corpus_id("2024-01-03T00:00:00+00:00", "2024-01-27T12:00:00+00:00", _LIMIT)}' AS corpus_id, document_id,
    CAST(i AS INTEGER) AS chunk_index, sha256(piece) AS content_hash FROM parts)"""


@R.query(
    "prepare_corpus",
    on_events(f""", {_JOB} SELECT corpus_id, document_id, chunk_index, content_hash,
  sha256(concat_ws('|', corpus_id, document_id, CAST(chunk_index AS VARCHAR))) AS chunk_id,
  'PREPARED' AS status, (SELECT count(*) FROM made) AS chunk_count FROM made"""),
)
def _(spark, d):
    """The whole job over published events, run twice: the second run takes every page from the cache."""
    root = work_dir(spark, "corpus")
    jobs.publish_events(flagged(spark, d), root)
    try:
        _prepare(spark, d, root)
    except checks.CheckFailed:  # a table with too few pages has no corpus
        empty = "corpus_id string, document_id string, chunk_index int, content_hash string, chunk_id string, status string, chunk_count long"
        return spark.createDataFrame([], empty)
    pieces = _prepare(spark, d, root, answers=_answers(spark, d).filter("false"))
    manifest = store.read_table(spark, root, jobs.MANIFEST).select("corpus_id", "generation", "status", "chunk_count")
    return pieces.join(manifest, ["corpus_id", "generation"]).select(
        "corpus_id", "document_id", "chunk_index", "content_hash", "chunk_id", "status", "chunk_count"
    )


@R.query(
    "prepare_corpus_incomplete",
    on_events(f""", {_JOB} SELECT 'FAILED' AS status,
  (CASE WHEN coalesce((SELECT max(docs) FROM walk), 0) >= {_LIMIT} THEN 1 ELSE 2 END)::BIGINT AS corpora, (SELECT count(*) FROM made) AS chunks_of_others,
  (SELECT count(DISTINCT document_id) FROM walk WHERE document_id IS NOT NULL) > {_LIMIT} AS documents_kept"""),
)
def _(spark, d):
    """A corpus that cannot be filled turns FAILED; the chunks of the other stay, usable documents are kept."""
    root = work_dir(spark, "corpus")
    jobs.publish_events(flagged(spark, d), root)
    refused = 0
    for limit in (_LIMIT, _BUDGET):
        try:
            _prepare(spark, d, root, limit)
        except checks.CheckFailed:
            refused += 1
    if not refused:
        raise AssertionError("An incomplete corpus was published")
    failed = store.read_table(spark, root, jobs.MANIFEST).filter("status = 'FAILED'")
    pieces = published_or_none(spark, root, jobs.CHUNKS)
    return failed.groupBy("status").agg(F.count("*").alias("corpora")).withColumns({
        "chunks_of_others": F.lit(pieces.count() if pieces is not None else 0).cast("long"),
        "documents_kept": F.lit(store.read_table(spark, root, jobs.CONTENT).count() > _LIMIT),
    })


@R.query(
    "corpus_commit",
    f"WITH {PIECES} SELECT 'PREPARED' AS status, count(*) AS chunk_count, count(*) AS chunks, 2::BIGINT AS commits FROM chunked",
)
def _(spark, d):
    """Chunks and manifest appear together, or not at all where the run fails between their files."""
    root = work_dir(spark, "commit")
    pieces = chunked(spark, d).withColumn("corpus_id", F.lit("all"))

    def row(rows: DataFrame, status: str) -> DataFrame:
        return rows.groupBy("corpus_id").agg(F.lit(status).alias("status"), F.count("*").alias("chunk_count"))

    def broken(written: DataFrame) -> None:
        raise checks.CheckFailed("The run ends before the manifest is written")

    first = row(pieces, "PREPARING")
    publish_all(spark, root, {"chunks": Publication(pieces.filter("false")), "manifest": Publication(first)})
    moved = merge.merge_apply(chunks.manifest_upsert(store.read_table(spark, root, "manifest"), row(pieces, "PREPARED")))
    number = store.snapshot(spark, root).number
    try:
        publish_all(spark, root, {"chunks": Publication(pieces, broken), "manifest": Publication(moved)}, number)
    except checks.CheckFailed:
        if not store.read_table(spark, root, "chunks").isEmpty():
            raise AssertionError("Chunks are visible without their manifest row") from None
    publish_all(spark, root, {"chunks": Publication(pieces), "manifest": Publication(moved)}, number)
    held = store.snapshot(spark, root)
    chunks_now = store.read_table(spark, root, "chunks").groupBy("corpus_id").agg(F.count("*").alias("chunks"))
    return published_or_none(spark, root, "manifest").join(chunks_now, "corpus_id").select(
        "status", "chunk_count", "chunks", F.lit(held.number).cast("long").alias("commits")
    )
