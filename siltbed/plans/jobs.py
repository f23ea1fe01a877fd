"""The jobs as functions from frames to published tables.

Every job writes its tables first and checks the written files; readers move over in one commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.functions.plans import stored
from siltbed.operators import checks, chunks, corpus, dimensions, facts, history, merge, quality
from siltbed.operators.dedup import KEY
from siltbed.plans import store
from siltbed.plans.publish import Publication, publish_all, publish_table, published_or_none
from siltbed.plans.refine import clean_staged, quarantined_events

FACT, PROJECTS, DATES, EDITORS = "fact_edits", "dim_project", "dim_date", "dim_editor_type"
CLEAN, QUARANTINE = "clean_events", "quarantined_events"
HISTORY, REJECTED_REFERENCE = "reference_history", "reference_quarantine"
CHUNKS, MANIFEST, CONTENT, ALIASES = "knowledge_chunks", "corpus_manifest", "article_content", "article_aliases"


def publish_events(flagged: DataFrame, root: str) -> dict[str, DataFrame]:
    """Publish clean and quarantined events of one inbox together.

    The inbox is parsed once: both tables, and the check that nothing got lost between them, read
    the flagged rows from files.
    """
    staged = stored(flagged, "flagged-events")
    clean, rejected = clean_staged(staged), quarantined_events(staged)
    published: dict[str, DataFrame] = {}

    def keep(written: DataFrame) -> None:
        published[CLEAN] = written

    def covered(written: DataFrame) -> None:
        checks.require_clean(checks.coverage_check(staged, published[CLEAN], written, KEY))

    return publish_all(
        staged.sparkSession, root, {CLEAN: Publication(clean, keep), QUARANTINE: Publication(rejected, covered)}
    )


def publish_reference(active: DataFrame, root: str, now: Column | None = None) -> DataFrame:
    """Gate the active list, publish the project dimension, and check what was published."""
    checks.require_true(facts.reference_gate(active), "publishable")
    projects = dimensions.dim_project(active, now)

    def gate(written: DataFrame) -> None:
        checks.require_true(checks.reference_checks(active, written), "passed")

    return publish_table(projects, PROJECTS, root, gate)


def publish_calendar(spark: SparkSession, bounds: DataFrame, root: str) -> None:
    """The two dimensions that do not depend on the reference list."""
    publish_all(spark, root, {
        DATES: Publication(dimensions.dim_date(bounds)), EDITORS: Publication(dimensions.dim_editor_type(spark)),
    })


def publish_facts(spark: SparkSession, root: str, now: Column | None = None) -> DataFrame:
    """Preflight on the published dimensions, then build, check and publish the facts of the published clean events.

    Readers keep the last good facts if the preflight or a check fails.
    """
    held = store.snapshot(spark, root)
    dates, editors, projects, clean = (
        store.read_table(spark, root, t, held.number) for t in (DATES, EDITORS, PROJECTS, CLEAN)
    )
    checks.require_true(facts.fact_preflight(dates, editors, projects), "ready")
    rows = facts.fact_edits(clean, projects, now)

    def gate(written: DataFrame) -> None:
        checks.require_clean(checks.gold_checks(clean, written, projects, dates))

    return publish_table(rows, FACT, root, gate, partition_by=["date_key"])


def reference_history(
    past: DataFrame, snapshot: DataFrame, at: Column
) -> tuple[DataFrame, DataFrame]:
    """Next history and the quarantined rows of one raw snapshot."""
    flagged = quality.dq_flags(snapshot, quality.REFERENCE_RULES)
    clean = quality.good_rows(flagged)
    if not history.duplicate_snapshot_keys(clean).isEmpty():
        raise checks.CheckFailed("The snapshot holds a project more than once")
    checks.require_true(history.snapshot_order_guard(past, at), "accepted")
    return history.scd2_apply(past, clean, at), quality.quarantine(flagged)


def publish_history(snapshot: DataFrame, at: Column, root: str) -> dict[str, DataFrame]:
    """Apply one raw snapshot to the published history; history and quarantined rows change together.

    A snapshot that is out of order, or that names a project twice, changes nothing. A second publisher
    that started from the same history is refused.
    """
    spark = snapshot.sparkSession
    held = store.snapshot(spark, root)
    past = published_or_none(spark, root, HISTORY)
    if past is None:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in snapshot.schema)
        past = reference_start(spark, columns)
    following, rejected = reference_history(past, snapshot, at)
    return publish_all(
        spark, root, {HISTORY: Publication(following), REJECTED_REFERENCE: Publication(rejected)}, held.number
    )


def reference_start(spark: SparkSession, columns: str, at_type: str = "TIMESTAMP") -> DataFrame:
    """An empty history."""
    ddl = f"{columns}, {history.START} {at_type}, {history.END} {at_type}"
    return spark.createDataFrame([], ddl)


def active_projects(past: DataFrame) -> DataFrame:
    return history.scd2_active(past).select(*history.PROJECT_KEYS, *history.PROJECT_TRACKED)


# The corpus job

CONTENT_COLUMNS = [
    "document_id", "wiki", "canonical_title", "source_url", "revision", "document_type", "text", "content_hash", "fetched_at",
]


def _manifest_row(spark: SparkSession, corpus_id: str, status: str, now: Column, version: DataFrame | None = None) -> DataFrame:
    """One manifest row; ``version`` brings generation and counts."""
    base = spark.range(1).select(F.lit(corpus_id).alias("corpus_id"))
    if version is None:
        base = base.withColumns({"generation": F.lit(None).cast("string"), "chunk_count": F.lit(0).cast("long"),
                                 "document_count": F.lit(0).cast("long")})
    else:
        base = version.select("corpus_id", "generation", "chunk_count", "document_count")
    return base.withColumns({"status": F.lit(status), "prepared_at": now})


def _stated(spark: SparkSession, root: str, row: DataFrame) -> tuple[Publication, int]:
    """The manifest after a status change that the flow allows, and the snapshot it starts from."""
    held = store.snapshot(spark, root)
    now = published_or_none(spark, root, MANIFEST)
    past = row.filter("false") if now is None else now
    faults = chunks.manifest_faults(past, row).collect()
    if faults:
        raise checks.CheckFailed(f"Status change not allowed: {faults[0].asDict()}")
    return Publication(merge.merge_apply(chunks.manifest_upsert(past, row))), held.number


def prepare_corpus(
    spark: SparkSession, root: str, events: DataFrame, responses: DataFrame, start: str, end: str, limit: int, budget: int,
    wiki: str = corpus.DEFAULT_WIKI, titles: Sequence[str] | None = None, refresh: str = "expired", ttl_hours: float = 168,
    now: Column | None = None,
) -> DataFrame:
    """Rank pages, take what the cache holds and the responses answer, select, chunk, label, and publish.

    ``responses`` are the captured answers for pages that the cache does not hold: ``title`` and
    ``response_json``. Chunks, manifest, documents and aliases change in one commit, so a reader never
    sees chunks without their manifest row. If too few documents are usable, the manifest row turns FAILED,
    usable documents are kept for the next run, and the chunks stay as they are. Returns the
    chunks of the corpus.
    """
    now = F.current_timestamp() if now is None else now
    chosen = corpus.corpus_id(start, end, limit, titles)
    first, last = (F.lit(t).cast("timestamp") for t in (start, end))
    wanted = None if not titles else spark.createDataFrame([(t,) for t in titles], "title string")
    ranked = corpus.rank_pages(events, first, last, budget, None, wanted).filter(F.col("wiki") == wiki)
    ranked = stored(ranked, "ranked-pages")
    if wanted is not None and not corpus.selection_guard(wanted, ranked).isEmpty():
        raise checks.CheckFailed("Some titles have no eligible event in the interval")
    opened, number = _stated(spark, root, _manifest_row(spark, chosen, "PREPARING", now))
    publish_all(spark, root, {MANIFEST: opened}, number)

    content, aliases = (published_or_none(spark, root, t) for t in (CONTENT, ALIASES))
    fetched = corpus.usable_summaries(responses.join(ranked.select("title"), "title", "left_semi"), wiki=wiki)
    fetched = fetched.filter("reject_reason IS NULL").withColumn("fetched_at", now)
    fetched = stored(fetched.select("title", *CONTENT_COLUMNS), "fetched-pages")
    if content is None:
        content, aliases = fetched.select(CONTENT_COLUMNS).filter("false"), fetched.select("wiki", "title", "document_id").filter("false")
    cached = corpus.cache_lookup(ranked, aliases, content)
    reuse = corpus.cache_policy(cached, now, ttl_hours, refresh).filter("plan = 'reuse'")
    reuse = stored(reuse.select("title", *CONTENT_COLUMNS), "cached-pages")
    found = fetched.join(reuse.select("title"), "title", "left_anti")
    lookups = reuse.select("wiki", "title", "document_id", F.lit(True).alias("cached")).unionByName(
        found.select("wiki", "title", "document_id", F.lit(False).alias("cached"))
    )
    selected = stored(corpus.select_documents(ranked, lookups, limit, budget), "selected-pages")
    # Only pages within the budget were fetched; what they gave is kept whatever becomes of the corpus.
    asked = selected.filter("NOT coalesce(cached, false) AND status <> 'budget_exhausted'").select("title", "rank")
    taken = found.join(asked, "title")
    fresh = top_per_group(taken, ["document_id"], [F.asc("rank")], 1, "_n").select(CONTENT_COLUMNS)
    kept = {
        CONTENT: Publication(merge.merge_apply(merge.merge_plan(content, fresh, ["document_id"]))),
        ALIASES: Publication(merge.merge_apply(merge.merge_plan(aliases, taken.select("wiki", "title", "document_id"), ["wiki", "title"]))),
    }
    report = corpus.selection_report(selected, limit).first()
    if report is None or not report["complete"]:
        failed, number = _stated(spark, root, _manifest_row(spark, chosen, "FAILED", now))
        publish_all(spark, root, {**kept, MANIFEST: failed}, number)
        raise checks.CheckFailed(f"Only {report['documents'] if report else 0} of {limit} documents are usable")

    usable = selected.filter("status = 'usable'").select("title")
    documents = reuse.unionByName(found).join(usable, "title", "left_semi").drop("title", "wiki")
    pieces = stored(chunks.with_generation(chunks.chunk_fixed(documents, F.lit(chosen))), "corpus-chunks")
    version = pieces.groupBy("corpus_id", "generation").agg(
        F.count("*").alias("chunk_count"), F.countDistinct("document_id").alias("document_count")
    )
    prepared, number = _stated(spark, root, _manifest_row(spark, chosen, "PREPARED", now, version))
    past = published_or_none(spark, root, CHUNKS)
    past = pieces.filter("false") if past is None else past
    merged = merge.merge_apply(merge.replace_within(past, pieces, ["chunk_id"], "corpus_id"))

    def whole(written: DataFrame) -> None:
        counted = written.filter(F.col("corpus_id") == chosen).agg(F.count("*").alias("n"))
        promised = version.agg(F.sum("chunk_count").alias("n"))
        if counted.first()["n"] != promised.first()["n"]:
            raise checks.CheckFailed("The written chunks are not those of the manifest")

    publish_all(spark, root, {**kept, CHUNKS: Publication(merged, whole), MANIFEST: prepared}, number)
    return store.read_table(spark, root, CHUNKS).filter(F.col("corpus_id") == chosen)
