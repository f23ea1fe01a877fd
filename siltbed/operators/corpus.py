"""Choice of pages for a text corpus: ranking, page responses, cache and selection."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.functions.plans import once
from siltbed.functions.text import digest, short_digest, strip

# The eligibility rules, their published text, and the source of page responses.
RULES = "enwiki; namespace=0; edit/new; nonempty title; [start,end); count DESC,title ASC"
DEFAULT_WIKI = "enwiki"
ELIGIBLE_TYPES = ("edit", "new")
PAGE_HOST, PAGE_PATH, PAGE_TYPE = "en.wikipedia.org", "/wiki/", "standard"
SUMMARY_TYPE = "wikipedia_summary"
REFRESH = ("missing", "expired", "force")


def utc_interval(start: str, end: str) -> tuple[datetime, datetime]:
    """Parse two ISO times that must be explicitly UTC and in order."""
    times = [datetime.fromisoformat(text.replace("Z", "+00:00")) for text in (start, end)]
    if any(t.utcoffset() != timedelta(0) for t in times):
        raise ValueError("Times must carry an explicit UTC offset")
    if times[0] >= times[1]:
        raise ValueError("The interval is empty")
    return times[0], times[1]


def checked_titles(titles: Sequence[str] | None, limit: int) -> list[str]:
    """Sorted explicit titles: none, or exactly ``limit`` unique trimmed ones."""
    if titles is None or titles == []:
        return []
    well_formed = isinstance(titles, (list, tuple)) and all(
        isinstance(t, str) and t and t == t.strip() for t in titles
    )
    if not well_formed or len(set(titles)) != len(titles) or len(titles) != limit:
        raise ValueError("Titles must be unique, trimmed and as many as the article limit")
    return sorted(titles)


def corpus_id(start: str, end: str, limit: int, titles: Sequence[str] | None = None) -> str:
    """Identity of a corpus: a digest of everything that selects its pages."""
    first, last = utc_interval(start, end)
    if limit < 1:
        raise ValueError("The article limit is at least 1")
    parts = [first.isoformat(), last.isoformat(), str(limit), RULES]
    chosen = checked_titles(titles, limit)
    if chosen:
        parts.append("titles=" + json.dumps(chosen, ensure_ascii=False))
    return sha256("|".join(parts).encode()).hexdigest()[:24]


# The one rule for escapes, for a single request and for a table of them: backslash first, then the rest.
ESCAPES = {c: json.dumps(c)[1:-1] for c in ("\\", '"', *map(chr, range(32)))}


def quoted_title(title: Column) -> Column:
    """A title as a JSON string, with the escapes of ``corpus_id``."""
    body = reduce(lambda text, c: F.replace(text, F.lit(c), F.lit(ESCAPES[c])), ESCAPES, title)
    return F.concat(F.lit('"'), body, F.lit('"'))


def corpus_ids(requests: DataFrame) -> DataFrame:
    """``corpus_id`` for a table of requests; NULL where a request is not valid.

    Columns: ``start_utc``, ``end_utc``, ``article_limit`` and ``titles`` (NULL or empty: choose by
    frequency).
    """
    titles = F.array_sort(F.coalesce("titles", F.array().cast("array<string>")))
    quoted = F.transform(titles, quoted_title)
    listed = F.concat(F.lit("titles=["), F.array_join(quoted, ", "), F.lit("]"))
    clean = F.forall(titles, lambda t: (strip(t) == t) & (F.length(t) > 0))
    chosen = (
        (F.size(titles) == F.col("article_limit"))
        & (F.size(F.array_distinct(titles)) == F.size(titles))
        & F.coalesce(clean, F.lit(False))
    )
    valid = (
        (F.col("start_utc") < F.col("end_utc"))
        & (F.col("article_limit") >= 1)
        & ((F.size(titles) == 0) | chosen)
    )

    def iso(time: str) -> Column:
        whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.unix_micros(time) % 1_000_000
        part = F.when(micros != 0, F.date_format(time, ".SSSSSS")).otherwise("")
        return F.concat(whole, part, F.lit("+00:00"))

    text = F.concat_ws(
        "|", iso("start_utc"), iso("end_utc"), F.col("article_limit").cast("string"), F.lit(RULES),
        F.when(F.size(titles) > 0, listed),
    )
    return requests.withColumn("corpus_id", F.when(valid, short_digest(text)))


def eligible_events(
    events: DataFrame, start: Column, end: Column, wiki: str | None = DEFAULT_WIKI
) -> DataFrame:
    """Edits of and new pages in the main namespace with a title, inside ``[start, end)``."""
    rows = events.filter(
        (F.col("event_time") >= start)
        & (F.col("event_time") < end)
        & (F.col("namespace") == 0)
        & F.col("event_type").isin(*ELIGIBLE_TYPES)
        & (F.length(F.trim("title")) > 0)
    )
    return rows if wiki is None else rows.filter(F.col("wiki") == wiki)


def rank_pages(
    events: DataFrame,
    start: Column,
    end: Column,
    cap: int,
    wiki: str | None = DEFAULT_WIKI,
    titles: DataFrame | None = None,
) -> DataFrame:
    """Most active pages, of one wiki or (``wiki=None``) of every wiki separately."""
    rows = eligible_events(events, start, end, wiki)
    if titles is not None:
        rows = rows.join(titles.select("title"), ["title"], "left_semi")
    counts = rows.groupBy("wiki", "title").agg(F.count("*").alias("event_count"))
    order = [F.desc("event_count"), F.asc("title")]
    if wiki is not None:
        return counts.orderBy(*order).limit(cap)
    return top_per_group(counts, ["wiki"], order, cap)


def selection_guard(titles: DataFrame, ranked: DataFrame) -> DataFrame:
    """Requested titles without an eligible event; the selection is refused if any."""
    return titles.select("title").distinct().join(
        ranked.select("title").distinct(), "title", "left_anti"
    )


def usable_summaries(
    responses: DataFrame,
    column: str = "response_json",
    wiki: str = DEFAULT_WIKI,
    host: str = PAGE_HOST,
) -> DataFrame:
    """Page responses -> documents; ``reject_reason`` is NULL for usable ones.

    The response is read as a variant, because the JSON type of a field decides (a page id that
    is text or a flag is not a page id).
    """
    kind = lambda path: F.expr(
        f"schema_of_variant(try_variant_get(_v, '$.{path}', 'variant'))"
    )
    text_of = lambda path: F.expr(f"try_variant_get(_v, '$.{path}', 'string')")
    parsed = once(responses, "_v", F.try_parse_json(column))
    fields = parsed.withColumns(
        {
            "_type": text_of("type"),
            "canonical_title": F.when(kind("title") == "STRING", text_of("title")),
            "page_id": F.when(
                kind("pageid") == "BIGINT", F.expr("try_variant_get(_v, '$.pageid', 'bigint')")
            ),
            "extract": F.when(kind("extract") == "STRING", strip(text_of("extract"))),
            "source_url": F.coalesce(text_of("content_urls.desktop.page"), F.lit("")),
            "_said": F.coalesce(kind("description"), F.lit("ABSENT")),
            "description": F.coalesce(text_of("description"), F.lit("")),
            "revision": F.coalesce(text_of("revision"), F.lit("")),
        }
    )
    url = F.col("source_url")
    part = lambda name: F.try_parse_url(url, F.lit(name))
    good_url = (
        (F.lower(part("PROTOCOL")) == "https")
        & (F.lower(part("HOST")) == host)
        & part("PATH").startswith(PAGE_PATH)
    )
    positive = F.coalesce(F.col("page_id") > 0, F.lit(False))
    reason = (
        F.when(~F.col("_type").eqNullSafe(F.lit(PAGE_TYPE)), "page type")
        .when(F.coalesce(F.length(strip(F.col("canonical_title"))), F.lit(0)) == 0, "title")
        .when(~positive, "page id")
        .when(F.coalesce(F.length("extract"), F.lit(0)) == 0, "extract")
        .when(~F.coalesce(good_url, F.lit(False)), "source url")
        .when(~F.col("_said").isin("STRING", "ABSENT"), "description")
    )
    text = F.concat_ws("\n", "canonical_title", "description", "extract")
    return (
        fields.withColumns(
            {
                "reject_reason": reason,
                "wiki": F.lit(wiki),
                "document_id": F.concat_ws(":", F.lit(wiki), F.col("page_id").cast("string")),
                "document_type": F.lit(SUMMARY_TYPE),
                "text": text,
            }
        )
        .withColumn("content_hash", digest(F.col("text")))
        .drop("_v", "_type", "_said")
    )


def cache_lookup(titles: DataFrame, aliases: DataFrame, content: DataFrame) -> DataFrame:
    """Cached document per requested title. Many aliases may lead to one document."""
    known = titles.select("wiki", "title").distinct().join(
        aliases.select("wiki", "title", "document_id"), ["wiki", "title"]
    )
    return known.join(content.drop("wiki"), "document_id")


def cache_policy(
    pages: DataFrame, now: Column, ttl_hours: float, refresh: str = "expired"
) -> DataFrame:
    """``plan``: ``reuse`` the cached copy or ``fetch``. Uncached pages have no ``fetched_at``."""
    if refresh not in REFRESH or ttl_hours <= 0:
        raise ValueError("Unknown refresh policy or TTL that is not positive")
    age = F.unix_micros(now) - F.unix_micros("fetched_at")
    fresh = {
        "missing": F.col("fetched_at").isNotNull(),
        "expired": F.coalesce(age < int(ttl_hours * 3_600_000_000), F.lit(False)),
        "force": F.lit(False),
    }[refresh]
    return pages.withColumn("plan", F.when(fresh, "reuse").otherwise("fetch"))


def select_documents(
    ranked: DataFrame, lookups: DataFrame, limit: int, budget: int
) -> DataFrame:
    """Walk each wiki's ranked pages until ``limit`` distinct documents are found.

    ``ranked``: ``wiki, title, rank`` (at most the cap of ``rank_pages`` rows per wiki, so the
    windows are bounded). ``lookups``: ``wiki, title, document_id, cached``, one row per page; a
    NULL document is unusable. Each page that is not cached costs one attempt of ``budget``, which
    is at least ``limit``.
    """
    if budget < limit:
        raise ValueError("The budget must allow as many attempts as documents are wanted")
    found = ranked.join(lookups, ["wiki", "title"], "left")
    walk = Window.partitionBy("wiki").orderBy("rank")
    same = Window.partitionBy("wiki", "document_id").orderBy("rank")
    usable = F.col("document_id").isNotNull()
    # A page past the budget is never fetched, so its document does not count as seen; every
    # page after it is cut as well, which keeps both running counts correct up to the cut.
    steps = found.withColumns(
        {
            "_new": F.when(usable & (F.row_number().over(same) == 1), 1).otherwise(0),
            "_cost": F.when(F.coalesce("cached", F.lit(False)), 0).otherwise(1),
        }
    ).withColumns({"_docs": F.sum("_new").over(walk), "_spent": F.sum("_cost").over(walk)})
    before = F.col("_docs") - F.col("_new") < limit
    first_over = (F.col("_spent") == budget + 1) & (F.col("_cost") == 1)
    status = (
        F.when(F.col("_spent") > budget, "budget_exhausted")
        .when(~usable, "unusable")
        .when(F.col("_new") == 1, "usable")
        .otherwise("duplicate_redirect")
    )
    kept = steps.filter(before & ((F.col("_spent") <= budget) | first_over))
    return kept.withColumn("status", status).drop("_new", "_cost", "_docs", "_spent")


def selection_report(selected: DataFrame, limit: int) -> DataFrame:
    """Per wiki: pages walked, documents found, and whether the corpus may be published."""
    return (
        selected.groupBy("wiki")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("status") == "usable").alias("documents"),
        )
        .withColumn("complete", F.col("documents") == limit)
    )
