"""Chunks, fingerprints, combined corpora and the corpus manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.plans import once
from siltbed.functions.text import digest, iso_utc, short_digest
from siltbed.operators.merge import merge_plan

CHUNK_CHARS, MIN_CHARS = 1800, 100
PROJECT_TYPE = "project_document"
# The fields that a corpus version stands for.
VERSION_FIELDS = ("chunk_id", "content_hash", "revision", "source_url", "fetched_at")
# Status -> statuses it may follow (None: no row yet).
MANIFEST_FLOW = {
    "PREPARING": (None, "PREPARING", "PREPARED", "FAILED", "SYNCING", "READY", "SYNC_FAILED"),
    "PREPARED": ("PREPARING",),
    "FAILED": ("PREPARING",),
    "SYNCING": ("PREPARED", "READY"),
    "READY": ("PREPARED", "SYNCING", "READY"),
    "SYNC_FAILED": ("SYNCING",),
}


def chunk_fixed(documents: DataFrame, corpus: Column, size: int = CHUNK_CHARS) -> DataFrame:
    """Consecutive windows of ``size`` characters over the whole text.

    One regular-expression pass cuts the text, so a long document is read once, and only its
    pieces travel on.
    """
    if size < MIN_CHARS:
        raise ValueError(f"Chunks have at least {MIN_CHARS} characters")
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    carried = [c for c in documents.columns if c not in ("text", "content_hash", "corpus_id")]
    cut = once(documents, "_pieces", pieces)
    return (
        cut.select(
            *carried, corpus.alias("corpus_id"), F.posexplode("_pieces").alias("chunk_index", "text")
        )
        .withColumn("chunk_id", chunk_id("corpus_id", "document_id", "chunk_index"))
        .withColumn("content_hash", digest(F.col("text")))
    )


def chunk_id(*parts: str) -> Column:
    return digest(F.concat_ws("|", *[F.col(p).cast("string") for p in parts]))


def row_marks(fields: tuple[str, ...]) -> tuple[Column, Column]:
    """Two 60-bit numbers taken from the digest of a row."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f).cast("string"), F.lit("\x00")) for f in fields])
    mark = F.md5(text)
    as_number = lambda start: F.conv(F.substring(mark, start, 15), 16, 10).cast("decimal(20,0)")
    return as_number(1), as_number(16)


def fingerprint(*fields: str) -> Column:
    """Order-independent digest of a set of rows, as an aggregate.

    Sums of row digests merge inside the map tasks; no group of rows is ever collected, so a
    corpus of any size has a version.
    """
    low, high = row_marks(fields)
    parts = [F.count("*"), F.sum(low), F.sum(high)]
    return short_digest(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("0")) for p in parts]))


def generation_state(chunks: DataFrame) -> DataFrame:
    """What a corpus version is computed from: number of rows and sums of their digests, per corpus.

    A few numbers per corpus, to be kept with it; ``update_generation`` moves them on from the change feed.
    """
    low, high = row_marks(VERSION_FIELDS)
    dated = chunks.withColumn("fetched_at", iso_utc(F.col("fetched_at")))
    return dated.groupBy("corpus_id").agg(
        F.count("*").alias("chunk_count"), F.sum(low).alias("low"), F.sum(high).alias("high")
    )


def update_generation(state: DataFrame, changes: DataFrame, sign: Column) -> DataFrame:
    """The state after the changes: rows that came are added, rows that went are subtracted.

    ``sign`` is 1 for a changed row that is there now and -1 for one that no longer is. Only the changes
    are read; the sums are those of all rows. Corpora without rows have no version and disappear.
    """
    low, high = row_marks(VERSION_FIELDS)
    dated = changes.withColumn("fetched_at", iso_utc(F.col("fetched_at")))
    moved = dated.groupBy("corpus_id").agg(
        F.sum(sign).cast("long").alias("chunk_count"), F.sum(low * sign).alias("low"), F.sum(high * sign).alias("high")
    )
    columns = ["chunk_count", "low", "high"]
    both = state.select("corpus_id", *columns).unionByName(moved).groupBy("corpus_id")
    kinds = dict(state.dtypes)
    summed = both.agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in columns])
    return summed.filter("chunk_count <> 0")


def generation_of(state: DataFrame) -> DataFrame:
    """Version of every corpus from its state."""
    parts = [F.col(c).cast("string") for c in ("chunk_count", "low", "high")]
    return state.select("corpus_id", short_digest(F.concat_ws("|", *parts)).alias("generation"), "chunk_count")


def generation(chunks: DataFrame) -> DataFrame:
    """Version of every corpus in the frame."""
    return generation_of(generation_state(chunks))


def with_generation(chunks: DataFrame) -> DataFrame:
    """Chunks labelled with the version of their corpus."""
    versions = generation(chunks).select("corpus_id", "generation")
    # Read once on both sides: from a constant corpus id Catalyst would make a filter and pair all rows.
    rows, versions = (once(f, "corpus_id", F.col("corpus_id")) for f in (chunks.drop("generation"), versions))
    return rows.join(versions, ["corpus_id"])


def base_gate(chunks: DataFrame, manifest: DataFrame, base: str, documents: DataFrame) -> DataFrame:
    """One row: may this corpus be the base of a combined one?

    It must be READY, hold in the manifest's generation as many chunks and documents as promised,
    just the documents of the set ``documents`` (``document_id``), and no project documents.
    Chunks of other generations do not count.
    """
    row = manifest.filter(F.col("corpus_id") == base).select(
        "generation", "status", "chunk_count", "document_count"
    )
    # Read once on both sides: from a constant generation Catalyst would make a filter and pair all rows.
    sides = (chunks.filter(F.col("corpus_id") == base), row.select("generation"))
    rows, wanted = (once(f, "generation", F.col("generation")) for f in sides)
    held = rows.join(wanted, ["generation"], "left_semi")
    counted = held.agg(
        F.count("*").alias("chunks"),
        F.countDistinct("document_id").alias("documents"),
        F.count_if(F.col("document_type") == PROJECT_TYPE).alias("project_chunks"),
    )
    have, want = (rows.select("document_id").distinct() for rows in (held, documents))
    extra, missing = (x.join(y, ["document_id"], "left_anti") for x, y in ((have, want), (want, have)))
    unmatched = extra.union(missing).agg(F.count("*").alias("unmatched_documents"))
    parts = [counted, unmatched, row.drop("generation")]
    names = [c for part in parts for c in part.columns]
    merged = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).agg(
        *[F.max(c).alias(c) for c in names]
    )
    good = (
        (F.col("status") == "READY")
        & (F.col("project_chunks") == 0)
        & (F.col("unmatched_documents") == 0)
        & (F.col("chunks") == F.col("chunk_count"))
        & (F.col("documents") == F.col("document_count"))
    )
    return merged.withColumn("accepted", F.coalesce(good, F.lit(False)))


def keep_load_time(documents: DataFrame, previous: DataFrame) -> DataFrame:
    """A document whose content did not change keeps the time it was first loaded."""
    earlier = previous.select(
        "document_id", "content_hash", F.col("fetched_at").alias("_before")
    ).dropDuplicates(["document_id", "content_hash"])
    return (
        documents.join(earlier, ["document_id", "content_hash"], "left")
        .withColumn("fetched_at", F.coalesce("_before", "fetched_at"))
        .drop("_before")
        .select(documents.columns)
    )


def combined_id(base: str, base_generation: str, documents: DataFrame) -> DataFrame:
    """One row ``corpus_id``: identity of the base version plus this set of documents."""
    return documents.agg(
        short_digest(
            F.concat_ws(
                "|", F.lit(base), F.lit(base_generation), fingerprint("document_id", "content_hash")
            )
        ).alias("corpus_id")
    )


def combine_corpora(
    base_chunks: DataFrame,
    base: str,
    base_generation: str,
    documents: DataFrame,
    document_chunks: DataFrame,
) -> DataFrame:
    """Base chunks re-keyed into a new corpus, together with the document chunks.

    ``document_chunks`` carry ``document_id`` and ``chunk_index``; their ids follow from the new
    corpus id, which is a one-row subquery, not a join.
    """
    new_id = combined_id(base, base_generation, documents).scalar()
    old = base_chunks.filter(
        (F.col("corpus_id") == base) & (F.col("generation") == base_generation)
    ).withColumn("corpus_id", new_id)
    old = old.withColumn("chunk_id", chunk_id("corpus_id", "chunk_id"))
    new = document_chunks.withColumn("corpus_id", new_id).withColumn(
        "chunk_id", chunk_id("corpus_id", "document_id", "chunk_index")
    )
    common = [c for c in old.columns if c in new.columns and c != "generation"]
    return with_generation(old.select(common).unionByName(new.select(common)))


def manifest_faults(manifest: DataFrame, changes: DataFrame) -> DataFrame:
    """Status changes that the flow does not allow."""
    steps = [
        (F.col("status") == status)
        & reduce(
            lambda a, b: a | b,
            [F.col("_was").isNull() if p is None else F.col("_was").eqNullSafe(F.lit(p)) for p in before],
        )
        for status, before in MANIFEST_FLOW.items()
    ]
    was = manifest.select("corpus_id", F.col("status").alias("_was"))
    joined = changes.join(was, "corpus_id", "left")
    allowed = F.coalesce(reduce(lambda a, b: a | b, steps), F.lit(False))  # a NULL status is none
    return joined.filter(~allowed).select(
        "corpus_id", F.col("_was").alias("from_status"), "status"
    )


def manifest_upsert(manifest: DataFrame, changes: DataFrame) -> DataFrame:
    """Merge plan for the allowed changes of the manifest."""
    refused = manifest_faults(manifest, changes).select("corpus_id")
    allowed = changes.join(refused, "corpus_id", "left_anti")
    return merge_plan(manifest, allowed, ["corpus_id"])
