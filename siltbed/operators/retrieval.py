"""Batch retrieval: best chunks for every question of a table, inside the question's corpus.

Every search is exact. Both legs let the chunks of a corpus pass by groups of questions inside tasks: ``postings`` for
words, ``pivots`` for vectors, which skips blocks whose bound stays below the k-th score found. The hybrid fuses whole rankings without
computing them: no chunk below a known depth of both legs can win, so only those above it are looked at,
and only their places in the other leg are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.plans import stored
from siltbed.operators.pivots import VectorIndex, vector_hits, vector_index, vector_ranks, without_vector
from siltbed.operators.postings import PostingIndex, keyword_hits, keyword_ranks, posting_index, question_weights
from siltbed.operators.ranking import DECIMALS, ROUNDING, top_k

__all__ = [
    "posting_index", "retrieve_hybrid", "retrieve_keyword", "retrieve_vector", "running_text", "snapshot_guard",
    "vector_index", "without_vector",
]

# Fixed value: usual constant of reciprocal-rank fusion.
RRF_K = 60


def retrieve_vector(questions: DataFrame, chunks: DataFrame | VectorIndex, k: int = 4) -> DataFrame:
    """Best chunks by cosine similarity.

    Both frames carry ``corpus_id``, ``generation`` and ``embedding``; questions a ``question_id``, chunks
    a ``chunk_id``. Only vectors with equally many components meet; a zero vector has a cosine of 0 with
    everything. Rows whose embedding is NULL, empty or no number have no result; ``without_vector``
    lists them. ``chunks`` may be an index that was built before.
    """
    index = chunks if isinstance(chunks, VectorIndex) else vector_index(chunks)
    return vector_hits(questions, index, k)


def retrieve_keyword(questions: DataFrame, chunks: DataFrame | PostingIndex, k: int = 4) -> DataFrame:
    """Best chunks by BM25 over the words of ``text``; a chunk without any of the words is no hit."""
    index = chunks if isinstance(chunks, PostingIndex) else posting_index(chunks)
    return keyword_hits(questions, index, k)


def _part(rank: Column) -> Column:
    return 1.0 / (RRF_K + rank)


def sure_depth(k: int) -> int:
    """Ranks of both legs below which no chunk can be among the ``k`` best.

    If a leg has ``k`` chunks, these alone score ``1 / (RRF_K + k)`` or more; a chunk below depth ``d`` in
    both legs scores less than ``2 / (RRF_K + d)``. Shorter legs are seen whole.
    """
    return int(2 / (1 / (RRF_K + k) - 2 * ROUNDING)) - RRF_K + 1


def retrieve_hybrid(
    questions: DataFrame, vectors: DataFrame | VectorIndex, texts: DataFrame | PostingIndex, k: int = 4
) -> DataFrame:
    """The ``k`` best chunks by reciprocal-rank fusion of the whole rankings by cosine and by BM25.

    ``questions`` carry ``embedding`` and ``text``; one of them may be NULL. Both legs are read to
    ``sure_depth``. Of the chunks seen in one leg only, those that could still win get their exact place in
    the other by counting what is ahead of them, so every score is that of the whole rankings.
    """
    vectors = vectors if isinstance(vectors, VectorIndex) else vector_index(vectors)
    texts = texts if isinstance(texts, PostingIndex) else posting_index(texts)
    depth = sure_depth(k)
    weights = question_weights(questions, texts)
    keys = ["question_id", "chunk_id"]
    legs = [
        hits.select(*keys, F.col("rank").alias(name))
        for hits, name in ((vector_hits(questions, vectors, depth), "v"), (keyword_hits(questions, texts, depth, weights), "w"))
    ]
    seen = legs[0].join(legs[1], keys, "full")
    least = F.coalesce(_part(F.col("v")), F.lit(0.0)) + F.coalesce(_part(F.col("w")), F.lit(0.0))
    unknown = F.when(F.col("v").isNull() | F.col("w").isNull(), _part(F.lit(depth + 1))).otherwise(0.0)
    seen = stored(seen.withColumn("score", least).withColumn("_most", least + unknown), "hybrid-seen")
    floors = top_k(seen, k).filter(F.col("rank") == k).select("question_id", F.col("score").alias("_floor"))
    open_ = seen.join(floors, "question_id", "left")
    open_ = open_.filter(F.col("_most") + 2 * ROUNDING >= F.coalesce("_floor", F.lit(0.0)))
    open_ = stored(open_.select(*keys, "v", "w"), "hybrid-open")
    found = [
        vector_ranks(questions, vectors, open_.filter("v IS NULL")).withColumnRenamed("rank", "_v"),
        keyword_ranks(questions, texts, open_.filter("w IS NULL"), weights).withColumnRenamed("rank", "_w"),
    ]
    placed = open_.join(found[0], keys, "left").join(found[1], keys, "left")
    parts = [F.coalesce(_part(F.coalesce(n, f"_{n}")), F.lit(0.0)) for n in ("v", "w")]
    return top_k(placed.select(*keys, F.round(parts[0] + parts[1], DECIMALS).alias("score")), k)


def snapshot_guard(hits: DataFrame, corpus_id: str, generation: str) -> DataFrame:
    """Hits of the wanted corpus version that have a text and a source."""
    return hits.filter(
        (F.col("corpus_id") == corpus_id)
        & (F.col("generation") == generation)
        & (F.length("text") > 0)
        & (F.length("source_url") > 0)
    )


def running_text(order: list[str], limit: int, total: int) -> tuple:
    """Text cut to ``limit`` and to what earlier rows of the question left of ``total``."""
    before = (
        Window.partitionBy("question_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    own = F.least(F.length("text"), F.lit(limit))
    used = F.coalesce(F.sum(own).over(before), F.lit(0))
    return F.greatest(F.least(own, total - used), F.lit(0)), before
