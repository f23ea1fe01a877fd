"""Keyword search over texts cut into words once, scored document by document.

The index has one row per text: its distinct words and how often each occurs. Words are counted inside the row, so
building it moves nothing. A search counts in how many chunks the words of its questions stand, gives each
question its weighted words, and lets the rows pass by groups of questions: a task multiplies the two sparse tables and
keeps the best chunks, so no row per posting, or per question and chunk, is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.plans import once, stored
from siltbed.functions.text import word_line, words
from siltbed.operators.ranking import (
    CORPUS, DECIMALS, ROUNDING, Leaders, Places, dealt, each_task, ranks_from_places, top_k, wanted_lists,
)

BLOCK = 256  # chunks scored at a time
COUNTED = 256  # chunks whose words are counted at a time
QUESTIONS = 4096  # questions that a task holds
CELLS = 1 << 21  # scores that a task holds at a time
# Usual constants of the BM25 weight.
BM25_K1, BM25_B = 1.2, 0.75


@dataclass(frozen=True)
class PostingIndex:
    """``texts`` (one row each: corpus, ``chunk_id``, ``length``, ``words``, ``tf``), ``totals`` per corpus, and ``block``.

    ``words`` are the distinct words of the text with a blank between them.
    """

    texts: DataFrame
    totals: DataFrame
    block: int


def _split(lines: pa.Array) -> pa.ListArray:
    """Words of each line; none of an empty one."""
    lines = lines.take(pa.array(np.arange(len(lines))))  # split_pattern misreads slices of an array
    return pc.split_pattern(pc.if_else(pc.equal(lines, ""), pa.scalar(None, lines.type), lines), " ")


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of every row and their counts, in place of all its words."""
    for batch in batches:
        for at in range(0, batch.num_rows, COUNTED):
            part = batch.slice(at, COUNTED)
            listed = _split(part.column("words"))
            sizes = _sizes(listed)
            named = listed.flatten().dictionary_encode()
            wide = max(1, len(named.dictionary))
            pairs = np.repeat(np.arange(part.num_rows), sizes) * wide + named.indices.to_numpy()
            pairs, counts = np.unique(pairs, return_counts=True)
            starts = pa.array(np.searchsorted(pairs // wide, np.arange(part.num_rows + 1)).astype(np.int32))
            terms = pa.ListArray.from_arrays(starts, named.dictionary.take(pa.array(pairs % wide)))
            counts = pa.ListArray.from_arrays(starts, pa.array(counts.astype(np.int32)))
            names = [c for c in part.schema.names if c != "words"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), pa.array(sizes), pc.binary_join(terms, " "), counts],
                [*names, "length", "words", "tf"],
            )


def posting_index(chunks: DataFrame, block: int = BLOCK) -> PostingIndex:
    """Build and store the index of ``chunks`` (``chunk_id``, corpus, ``text``; the id is unique in its corpus)."""
    listed = once(chunks.select("chunk_id", *CORPUS, "text"), "words", word_line(F.col("text"))).drop("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in listed.schema if f.name != "words")
    counted = listed.mapInArrow(_counted, f"{fields}, length long, words string, tf array<int>")
    texts = stored(counted, "chunk-words")
    totals = texts.groupBy(*CORPUS).agg(F.count("*").alias("_n"), (F.sum("length") / F.count("*")).alias("_mean"))
    return PostingIndex(texts, stored(totals, "corpus-totals"), block)


def question_weights(questions: DataFrame, index: PostingIndex) -> DataFrame:
    """The words of every question that stand in its corpus, with their weight ``idf``."""
    terms = F.explode(F.array_distinct(words(F.col("text")))).alias("term")
    asked = stored(questions.select("question_id", *CORPUS, terms), "question-terms")
    wanted = asked.select(*CORPUS, "term").distinct()
    found = index.texts.select(*CORPUS, F.explode(F.split("words", " ")).alias("term")).join(wanted, [*CORPUS, "term"], "left_semi")
    spread = found.groupBy(*CORPUS, "term").agg(F.count("*").alias("_df")).join(index.totals, CORPUS)
    idf = F.log1p((F.col("_n") - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    return stored(asked.join(spread.select(*CORPUS, "term", idf.alias("idf")), [*CORPUS, "term"]), "question-weights")


class _Scorer:
    """A group of questions; ``add`` scores chunks for all of them."""

    def __init__(self, asking: pa.Table, block: int, kept: Callable) -> None:
        asking = asking.combine_chunks()
        column = {c: pa.concat_arrays(asking.column(c).chunks) for c in asking.column_names}
        self.names = column["question_id"]
        terms = column["asked"].flatten()
        self.terms = pc.unique(terms).sort()
        place = pc.index_in(terms, value_set=self.terms).to_numpy()
        owner = np.repeat(np.arange(len(self.names)), np.asarray(column["asked"].value_lengths()))
        order = np.lexsort((owner, place))
        self.owner, self.idf = owner[order], column["idf"].flatten().to_numpy()[order]
        self.counts = np.bincount(place, minlength=len(self.terms))
        self.starts = np.cumsum(self.counts) - self.counts
        self.block = max(1, min(block, CELLS // len(self.names)))
        self.rows = np.arange(len(self.names))
        self.kept = kept(column)

    def add(self, chunks: pa.RecordBatch) -> None:
        for at in range(0, chunks.num_rows, self.block):
            self._tile(chunks.slice(at, self.block))

    def _tile(self, chunks: pa.RecordBatch) -> None:
        n, listed = chunks.num_rows, _split(chunks.column("words"))
        row = np.repeat(np.arange(n), _sizes(listed))
        term = pc.fill_null(pc.index_in(listed.flatten(), value_set=self.terms), -1).to_numpy()
        tf = chunks.column("tf").flatten().to_numpy().astype(np.float64)
        known = np.flatnonzero(term >= 0)
        known = known[np.argsort(term[known], kind="stable")]
        row, term, tf = row[known], term[known], tf[known]
        weight = tf * (BM25_K1 + 1) / (tf + chunks.column("damping").to_numpy()[row])
        scores = np.zeros(len(self.rows) * n)
        ends = np.cumsum(self.counts[term])
        at = 0
        while at < len(term):  # a bounded number of products at a time
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, side="right")))
            times = self.counts[term[at:stop]]
            first = np.repeat(self.starts[term[at:stop]] - (np.cumsum(times) - times), times)
            pick = first + np.arange(len(first))
            where = self.owner[pick] * n + np.repeat(row[at:stop], times)
            scores += np.bincount(where, self.idf[pick] * np.repeat(weight[at:stop], times), minlength=len(scores))
            at = stop
        scores = np.round(scores, DECIMALS).reshape(len(self.rows), n)
        self.kept.add(self.rows, scores, chunks.column("chunk_id"))

    def result(self) -> pa.RecordBatch:
        return self.kept.result(self.names)


def _best(block: int, k: int) -> Callable:
    return each_task(lambda asking: _Scorer(asking, block, lambda column: Leaders(len(column["asked"]), k, ROUNDING)))


def _places(block: int) -> Callable:
    return each_task(lambda asking: _Scorer(asking, block, lambda column: Places(column["wanted"])))


def _met(asked: DataFrame, index: PostingIndex, lists: DataFrame | None = None) -> DataFrame:
    weighed = F.array_sort(F.collect_list(F.struct("term", "idf")))
    asking = asked.groupBy("question_id", *CORPUS).agg(weighed.alias("_w"))
    asking = asking.select("question_id", *CORPUS, F.col("_w.term").alias("asked"), F.col("_w.idf").alias("idf"))
    if lists is not None:
        asking = asking.join(lists.select("question_id", "wanted"), "question_id")
    texts = index.texts.filter("length > 0").join(index.totals, CORPUS)
    damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.col("_mean"))
    texts = texts.select("chunk_id", *CORPUS, "words", "tf", damping.alias("damping"))
    return dealt(stored(asking, "question-lists"), texts, CORPUS, F.lit(QUESTIONS), F.lit(1), F.col("chunk_id"))


def _kinds(questions: DataFrame, index: PostingIndex) -> tuple[str, str]:
    return dict(questions.dtypes)["question_id"], dict(index.texts.dtypes)["chunk_id"]


def keyword_hits(questions: DataFrame, index: PostingIndex, k: int, weights: DataFrame | None = None) -> DataFrame:
    """The ``k`` chunks with the highest BM25 sum for every question.

    ``weights`` are those of ``question_weights``, where they are there already.
    """
    weights = question_weights(questions, index) if weights is None else weights
    asking, holding = _kinds(questions, index)
    met = _met(weights, index)
    return top_k(met.mapInArrow(_best(index.block, k), f"question_id {asking}, chunk_id {holding}, score double"), k)


def keyword_ranks(
    questions: DataFrame, index: PostingIndex, wanted: DataFrame, weights: DataFrame | None = None
) -> DataFrame:
    """Place of the ``wanted`` pairs (``question_id``, ``chunk_id``) in the question's whole ranking.

    Pairs without a common word have none.
    """
    asking, _ = _kinds(questions, index)
    asked = question_weights(questions, index) if weights is None else weights
    lengths = index.texts.join(index.totals, CORPUS).withColumn(
        "_damping", BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.nullif("_mean", F.lit(0.0)))
    )
    pairs = wanted.select("question_id", "chunk_id").join(asked.select("question_id", *CORPUS).distinct(), "question_id")
    own = pairs.join(lengths, ["chunk_id", *CORPUS]).select(
        "question_id", *CORPUS, "chunk_id", "_damping", F.explode(F.arrays_zip(F.split("words", " ").alias("words"), "tf")).alias("_w")
    ).select("question_id", *CORPUS, "chunk_id", "_damping", F.col("_w.words").alias("term"), F.col("_w.tf").alias("tf"))
    weight = F.col("idf") * (F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + F.col("_damping")))
    own = own.join(asked, ["question_id", *CORPUS, "term"]).groupBy("question_id", "chunk_id").agg(
        F.round(F.sum(weight), DECIMALS).alias("score")
    )
    lists = stored(wanted_lists(own.filter(F.col("score") >= ROUNDING)), "keyword-wanted")
    return ranks_from_places(
        _met(asked, index, lists).mapInArrow(_places(index.block), f"question_id {asking}, place int, n long"), lists
    )
