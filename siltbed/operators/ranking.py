"""Exact top-k and exact ranks of all chunks that a question meets, without a row per pair of them.

Questions and chunks of one corpus are dealt to tasks by group and slice: a task holds one group of questions and
lets the chunks of one slice pass. What leaves it is ``k`` rows or a few counts per question, so shuffles
follow questions and chunks, not their pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.functions.plans import stored

CORPUS = ["corpus_id", "generation"]
DECIMALS = 6
ROUNDING = 10.0**-DECIMALS
SLICE_ROWS = 1024, 1 << 20  # chunks of a slice: at least so many, and at most where that needs more slices than cores
TASK = ["_corpus", "_group", "_slice"]


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """Best ``k`` chunks of every question; ties go to the lower id."""
    return top_per_group(hits, ["question_id"], [F.desc("score"), F.asc("chunk_id")], k)


def dealt(questions: DataFrame, chunks: DataFrame, keys: Sequence[str], group: Column, size: Column, place: Column) -> DataFrame:
    """Rows of both frames, sorted by ``TASK`` and with the questions (``_chunk`` is false) first.

    Every question meets every chunk with equal ``keys`` in exactly one task. ``group`` is how many questions a
    task may hold (of ``keys``), ``size`` how many chunks a row of ``chunks`` has, ``place`` tells its rows apart. A
    chunk is sent once per group and a question once per slice; slices are about as many as cores.
    """
    spark = questions.sparkSession
    cores, parts = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    asking = questions.groupBy(*keys).agg(F.ceil(F.count("*") / F.first(group)).cast("int").alias("_groups"))
    n = F.sum(size)
    slices = F.least(F.ceil(n / SLICE_ROWS[0]), F.greatest(F.lit(cores), F.ceil(n / SLICE_ROWS[1])))
    holding = chunks.groupBy(*keys).agg(F.greatest(slices, F.lit(1)).cast("int").alias("_slices"))
    met = stored(asking.join(holding, [*keys]).withColumn("_corpus", F.monotonically_increasing_id()), "question-tasks")
    every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("_groups", "_slices")]
    one = questions.join(met, [*keys]).withColumn("_group", F.pmod(F.xxhash64("question_id"), "_groups").cast("int"))
    two = chunks.join(met, [*keys]).withColumn("_slice", F.pmod(F.xxhash64(place), "_slices").cast("int"))
    rows = one.withColumn("_slice", every[1]).withColumn("_chunk", F.lit(False)).unionByName(
        two.withColumn("_group", every[0]).withColumn("_chunk", F.lit(True)), allowMissingColumns=True
    )
    # Slices of one corpus stand in neighbouring partitions, so they do not share one by chance.
    task = F.pmod(F.xxhash64("_corpus") + F.col("_group") * F.col("_slices") + F.col("_slice"), F.lit(parts)).cast("int")
    return rows.repartitionById(parts, task).sortWithinPartitions(*TASK, "_chunk").drop(*keys, "_groups", "_slices")


def each_task(start: Callable) -> Callable:
    """A function for ``mapInArrow`` over ``dealt`` rows.

    ``start`` takes a table of questions and returns an object with ``add`` for batches of chunks and ``result``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, asking, state = None, [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in [*TASK, "_chunk"]]
            new = np.zeros(batch.num_rows, bool)
            new[:1] = True
            for column in keys:
                new[1:] |= column[1:] != column[:-1]
            cuts = np.flatnonzero(new).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                key = tuple(int(c[a]) for c in keys[:-1])
                if key != last:
                    if state is not None:
                        yield state.result()
                    last, asking, state = key, [], None
                if not keys[-1][a]:
                    asking.append(batch.slice(a, b - a))
                elif asking:
                    state = state or start(pa.Table.from_batches(asking).combine_chunks())
                    state.add(batch.slice(a, b - a))
        if state is not None:
            yield state.result()

    return run


class Leaders:
    """The ``k`` best chunks of each of ``n`` questions so far, scores of ``least`` or more; ties go to the lower id."""

    def __init__(self, n: int, k: int, least: float) -> None:
        self.k, self.most = k, 2 * n * k + 65536
        self.floors, self.full = np.full(n, least), np.zeros(n, bool)
        self.held: list[tuple] = []
        self.count, self.kind = 0, None

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        """Scores of the questions numbered ``rows`` with all chunks ``ids``."""
        self.kind = ids.type
        fresh = np.flatnonzero(~self.full[rows])
        if len(fresh) and scores.shape[1] >= self.k:
            some = scores[fresh]
            kth = np.partition(some, some.shape[1] - self.k, axis=1)[:, -self.k]
            self.floors[rows[fresh]] = np.maximum(self.floors[rows[fresh]], kth)
        i, j = np.nonzero(scores >= self.floors[rows][:, None])
        if len(i):
            self.held.append((rows[i], scores[i, j], ids.take(pa.array(j))))
            self.count += len(i)
            if self.count > self.most:
                self.cut()

    def cut(self) -> None:
        owner, score = (np.concatenate([h[c] for h in self.held]) for c in (0, 1))
        ids = pa.concat_arrays([h[2] for h in self.held])
        order = np.lexsort((pc.rank(ids, null_placement="at_start", tiebreaker="dense").to_numpy(), -score, owner))
        owner, score = owner[order], score[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
        self.full[owner[place == self.k - 1]] = True
        self.floors[owner[place == self.k - 1]] = score[place == self.k - 1]
        kept = place < self.k
        self.held = [(owner[kept], score[kept], ids.take(pa.array(order[kept])))]
        self.count = int(kept.sum())

    def result(self, names: pa.Array) -> pa.RecordBatch:
        self.held.append((np.zeros(0, np.int64), np.zeros(0), pa.array([], self.kind)))
        self.cut()
        owner, score, ids = self.held[0]
        return pa.RecordBatch.from_arrays([names.take(pa.array(owner)), ids, pa.array(score)], ["question_id", "chunk_id", "score"])


class Places:
    """How many chunks stand at each place among the ``wanted`` of each question."""

    def __init__(self, wanted: pa.Array) -> None:
        lists = wanted.to_pylist()
        self.down = [-np.array([w["score"] for w in ws]) for ws in lists]
        self.ids = [[w["chunk_id"] for w in ws] for ws in lists]
        self.counts = [np.zeros(len(ws) + 1, np.int64) for ws in lists]
        self.floors = np.array([-d[-1] for d in self.down])

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        for row, own in zip(rows.tolist(), scores, strict=True):
            near = np.flatnonzero(own >= self.floors[row])
            down = self.down[row]
            low = np.searchsorted(down, -own[near], side="left")
            high = np.searchsorted(down, -own[near], side="right")
            for j in np.flatnonzero(high > low):  # equal scores: the lower id is ahead
                name = ids[int(near[j])].as_py()
                low[j] += sum(w <= name for w in self.ids[row][low[j] : high[j]])
            self.counts[row] += np.bincount(low, minlength=len(down) + 1)

    def result(self, names: pa.Array) -> pa.RecordBatch:
        found = [(i, p, int(c[p])) for i, c in enumerate(self.counts) for p in np.flatnonzero(c[:-1]).tolist()]
        owner, place, n = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [names.take(pa.array(owner, pa.int64())), pa.array(place, pa.int32()), pa.array(n, pa.int64())],
            ["question_id", "place", "n"],
        )


def wanted_lists(wanted: DataFrame) -> DataFrame:
    """Per question its ``wanted`` chunks, the best first, and the ``lowest`` of their scores."""
    pair = F.struct((-F.col("score")).alias("_down"), "chunk_id", "score")
    lists = wanted.groupBy("question_id").agg(F.array_sort(F.collect_list(pair)).alias("_w"))
    return lists.select(
        "question_id", F.transform("_w", lambda w: F.struct(w["score"].alias("score"), w["chunk_id"].alias("chunk_id"))).alias("wanted"),
        (-F.element_at("_w", -1)["_down"]).alias("lowest"),
    )


def ranks_from_places(places: DataFrame, lists: DataFrame) -> DataFrame:
    """Ranks of wanted chunks from counts (``n``) of the chunks that stand at each ``place`` among them.

    A chunk at place p comes after the first p wanted ones, so it is ahead of all others.
    """
    counts = places.groupBy("question_id", "place").agg(F.sum("n").alias("n"))
    tables = counts.groupBy("question_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("_at"))
    listed = lists.join(tables, "question_id", "left").select("question_id", "_at", F.posexplode("wanted").alias("_i", "w"))
    ahead = F.aggregate(
        F.sequence(F.lit(0), F.col("_i")), F.lit(0).cast("long"), lambda s, p: s + F.coalesce(F.col("_at")[p], F.lit(0))
    )
    return listed.select("question_id", F.col("w.chunk_id").alias("chunk_id"), (1 + F.coalesce(ahead, F.lit(0))).alias("rank"))
