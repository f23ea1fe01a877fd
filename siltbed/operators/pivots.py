"""Vector search over blocks around pivots, exact by the triangle inequality of angles.

Every chunk belongs to the pivot nearest to it and stands at a known angle from it. Chunks of one corpus,
pivot and slice of angles form blocks of bounded size, stored as one row each. The angle between a
question and the pivot then bounds the cosine of everything in the block. Bounds are taken inside the tasks, where a group
of questions meets the blocks of a slice: blocks whose bound is below what a question holds already are not scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.plans import stored
from siltbed.operators.ranking import (
    CORPUS, DECIMALS, ROUNDING, Leaders, Places, dealt, each_task, ranks_from_places, top_k, wanted_lists,
)

PIVOTS, SAMPLE = 16, 4096  # pivots, and the chunks they are chosen from
BLOCK, QUESTIONS = 1024, 8192  # chunks of a block, and questions that a task holds
GROUP_BYTES = 16_000_000  # of their vectors, where these are wide
TILE, ROWS = 1024, 2048  # chunks and questions scored at a time
SLICE = np.pi / 64
SLACK = 2e-7  # radians: more than rounding a cosine near one can cost an angle
NOWHERE = -1  # the cell of vectors without a direction, or of another width than the pivots


@dataclass(frozen=True)
class VectorIndex:
    """``blocks`` (one row each: corpus, ``dim``, ``cell``, ``low``, ``high``, ``ids``, ``vectors``), ``rows`` and the pivots."""

    blocks: DataFrame
    rows: DataFrame
    pivots: np.ndarray


def _usable(rows: DataFrame) -> DataFrame:
    number = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter((F.size("embedding") > 0) & finite)


def without_vector(rows: DataFrame) -> DataFrame:
    """Rows that vector search has to leave out: no vector, an empty one, or one with a component that is no number."""
    number = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(number, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.filter(F.coalesce((F.size("embedding") <= 0) | odd, F.lit(True)))


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return _units(flat.reshape(-1, width))


def choose_pivots(sample: list, count: int = PIVOTS) -> np.ndarray:
    """Directions of the sample far from each other: each next pivot is the vector farthest from those before."""
    widths = [len(v) for v in sample]
    if not widths:
        return np.zeros((0, 0))
    width = max(set(widths), key=widths.count)
    x = _units(np.array([v for v in sample if len(v) == width], np.float64))
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return np.zeros((0, width))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def _angles(pivots: np.ndarray) -> Callable:
    """Add the angle of each vector to every pivot; NULL where it has no direction or another width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            widths = np.asarray(column.value_lengths())
            out: list = [None] * batch.num_rows
            own = np.flatnonzero(widths == pivots.shape[1]) if len(pivots) else np.zeros(0, int)
            if len(own):
                x = _matrix(column.take(pa.array(own)), pivots.shape[1])
                angles = np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))
                for i, row, vector in zip(own, angles, x, strict=True):
                    if vector.any():
                        out[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(pa.float64()))], [*batch.schema.names, "angles"]
            )

    return run


def _with_angles(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_angles(pivots), f"{fields}, angles array<double>")


def vector_index(chunks: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> VectorIndex:
    """Build and store the index of ``chunks`` (``chunk_id``, corpus, ``embedding``).

    Pivots come from the ``SAMPLE`` chunks whose vectors hash lowest; they decide what can be skipped and
    never what is found. A cell with many chunks is split by a hash, so blocks stay bounded.
    """
    rows = _usable(chunks.select("chunk_id", *CORPUS, "embedding"))
    sample = rows.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).toArrow()
    chosen = choose_pivots(sample.column("embedding").to_pylist(), pivots)
    placed = _with_angles(rows, chosen)
    nearest = F.array_min("angles")
    cell = F.coalesce(F.array_position("angles", nearest) - 1, F.lit(NOWHERE)).cast("int")
    placed = placed.select(
        "chunk_id", *CORPUS, "embedding", F.size("embedding").alias("dim"), cell.alias("cell"), nearest.alias("angle"),
        F.coalesce(F.floor(nearest / SLICE), F.lit(0)).cast("int").alias("slice"),
    )
    placed = stored(placed, "placed-vectors")
    keys = [*CORPUS, "dim", "cell", "slice"]
    sizes = placed.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("chunk_id"), F.col("_parts")).cast("int")
    grouped = placed.join(sizes, keys).groupBy(*keys, part.alias("_part")).agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"),
        F.array_sort(F.collect_list(F.struct("chunk_id", "embedding"))).alias("_rows"),
    )
    blocks = grouped.select(
        *CORPUS, "dim", "cell", "low", "high", F.col("_rows.chunk_id").alias("ids"), F.col("_rows.embedding").alias("vectors"),
        F.monotonically_increasing_id().alias("block"),
    )
    return VectorIndex(stored(blocks, "vector-blocks"), placed, chosen)


def _asked(questions: DataFrame, index: VectorIndex) -> DataFrame:
    asked = _usable(questions.select("question_id", *CORPUS, "embedding"))
    return stored(_with_angles(asked, index.pivots).withColumn("dim", F.size("embedding")), "question-vectors")


class _Scorer:
    """A group of questions; ``add`` scores blocks of chunks for those that they may matter to."""

    def __init__(self, asking: pa.Table, kept: Callable) -> None:
        column = {c: asking.column(c).combine_chunks() for c in asking.column_names}
        column = {c: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for c, v in column.items()}
        self.names, self.width = column["question_id"], column["width"][0].as_py()
        self.units = _matrix(column["embedding"], self.width)
        angles = column["angles"]
        some = np.flatnonzero(~np.asarray(angles.is_null()))
        flat = angles.flatten().to_numpy(zero_copy_only=False)
        self.angles = np.full((len(angles), max(1, len(flat) // max(1, len(some)))), np.nan)
        if len(some):
            self.angles[some] = flat.reshape(len(some), -1)
        self.kept = kept(column)

    def add(self, blocks: pa.RecordBatch) -> None:
        ends = np.cumsum(np.asarray(blocks.column("ids").value_lengths()))
        at = 0
        while at < blocks.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TILE, side="right")))
            self._tile(blocks.slice(at, stop - at))
            at = stop

    def _tile(self, blocks: pa.RecordBatch) -> None:
        cell, low, high = (blocks.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "low", "high"))
        own = np.where(cell >= 0, self.angles[:, np.maximum(cell, 0) % self.angles.shape[1]], np.nan)
        apart = np.maximum(np.maximum(own - high, low - own), SLACK) - SLACK
        # No cosine in the block exceeds the bound.
        bound = np.where(np.isnan(own), 1.0, np.cos(apart))
        rows = np.flatnonzero((bound + ROUNDING >= self.kept.floors[:, None]).any(axis=1))
        if len(rows):
            ids, x = blocks.column("ids").flatten(), _matrix(blocks.column("vectors").flatten(), self.width)
            for i in range(0, len(rows), ROWS):
                some = rows[i : i + ROWS]
                self.kept.add(some, np.round(self.units[some] @ x.T, DECIMALS) + 0.0, ids)

    def result(self) -> pa.RecordBatch:
        return self.kept.result(self.names)


def _best(k: int) -> Callable:
    return each_task(lambda asking: _Scorer(asking, lambda column: Leaders(len(column["width"]), k, float("-inf"))))


def _places() -> Callable:
    return each_task(lambda asking: _Scorer(asking, lambda column: Places(column["wanted"])))


def _met(asked: DataFrame, index: VectorIndex) -> DataFrame:
    group = F.greatest(F.least(F.lit(QUESTIONS), F.floor(F.lit(GROUP_BYTES) / (8 * F.col("dim")))), F.lit(1))
    return dealt(asked.withColumn("width", F.col("dim")), index.blocks, [*CORPUS, "dim"], group, F.size("ids"), F.col("block"))


def _kinds(questions: DataFrame, index: VectorIndex) -> tuple[str, str]:
    return dict(questions.dtypes)["question_id"], dict(index.rows.dtypes)["chunk_id"]


def vector_hits(questions: DataFrame, index: VectorIndex, k: int) -> DataFrame:
    """The ``k`` chunks of the question's corpus with the largest cosine."""
    asking, holding = _kinds(questions, index)
    met = _met(_asked(questions, index), index)
    return top_k(met.mapInArrow(_best(k), f"question_id {asking}, chunk_id {holding}, score double"), k)


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
            a, b = (_units(np.array([v], np.float64)) for v in (one, two))
            out.append(float(np.round(a @ b.T, DECIMALS)[0, 0]) + 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("question_id"), batch.column("chunk_id"), pa.array(out, pa.float64())],
            ["question_id", "chunk_id", "score"],
        )


def vector_ranks(questions: DataFrame, index: VectorIndex, wanted: DataFrame) -> DataFrame:
    """Place of the ``wanted`` pairs (``question_id``, ``chunk_id``) in the question's whole ranking.

    Pairs without vectors, or of different corpora, have none. Blocks that cannot hold a chunk ahead of the
    lowest wanted one are not read.
    """
    asked = _asked(questions, index)
    asking, holding = _kinds(questions, index)
    pairs = wanted.select("question_id", "chunk_id").join(
        asked.select("question_id", *CORPUS, "dim", F.col("embedding").alias("one")), "question_id"
    ).join(index.rows.select("chunk_id", *CORPUS, "dim", F.col("embedding").alias("two")), ["chunk_id", *CORPUS, "dim"])
    own = pairs.select("question_id", "chunk_id", "one", "two").mapInArrow(
        _cosines, f"question_id {asking}, chunk_id {holding}, score double"
    )
    lists = stored(wanted_lists(own), "vector-wanted")
    met = _met(asked.join(lists.select("question_id", "wanted"), "question_id"), index)
    return ranks_from_places(met.mapInArrow(_places(), f"question_id {asking}, place int, n long"), lists)
