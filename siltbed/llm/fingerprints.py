"""Document fingerprints by consistent weighted sampling.

A text is its words (case kept, cut at blanks) weighted by how often they occur. For each of ``samples``
positions every weighted word draws gamma and uniform variates that depend only on the word and the
position; the word with the smallest draw is the sample, together with the step its weight falls on.
Two texts agree at a position with a probability equal to the generalised Jaccard similarity of their
weights (sum of minima over sum of maxima), so the share of equal positions estimates it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import BASE, GOLDEN, RollingHash, joined, mix, slices, task_count, word_spans

SAMPLES = 64
SLICE_TEXT = 2_000_000
MIB = 1 << 20


def weighted_terms(data: np.ndarray, offsets: np.ndarray, roll: RollingHash):
    """Row, term hash (40 bits) and weight of every distinct word of every row."""
    starts, stops, rows = word_spans(data, offsets)
    words = roll.span(roll.prefix(data), starts, stops) >> np.uint64(24)
    keys, counts = np.unique(rows.astype(np.uint64) << np.uint64(40) | words, return_counts=True)
    return (keys >> np.uint64(40)).astype(np.int64), keys & np.uint64((1 << 40) - 1), counts


def draws(terms: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """For each weighted term and position: the draw in bits 16 to 47, the sample's name in the low 16.

    With gamma variates r and c and a uniform b: t = floor(ln(weight) / r + b), and the draw is
    ln c - r (t - b) - r. Draws are compared as order-preserving integers, so a minimum over the
    packed values carries the name along; ties fall to the smaller name. The five uniforms have 25
    bits each, from two hashes of the term and the position.
    """
    seeds = mix((np.arange(2 * samples, dtype=np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
    one, two = mix(terms[:, None] ^ seeds[:samples]), mix(terms[:, None] ^ seeds[samples:])
    low = np.uint64((1 << 25) - 1)

    def uniform(bits: np.ndarray) -> np.ndarray:
        return ((bits & low).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-25)

    r = -np.log(uniform(one) * uniform(one >> np.uint64(25)))
    log_c = np.log(-np.log(uniform(two) * uniform(two >> np.uint64(25))))
    b = uniform((one >> np.uint64(50)) << np.uint64(11) | two >> np.uint64(53))
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + b)
    draw = log_c - r * (t - b) - r
    bits = draw.view(np.int32)
    ordered = np.where(bits < 0, ~bits, bits ^ np.int32(-(2**31))).view(np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        steps = t.astype(np.int64).view(np.uint64) * np.uint64(BASE)
        name = ((terms[:, None] * np.uint64(GOLDEN)) ^ steps) * np.uint64(GOLDEN) >> np.uint64(48)
    return ordered << np.uint64(16) | name


class DrawTable:
    """Draws of the weighted terms met so far, within a bound; terms recur from slice to slice."""

    def __init__(self, samples: int, limit: int = 120_000) -> None:
        self.samples, self.limit = samples, limit
        self.pairs, self.table = np.zeros(0, np.uint64), np.zeros((0, samples), np.uint64)

    def rows(self, pairs: np.ndarray) -> np.ndarray:
        """Where the draws of ``pairs`` (sorted, distinct) stand in the table."""
        if len(self.pairs) + len(pairs) > self.limit:
            self.pairs, self.table = self.pairs[:0], self.table[:0]
        new = pairs[~np.isin(pairs, self.pairs, assume_unique=True)]
        made = np.empty((len(new), self.samples), np.uint64)
        for at in range(0, len(new), 2048):
            part = new[at : at + 2048]
            made[at : at + 2048] = draws(part >> np.uint64(24), part & np.uint64((1 << 24) - 1), self.samples)
        self.pairs, self.table = np.append(self.pairs, new), np.concatenate([self.table, made])
        order = np.argsort(self.pairs, kind="stable")
        return order[np.searchsorted(self.pairs, pairs, sorter=order)]


def sketch(texts: list[bytes], roll: RollingHash, known: DrawTable) -> np.ndarray:
    """One row of 16-bit names per text; a text without words has names of zero."""
    data, offsets = joined(texts)
    rows, terms, weights = weighted_terms(data, offsets, roll)
    out = np.zeros((len(texts), known.samples), np.uint16)
    if not len(rows):
        return out
    weights = np.minimum(weights, (1 << 24) - 1).astype(np.uint64)  # 16 million times one word
    pairs, place = np.unique(terms << np.uint64(24) | weights, return_inverse=True)
    place = known.rows(pairs)[place]
    present, first = np.unique(rows, return_index=True)
    ends = np.append(first[1:], len(rows))
    lo = 0
    while lo < len(present):  # bounded blocks of rows, so that the gathered draws stay small
        hi = max(lo + 1, int(np.searchsorted(ends, first[lo] + 40_000, side="right")))
        gathered = known.table[place[first[lo] : ends[hi - 1]]]
        best = np.minimum.reduceat(gathered, first[lo:hi] - first[lo], axis=0)
        out[present[lo:hi]] = (best & np.uint64(0xFFFF)).astype(np.uint16)
        lo = hi
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal positions; two texts without words are equal, one without is unlike any other."""
    return float(np.count_nonzero(a == b)) / len(a)


def fingerprints(
    rows: DataFrame, text: str = "text", out: str = "fingerprint", samples: int = SAMPLES
) -> DataFrame:
    """``rows`` with the fingerprint of ``text`` as lowercase hex, four digits per sample.

    Equal texts have equal fingerprints; NULL counts as empty, and a text without words has zeros
    only. No shuffle. Other columns pass through; a column called ``out`` already is refused.
    """
    if out.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"The rows already have a column {out}")
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, known = RollingHash(), DrawTable(samples)
        for part in slices(batches, text, SLICE_TEXT):
            texts = [(x.as_py() or "").encode() for x in part.column(text)]
            names = [s.astype(">u2").tobytes().hex() for s in sketch(texts, roll, known)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string())], [*part.schema.names, out])

    return rows.mapInArrow(add, schema)


def edit_likeness(
    docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprint every text, the text edited with its successor, and compare.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many (or all)
    of the next text in ascending ``key`` order; the last row's next is the first row. Rows with
    equal keys follow the order of their texts, rows equal in both are interchangeable, a NULL key
    comes first and a NULL text is empty. One row per input row; an empty table gives none.

    Texts move once: rows go to ranges of the key, and the first row of each range also goes to
    the range before it. The range bounds are quantiles of the key, as many as there are tasks.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tasks = task_count(slim, 16 * MIB, F.octet_length("t"))
    shares = [i / tasks for i in range(1, tasks)]
    bounds = slim.agg(F.percentile_approx("k", shares, 10 * tasks)).first()[0] if shares else None
    cuts = np.array(sorted(set(bounds or [])), dtype=np.int64)

    def range_of(values: pd.Series) -> pd.Series:
        known = values.fillna(-(2**63)).astype("int64").to_numpy()
        return pd.Series(np.searchsorted(cuts, known, side="right").astype(np.int32))

    bucket = F.pandas_udf(range_of, "int")
    numbered = slim.withColumn("b", bucket("k"))
    lowest = F.min_by("k", F.coalesce("k", F.lit(-(2**63))))
    heads = sorted((r[0], r[1]) for r in numbered.groupBy("b").agg(lowest).collect())
    if not heads:
        return spark.createDataFrame([], _schema(docs, key))
    # The head of a range also goes to the range before it; that of the first range to the last one.
    sends = [(b, k, heads[i - 1][0]) for i, (b, k) in enumerate(heads)]
    kind = docs.schema[key].dataType.simpleString()
    sends = F.broadcast(spark.createDataFrame(sends, f"b int, head {kind}, before int"))  # a row per task
    own = F.struct("b", F.lit(False).alias("tail"))
    extra = F.struct(F.col("before").alias("b"), F.lit(True).alias("tail"))
    sent = numbered.join(sends, "b").withColumn(
        "to", F.explode(F.when(F.col("head").eqNullSafe(F.col("k")), F.array(own, extra)).otherwise(F.array(own)))
    )
    dealt = (
        sent.select("k", "t", "to.*")
        .repartition(tasks, "b")
        .sortWithinPartitions("b", "tail", F.col("k").asc_nulls_first(), "t")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, known = RollingHash(), DrawTable(samples)
        pending: list[tuple[int | None, str, str]] = []
        size, last = 0, None
        for part in slices(batches, "t", SLICE_TEXT):
            columns = (part.column(c).to_pylist() for c in ("k", "t", "b", "tail"))
            for k, t, b, tail in zip(*columns, strict=True):
                if last is not None and last[2] == b:
                    pending.append((last[0], last[1], t))
                    size += len(last[1]) + len(t)
                # Only the first of the tail rows is a successor; none of them is a row of its own.
                last = None if tail else (k, t, b)
                if size >= SLICE_TEXT:
                    yield _compared(pending, roll, known, key)
                    pending, size = [], 0
        if pending:
            yield _compared(pending, roll, known, key)

    return dealt.mapInArrow(compare, _schema(docs, key))


def _schema(docs: DataFrame, key: str) -> str:
    return (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, n_chars long, edited_sha256 string, "
        "fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def _compared(rows: list[tuple], roll: RollingHash, known: DrawTable, key: str) -> pa.RecordBatch:
    import hashlib

    edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for _, t, after in rows]
    texts = [t.encode() for _, t, _ in rows]
    changed = [t.encode() for t in edited]
    both = sketch(texts + changed, roll, known)
    own, new = both[: len(texts)], both[len(texts) :]
    # The next text is the next row's own text unless the run of rows breaks there.
    chained = [i + 1 < len(rows) and rows[i + 1][1] is rows[i][2] for i in range(len(rows))]
    loose = [i for i, c in enumerate(chained) if not c]
    extra = dict(zip(loose, sketch([rows[i][2].encode() for i in loose], roll, known), strict=True))
    following = [own[i + 1] if c else extra[i] for i, c in enumerate(chained)]
    hexed = [[s.astype(">u2").tobytes().hex() for s in names] for names in (own, new)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array(hexed[0]), pa.array(hexed[1]),
            pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)], pa.float64()),
        ],
        [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
