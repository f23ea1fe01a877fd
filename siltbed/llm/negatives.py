"""Hard-negative mining with angular triangle bounds.

Vectors become integers once. Of every vector only its norm and its angles to a few reference
directions are stored beside it. For an anchor and a row the triangle inequality of angles gives an
interval of their cosine from each reference; the tightest ends, times both norms and widened by more
than the rounding can amount to, bound the integer score. Whole blocks are left out where the bounds
of the block miss every window of the anchors' block, and inside a block only rows whose bounds
overlap a window are scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.llm.common import matrix, sorted_groups, usable, work_table

REFERENCES, SAMPLE = 16, 2048  # reference directions, and the rows they are fitted on
ANCHORS, ROWS, CHUNK = 512, 4096, 32  # anchors and rows of a block; anchors bounded at a time
SLACK = 2e-7  # radians; twice what rounding a cosine near one can cost an angle
LIMIT = 2.0**31  # a larger norm could give scores beyond 64 bits
WINDOWS = "array<struct<positive_id:long,positive_score:long,low:long,high:long>>"


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.floor(values * scale)


def reference_directions(sample: list[np.ndarray], count: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Unit vectors in the middle of groups of the sample; shorter vectors count as padded by zeros."""
    width = max([len(v) for v in sample], default=0) or 1
    x = np.zeros((len(sample), width))
    for row, v in zip(x, sample, strict=True):
        row[: len(v)] = v
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0][:, None]
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(count, width))
    middle[: min(count, len(x))] = x[rng.permutation(len(x))[:count]]
    for _ in range(rounds):
        middle /= np.linalg.norm(middle, axis=1, keepdims=True)
        near = np.argmax(x @ middle.T, axis=1) if len(x) else np.zeros(0, int)
        for k in range(count):
            total = x[near == k].sum(axis=0)
            if np.linalg.norm(total) > 1e-9:
                middle[k] = total
    return middle / np.linalg.norm(middle, axis=1, keepdims=True)


def _of_width(references: np.ndarray, width: int) -> np.ndarray:
    """The references cut or padded to ``width`` components and brought to length one again."""
    out = np.zeros((len(references), width))
    common = min(width, references.shape[1])
    out[:, :common] = references[:, :common]
    norms = np.linalg.norm(out, axis=1)
    if width:
        out[norms < 1e-6] = np.eye(1, width)
        out /= np.linalg.norm(out, axis=1, keepdims=True)
    return out


def _stored(references: np.ndarray, scale: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("dim").to_numpy()
            for width in np.unique(widths).tolist():
                part = batch.filter(pa.array(widths == width))
                y = quantise(matrix(part.column("v"), width), scale)
                with np.errstate(over="ignore", invalid="ignore"):
                    norms = np.sqrt((y * y).sum(axis=1))
                fine = norms < LIMIT
                part, y, norms = part.filter(pa.array(fine)), y[fine], norms[fine]
                safe = np.where(norms > 0, norms, 1.0)
                cosines = np.clip((y / safe[:, None]) @ _of_width(references, width).T, -1.0, 1.0)
                angles = np.arccos(cosines)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("dim"), part.column("anchor"),
                     pa.array([row.tobytes() for row in y.astype("<i4")], pa.binary()), pa.array(norms),
                     pa.FixedSizeListArray.from_arrays(angles.ravel(), len(references)).cast(pa.list_(pa.float64())),
                     pa.array(np.argmin(angles, axis=1).astype(np.int32))],
                    ["id", "label", "dim", "anchor", "y", "norm", "angles", "home"],
                )

    return run


def _dealt(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Add ``part``: rows of the same keys and neighbouring homes, about ``size`` to twice as many.

    A home with more rows is split by a hash, so no part grows with a hot label or direction.
    """
    before = Window.partitionBy(*keys).orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "home").agg(F.count("*").alias("_n"))
    counts = counts.select(
        *keys, "home", F.ceil(F.col("_n") / size).cast("int").alias("_splits"),
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / size).alias("_run"),
    )
    own = F.when(F.col("_splits") > 1, F.concat_ws(":", "home", F.pmod(F.xxhash64("uid"), "_splits"))).otherwise("")
    return rows.join(counts, [*keys, "home"]).withColumn("part", F.xxhash64(*keys, "_run", own)).drop("_splits", "_run")


def _summaries(rows: DataFrame, keys: list[str], tag: str, *more: Column) -> DataFrame:
    """Ranges of norms and angles of every part."""
    def each(best: Callable) -> Column:
        return F.array(*[best(F.col("angles")[i]) for i in range(REFERENCES)])

    return rows.groupBy(*keys, F.col("part").alias(f"{tag}part")).agg(
        each(F.min).alias(f"{tag}min"), each(F.max).alias(f"{tag}max"),
        F.min("norm").alias(f"{tag}small"), F.max("norm").alias(f"{tag}large"), *more,
    )


def _bounded(parts: DataFrame) -> DataFrame:
    """Add ``least`` and ``most``, the bounds of the scores between two parts."""
    each = F.sequence(F.lit(0), F.lit(REFERENCES - 1))
    apart = F.array_max(F.transform(each, lambda r: F.greatest(F.col("xmin")[r] - F.col("amax")[r], F.col("amin")[r] - F.col("xmax")[r])))
    around = F.array_min(F.transform(each, lambda r: F.col("amax")[r] + F.col("xmax")[r]))
    nearest, farthest = F.cos(F.greatest(apart - SLACK, F.lit(0.0))), F.cos(F.least(around + SLACK, F.lit(np.pi)))
    small, large = F.col("asmall") * F.col("xsmall"), F.col("alarge") * F.col("xlarge")
    room = large * 1e-12 + 1e-3
    return parts.withColumn("most", F.when(nearest >= 0, large).otherwise(small) * nearest + room).withColumn(
        "least", F.when(farthest >= 0, small).otherwise(large) * farthest - room
    )


def score_bounds(one: np.ndarray, two: np.ndarray, one_norm: np.ndarray, two_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most of the integer scores of each row of ``one`` with each of ``two``, from their angles."""
    apart = np.zeros((len(one), len(two)))
    around = np.full((len(one), len(two)), np.pi)
    for r in range(one.shape[1]):
        np.maximum(apart, np.abs(one[:, r][:, None] - two[:, r]), out=apart)
        np.minimum(around, one[:, r][:, None] + two[:, r], out=around)
    size = one_norm[:, None] * two_norm
    room = size * 1e-12 + 1e-3
    most = np.floor(size * np.cos(np.maximum(apart - SLACK, 0.0)) + room)
    least = np.ceil(size * np.cos(np.minimum(around + SLACK, np.pi)) - room)
    return least, most


def _scores(a: np.ndarray, x: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products of integer vectors whose norms multiply to at most ``size``."""
    kind = np.float64 if size < 2.0**53 else np.int64
    return (a.astype(kind) @ x.astype(kind).T).astype(np.int64)


def _block(table: pa.Table, width: int) -> dict[str, np.ndarray]:
    y = np.frombuffer(b"".join(table.column("y").to_pylist()), "<i4").reshape(table.num_rows, width)
    out = {n: table.column(n).to_numpy() for n in ("uid", "label", "norm")}
    ids = table.column("id")
    return out | {"y": y, "angles": matrix(table.column("angles"), REFERENCES), "id": np.array(ids.to_pylist(), object)}


def _first(scores: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id (NULL first), then by row."""
    if len(scores) > k:
        floor = np.partition(scores, -k)[-k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    return keep[sorted(range(len(keep)), key=lambda i: (
        -scores[keep[i]], ids[keep[i]] is not None, ids[keep[i]] or 0, uids[keep[i]]))[:k]]


def _search(same: bool, k: int) -> Callable:
    """Best ``k`` rows of every block for each window of its anchors; without windows, for any score above ``floor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (width, _, _), table in sorted_groups(batches, ["dim", "apart", "xpart"]):
            side = table.column("side").to_numpy()
            asked = table.filter(pa.array(side == 0))
            a, x = _block(asked, width), _block(table.filter(pa.array(side == 1)), width)
            windows, floors = asked.column("windows").to_pylist(), asked.column("floor").to_pylist()
            found: list[tuple] = []
            for at in range(0, len(a["uid"]), CHUNK):
                some = slice(at, at + CHUNK)
                fit = (a["label"][some][:, None] == x["label"]) == same
                fit &= a["uid"][some][:, None] != x["uid"]
                least, most = score_bounds(a["angles"][some], x["angles"], a["norm"][some], x["norm"])
                size = float(a["norm"][some].max(initial=0) * x["norm"].max(initial=0))
                if same:
                    low = np.array([-np.inf if f is None else f for f in floors[some]])
                    # The rows with the highest lower bounds prove a floor before anything is scored.
                    if len(x["uid"]) > k:
                        proven = np.partition(np.where(fit, least, -np.inf), -k, axis=1)[:, -k]
                        low = np.maximum(low, proven)
                    fit &= most >= low[:, None]
                else:
                    low = np.array([min(w["low"] for w in ws) for ws in windows[some]], float)
                    high = np.array([max(w["high"] for w in ws) for ws in windows[some]], float)
                    fit &= (most >= low[:, None]) & (least <= high[:, None])
                columns = np.flatnonzero(fit.any(axis=0))
                scores = _scores(a["y"][some], x["y"][columns], size)
                for i in range(len(scores)):
                    place = np.flatnonzero(fit[i, columns])
                    own, rows = scores[i, place], columns[place]
                    if same:
                        spans = [(None, None, np.arange(len(own)))]
                    else:
                        spans = [
                            (w["positive_id"], w["positive_score"], np.flatnonzero((own >= w["low"]) & (own <= w["high"])))
                            for w in windows[at + i]
                        ]
                    for turn, (positive, score, inside) in enumerate(spans):
                        best = inside[_first(own[inside], x["id"][rows[inside]], x["uid"][rows[inside]], k)]
                        for j in best:
                            found.append((int(a["uid"][at + i]), turn, a["id"][at + i], positive, score,
                                          x["id"][rows[j]], int(x["uid"][rows[j]]), int(own[j])))
            fields = zip(*found, strict=True) if found else ((),) * 8
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array(f, t) for f, t in zip(fields, kinds, strict=True)], FOUND)

    return run


FOUND = ["uid", "turn", "anchor_id", "positive_id", "positive_score", "other_id", "other_uid", "score"]
FOUND_TYPES = "uid long, turn int, anchor_id long, positive_id long, positive_score long, other_id long, other_uid long, score long"


def _visit(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, same: bool, k: int) -> DataFrame:
    """Anchors meet the rows of the paired parts; each pair of parts is one bounded group."""
    kept = ["dim", "uid", "id", "label", "norm", "angles", "y"]
    left = anchors.select(*kept, "windows", "floor", F.col("part").alias("apart")).join(pairs, ["dim", "apart"])
    right = rows.select(*kept, F.col("part").alias("xpart")).join(pairs, ["dim", "xpart"])
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)), allowMissingColumns=True)
    keys = ["dim", "apart", "xpart"]
    return both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search(same, k), FOUND_TYPES)


def hard_negatives(
    vectors: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, scores.

    A score is the inner product of the integer vectors ``floor(scale * component)``. The positives of
    an anchor (rows where the condition ``anchor`` holds) are its first ``positives`` other rows of its
    label, the negatives of both the first ``negatives`` rows of other labels whose score lies between
    ``low`` and ``high`` hundredths of the positive's. Higher scores come first, ties by smaller key.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part; nor do rows
    whose integer vector is ``2**31`` long or more, as scores would not fit 64 bits. Zero vectors do
    take part (their scores are 0), and an empty vector is one of no components. Only vectors with
    equally many components meet. Rows of one key, equal rows too, are rows of their own; a NULL key
    comes first in ties. An empty table, or one without anchors, has no result. Other columns are not
    read, whatever their names.

    The result is exact. The references come from the ``SAMPLE`` rows whose vectors hash lowest; they
    decide what can be left out, not what is found.
    """
    kind = dict(vectors.dtypes)[label]
    name = F.col(label).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label)
    taken = vectors.filter(F.col(label).isNotNull() & usable(F.col(vector), zero=True)).select(
        F.col(key).cast("long").alias("id"), name.alias("label"), F.size(vector).alias("dim"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("v"),
    )
    sample = taken.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toArrow().column("v").to_pylist()
    references = reference_directions([quantise(np.asarray(v, np.float64), scale) for v in sample])
    stored = taken.mapInArrow(
        _stored(references, scale),
        "id long, label long, dim int, anchor boolean, y binary, norm double, angles array<double>, home int",
    )
    rows = work_table(stored.withColumn("uid", F.monotonically_increasing_id()), "negatives-angles")
    asked = rows.filter("anchor")
    keys = ["dim", "label"]

    def best(*hits: DataFrame) -> DataFrame:
        found = hits[0] if len(hits) == 1 else hits[0].unionByName(hits[1])
        order = [F.desc("score"), F.asc("other_id"), F.asc("other_uid")]
        return top_per_group(found, ["uid"], order, positives, "turn")

    # Positives: first among rows with the anchor's own nearest reference, which proves a floor for the rest.
    no_windows = F.lit(None).cast(WINDOWS)
    seeds = work_table(_dealt(asked, keys, ANCHORS), "negatives-anchors")
    beside = work_table(_dealt(rows, keys, ROWS), "negatives-rows")
    homes = [
        _summaries(r, keys, tag, F.array_sort(F.collect_set("home")).alias(f"{tag}homes"))
        for r, tag in ((seeds, "a"), (beside, "x"))
    ]
    pairs = work_table(_bounded(homes[0].join(homes[1], keys)), "negatives-pairs")
    shared = F.arrays_overlap("ahomes", "xhomes")
    ready = seeds.withColumn("windows", no_windows).withColumn("floor", F.lit(None).cast("double"))
    near = work_table(_visit(ready, beside, pairs.filter(shared).select("dim", "apart", "xpart"), True, positives), "negatives-near")
    floors = best(near).filter(F.col("turn") == positives).select("uid", F.col("score").cast("double").alias("floor"))
    ready = work_table(seeds.join(floors, "uid", "left").withColumn("windows", no_windows), "negatives-floors")
    least = ready.groupBy("dim", F.col("part").alias("apart")).agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("_f"))
    rest = pairs.filter(~shared).join(least, ["dim", "apart"]).filter("most >= _f").select("dim", "apart", "xpart")
    chosen = work_table(best(near, _visit(ready, beside, rest, True, positives)), "negatives-positives")

    # Negatives: windows of scores from the positives, in rows of all labels.
    score = F.col("score").cast("decimal(20,0)")
    window = F.struct(
        F.col("turn"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"),
    )
    windows = chosen.filter("score >= 0").groupBy("uid").agg(F.array_sort(F.collect_list(window)).alias("_w"))
    windows = windows.select("uid", F.transform("_w", lambda w: w.dropFields("turn")).alias("windows"))
    ready = _dealt(asked.join(windows, "uid"), ["dim"], ANCHORS).withColumn("floor", F.lit(None).cast("double"))
    ready = work_table(ready, "negatives-windows")
    dealt = work_table(_dealt(rows, ["dim"], ROWS), "negatives-all")
    spans = [
        F.min(F.array_min(F.col("windows.low"))).alias("_low"), F.max(F.array_max(F.col("windows.high"))).alias("_high"),
    ]
    both = _bounded(_summaries(ready, ["dim"], "a", *spans).join(_summaries(dealt, ["dim"], "x"), "dim"))
    overlap = both.filter("most >= _low AND least <= _high").select("dim", "apart", "xpart")
    hits = _visit(ready, dealt, work_table(overlap, "negatives-overlap"), False, negatives)
    order = [F.desc("score"), F.asc("other_id"), F.asc("other_uid")]
    return top_per_group(hits, ["uid", "turn"], order, negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
