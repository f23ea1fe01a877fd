"""Embedding near-dedup by spherical-cap filters.

Filter directions are a random product code: after a fixed random rotation (signs and Hadamard
transforms) a vector is cut into blocks, each block has a small codebook of random unit vectors, and
every combination of code words is one direction. The directions whose cap holds a vector are listed
by growing combinations block by block and dropping those that can no longer exceed the threshold, so
a million directions cost a few hundred products. Near vectors share a direction almost surely;
vectors that share one are compared exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import matrix, work_table
from siltbed.llm.components import components

BLOCKS, WORDS = 4, 32
THRESHOLD, LEAST = 0.55, 20
GROUP_ROWS = 1500
SMALL, PAIRS = 64, 50_000  # rows of a small group; pairs compared at a time


def rotate(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Two rounds of random signs and a normalised Hadamard transform; the width is a power of two."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    for _ in range(2):
        x = x * rng.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            pairs = x.reshape(n, -1, 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            step *= 2
        x = x / np.sqrt(width)
    return x


def list_decode(x: np.ndarray, threshold: float = THRESHOLD, least: int = LEAST) -> list[np.ndarray]:
    """Directions above ``threshold`` for unit vectors, and always the ``least`` highest, in ascending order."""
    width = max(4 * BLOCKS, 1 << (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    y = rotate(padded).reshape(len(x), BLOCKS, -1)
    rng = np.random.default_rng(11)
    books = rng.normal(size=(BLOCKS, WORDS, width // BLOCKS))
    books /= np.linalg.norm(books, axis=2, keepdims=True)
    scores = np.einsum("nbd,bwd->nbw", y, books) / np.sqrt(BLOCKS)
    order = np.argsort(-scores, axis=2)
    best = np.take_along_axis(scores, order, axis=2)
    found = []
    for own, codes in zip(best, order, strict=True):
        # The least-th highest is at least the least-th highest among the top three words of each block.
        few = own[:, :3]
        sums = (few[0][:, None, None, None] + few[1][:, None, None] + few[2][:, None] + few[3]).ravel()
        floor = min(threshold, float(np.partition(sums, -least)[-least])) - 1e-12
        rest = np.append(np.cumsum(own[::-1, 0])[::-1][1:], 0.0)
        total, code = np.zeros(1), np.zeros(1, np.int64)
        for block in range(BLOCKS):
            total = (total[:, None] + own[block]).ravel()
            code = (code[:, None] * WORDS + codes[block]).ravel()
            keep = total + rest[block] >= floor
            total, code = total[keep], code[keep]
        above = total >= threshold
        if above.sum() < least:
            above = np.argsort(-total, kind="stable")[:least]
        found.append(np.sort(code[above]))
    return found


def usable(vector: Column) -> Column:
    """Not NULL, with components that are all finite and not all zero."""
    number = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(number, lambda v: v != 0), F.lit(False))


def _unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _rows_of(column: pa.ListArray) -> list[np.ndarray]:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    ends = np.cumsum(np.asarray(column.value_lengths()))
    return np.split(flat, ends[:-1])


def _list_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            rows = _rows_of(part.column("v"))
            sizes = np.array([len(r) for r in rows])
            lists: list = [None] * len(rows)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                for i, codes in zip(own, list_decode(_unit(np.stack([rows[j] for j in own]))), strict=True):
                    lists[i] = codes + (int(size) << 32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lists, pa.list_(pa.int64()))], [*part.schema.names, "filters"]
            )


def _first_meeting(filters: list[np.ndarray], here: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the vectors of each pair share no filter below ``here``. Only near pairs are asked for, and they are few."""
    place: dict[int, int] = {}
    bits: dict[int, int] = {}
    for row in np.unique(np.concatenate([one, two])).tolist():
        own = 0
        for code in filters[row].tolist():
            if code >= here:  # filters are in ascending order
                break
            own |= 1 << place.setdefault(code, len(place))
        bits[row] = own
    return np.array([not bits[i] & bits[j] for i, j in zip(one.tolist(), two.tolist(), strict=True)], bool)


def _linked(group: dict, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Ids, link counts and labels of the linked vectors of one group; a pair counts in its first shared filter."""
    x = _unit(np.stack(group["v"]))
    halves = np.array(group["side"])
    one, two = np.flatnonzero(halves != 1), np.flatnonzero(halves != 0)
    product = x[one] @ x[two].T
    near = product >= similarity - 1e-9
    edge = np.flatnonzero(near & (product < similarity + 1e-9))
    if len(edge):  # the last digits of a product depend on the group's shape; these are summed one by one
        p, q = np.unravel_index(edge, near.shape)
        near.flat[edge] = [float(np.sum(x[a] * x[b])) >= similarity for a, b in zip(one[p], two[q], strict=True)]
    i, j = np.nonzero(near)
    i, j = one[i], two[j]
    keep = i < j if (halves == 2).all() else i != j
    i, j = i[keep], j[keep]
    if not len(i):
        return None
    first = _first_meeting(group["filters"], group["filter"], i, j)
    return _tally(np.array(group["id"]), np.array(group["weight"]), i, j, first)


def _tally(
    ids: np.ndarray, weights: np.ndarray, i: np.ndarray, j: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, link counts and labels of the rows in linked pairs; only ``first`` meetings are counted."""
    counts = np.bincount(i[first], weights=weights[j[first]], minlength=len(ids))
    counts += np.bincount(j[first], weights=weights[i[first]], minlength=len(ids))
    labels = ids.copy()
    while True:
        before = labels.copy()
        low = np.minimum(labels[i], labels[j])
        np.minimum.at(labels, i, low)
        np.minimum.at(labels, j, low)
        if (labels == before).all():
            break
    touched = np.unique(np.concatenate([i, j]))
    return ids[touched], counts[touched].astype(np.int64), labels[touched]


def _linked_small(
    rows: pa.Table, sizes: np.ndarray, width: int, similarity: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The same for many small groups at once, one after the other in ``rows``: all pairs within each of them."""
    x = _unit(matrix(rows.column("v"), width))
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(start)) - start
    i = np.repeat(np.arange(len(start)), place)
    j = start[i] + np.arange(len(i)) - np.repeat(np.cumsum(place) - place, place)
    near = np.zeros(len(i), bool)
    for at in range(0, len(i), PAIRS):
        some = slice(at, at + PAIRS)
        near[some] = (x[i[some]] * x[j[some]]).sum(axis=1) >= similarity
    i, j = i[near], j[near]
    if not len(i):
        return None
    touched = np.unique(np.concatenate([i, j]))
    lists = rows.column("filters").take(pa.array(touched)).to_pylist()
    own = dict(zip(touched.tolist(), map(set, lists), strict=True))
    here = rows.column("filter").to_numpy()
    first = [min(own[a] & own[b]) == here[a] for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    ids, weights = (rows.column(c).to_numpy() for c in ("id", "weight"))
    return _tally(ids, weights, i, j, np.array(first, bool))


def _starts(table: pa.Table) -> np.ndarray:
    """Where the rows of a filter and pair of parts begin."""
    keys = [table.column(c).to_numpy() for c in ("filter", "one", "two")]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _groups(similarity: float):
    def told(found: tuple | None) -> Iterator[pa.RecordBatch]:
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["id", "links", "label"])

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        table = table.combine_chunks()
        starts = _starts(table)
        sizes = np.diff(np.append(starts, table.num_rows))
        whole = np.logical_and.reduceat(table.column("side").to_numpy() == 2, starts)
        small = whole & (sizes <= SMALL)
        widths = table.column("filter").to_numpy()[starts] >> 32
        for width in np.unique(widths[small & (sizes > 1)]).tolist():
            own = small & (sizes > 1) & (widths == width)
            rows = table.take(pa.array(np.flatnonzero(np.repeat(own, sizes))))
            yield from told(_linked_small(rows, sizes[own], width, similarity))
        for at in np.flatnonzero(~small & (sizes > 1)).tolist():
            part = table.slice(int(starts[at]), int(sizes[at])).combine_chunks()
            group = {n: part.column(n).to_pylist() for n in ("id", "weight", "side")}
            group["v"] = _rows_of(part.column("v").combine_chunks())
            group["filters"] = [np.asarray(f.values) for f in part.column("filters")]
            yield from told(_linked({**group, "filter": part.column("filter")[0].as_py()}, similarity))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if tail is None else pa.concat_tables([tail, table])
            last = int(_starts(table)[-1])  # this group may go on in the next batch
            yield from done(table.slice(0, last))
            tail = table.slice(last)
        if tail is not None:
            yield from done(tail)

    return compare


def near_vectors(
    vectors: DataFrame, similarity: float = 0.95, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: ``n_links``, ``component_id`` and ``kept`` (it is the smallest of its component).

    Two vectors link when they have equally many components and their cosine is at least
    ``similarity``; links are found where they share a filter, so a few can be missed (recall is
    measured in the tests) and none is wrong. Equal vectors are found always and compared once, as
    one vector with a weight. NULL, zero and non-finite vectors link with nothing. Rows with equal keys
    count as different vectors; a NULL key takes part but is never kept.

    A filter with many vectors is cut into parts of about ``GROUP_ROWS`` and each pair of parts is a
    task's group, so no group is larger than two parts. What leaves a group is one row per vector.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = rows.withColumn("k1", F.when(usable(F.col("v")), F.xxhash64("v"))).withColumn("k2", F.hash("v"))
    equal = rows.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.first("v").alias("v")
    )
    # Classes get names that no two of them share, whatever their keys; written, so that the names stay.
    named = work_table(equal.withColumn("name", F.monotonically_increasing_id()), "cap-classes")
    known = named.select(F.col("name").alias("id"), "weight", "v")
    schema = T.StructType([*known.schema.fields, T.StructField("filters", T.ArrayType(T.LongType()))])
    listed = work_table(known.mapInArrow(_list_filters, schema), "caps")
    parts = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    crowded = work_table(
        listed.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1).select("filter", parts.alias("parts")), "cap-sizes",
    )
    dealt = listed.withColumn("filter", F.explode("filters")).join(crowded, "filter")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other).select(
        "filter", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "id", "weight", "v", "filters",
    )
    dealt = dealt.repartition("filter", "one", "two").sortWithinPartitions("filter", "one", "two", "id")
    found = work_table(dealt.mapInArrow(_groups(similarity), "id long, links long, label long"), "cap-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("label").alias("b")))
    classes = (
        named.select("k1", "k2", "name", F.col("id").alias("least"), "weight")
        .join(links.withColumnRenamed("id", "name"), "name", "left").join(reached, F.col("name") == F.col("node"), "left")
        .select("k1", "k2", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "name").alias("component"))
    )
    classes = work_table(classes, "vector-classes")
    shown = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(shown, "component").select("k1", "k2", "n_links", "component_id", F.lit(True).alias("usable"))
    member = rows.select("id", "k1", "k2").join(classes, ["k1", "k2"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id"))
    return member.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
