"""Nearest neighbours by largest inner product, from a forest of random-projection trees.

Vectors get one more component that brings them to a common length, so the largest inner product is
the smallest angle. Trees split at sample medians of random projections. A query keeps all trees in one
priority queue: a node's price is minus the logarithm of the chance that a neighbour at the usual
cosine lies below it, given the query's own projections, so the likeliest leaf of any tree comes next.
The rows of the leaves taken are scored exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.joins import top_per_group
from siltbed.llm.common import matrix, sorted_groups, usable, work_table

TREES, SAMPLE, LEAF, TRIALS = 16, 8192, 32, 256
ROWS, QUERIES = 4096, 1024  # rows and queries of a group


def log_normal(z: np.ndarray) -> np.ndarray:
    """Logarithm of the normal distribution function, to a few digits, also far in the tail."""
    z = np.clip(z, -30.0, 30.0)
    tail = np.abs(z)
    # Upper tail: density over a continued fraction's first terms; good to one percent everywhere.
    upper = -tail * tail / 2 - np.log(math.sqrt(2 * math.pi)) - np.log((tail + np.sqrt(tail * tail + 8 / math.pi)) / 2)
    return np.where(z < 0, upper, np.log1p(-np.minimum(np.exp(upper), 0.5)))


class Forest:
    """Trees over vectors of at most ``width`` components, all of ``depth`` levels."""

    def __init__(self, sample: list[np.ndarray], longest: float, trees: int = TREES, leaf: int = LEAF, seed: int = 3):
        self.width = max([len(v) for v in sample], default=0)
        self.longest = longest
        self.depth = max(1, math.ceil(math.log2(max(len(sample), 2) / leaf)))
        self.leaves = 2**self.depth
        rng = np.random.default_rng(seed)
        x = self.lifted([np.asarray(v, np.float64) for v in sample])
        nodes = self.leaves - 1
        self.normals = np.zeros((trees, nodes, self.width + 1), np.float32)
        self.cuts = np.zeros((trees, nodes), np.float32)
        for tree in range(trees):
            at = np.zeros(len(x), np.int64)
            for node in range(nodes):
                own = np.flatnonzero(at == node)
                normal = rng.normal(size=self.width + 1)
                if len(own) > 1:
                    one, two = x[rng.choice(own, 2, replace=False)]
                    if np.linalg.norm(one - two) > 1e-6:
                        normal = one - two
                normal = (normal / np.linalg.norm(normal)).astype(np.float32)
                self.normals[tree, node] = normal
                if len(own):
                    side = x[own] @ normal
                    self.cuts[tree, node] = np.median(side)
                    at[own] = 2 * node + 1 + (side.astype(np.float32) > self.cuts[tree, node])
        self.cosine, self.budget = 0.5, 1.0

    def lifted(self, rows: list[np.ndarray], query: bool = False) -> np.ndarray:
        """Unit vectors with the further component; longer rows count by their first components."""
        x = np.zeros((len(rows), self.width + 1))
        for out, row in zip(x, rows, strict=True):
            common = min(len(row), self.width)
            out[:common] = row[:common]
        if query:
            size = np.abs(x).max(axis=1, initial=0, keepdims=True)
            x /= np.where(size > 0, size, 1.0)
            size = np.linalg.norm(x, axis=1, keepdims=True)
            return x / np.where(size > 0, size, 1.0)
        x /= self.longest or 1.0
        x[:, -1] = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
        return x

    def listed(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        out = np.zeros((len(x), len(self.normals)), np.int32)
        for tree, (normals, cuts) in enumerate(zip(self.normals, self.cuts, strict=True)):
            side = (x @ normals.T).astype(np.float32) > cuts
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + side[np.arange(len(x)), at]
            out[:, tree] = at - (self.leaves - 1)
        return out

    def prices(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What it costs a neighbour of each query to go left or right at every node."""
        flat = self.normals.reshape(-1, self.width + 1)
        mean = (q @ flat.T).reshape(len(q), *self.cuts.shape) * self.cosine
        spread = max(math.sqrt(max(0.0, 1 - self.cosine**2)), 0.05) / math.sqrt(self.width + 1)
        z = (mean - self.cuts) / spread
        return -log_normal(-z), -log_normal(z)

    def order(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        """Leaves of all trees from one queue, the cheapest first: (tree, leaf)."""
        heap = [(0.0, tree, 0) for tree in range(len(left))]
        inner = self.leaves - 1
        while heap:
            price, tree, node = heapq.heappop(heap)
            if node >= inner:
                yield tree, node - inner
                continue
            heapq.heappush(heap, (price + left[tree, node], tree, 2 * node + 1))
            heapq.heappush(heap, (price + right[tree, node], tree, 2 * node + 2))

    def visits(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
        """Codes of the leaves to read: until they hold the budget, and one tree alone more than ``k`` rows."""
        codes, taken, most = [], np.zeros(len(left), np.int64), self.budget * counts[0].sum()
        for tree, leaf in self.order(left, right):
            codes.append(tree * self.leaves + leaf)
            taken[tree] += counts[tree, leaf]
            if taken.sum() >= most and taken.max() > k:
                break
        return codes

    def tune(self, sample: list[np.ndarray], k: int, rows: int, recall: float) -> None:
        """Set the usual cosine and the budget (rows read over rows of the table) that reaches ``recall`` in the sample."""
        n = len(sample)
        if n < 3:
            return
        x = self.lifted(sample)
        near = max(1, math.ceil(k * n / max(rows, n)))  # as many of the sample as correspond to k of all rows
        near = min(near, n - 1)
        trial = np.arange(n)[:: max(1, n // TRIALS)]
        q = self.lifted([sample[i] for i in trial], query=True)
        scores = q @ x.T
        scores[np.arange(len(trial)), trial] = -np.inf
        best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
        self.cosine = float(np.clip(np.median(np.take_along_axis(scores, best, axis=1)), 0.0, 0.999))
        places = self.listed(x)
        counts = np.stack([np.bincount(places[:, t], minlength=self.leaves) for t in range(places.shape[1])])
        needed: list[np.ndarray] = []
        for at in range(0, len(q), 32):
            left, right = self.prices(q[at : at + 32])
            for i in range(len(left)):
                reached = np.zeros(counts.shape)
                total = 0
                for tree, leaf in self.order(left[i], right[i]):
                    total += counts[tree, leaf]
                    reached[tree, leaf] = total
                needed.append(reached[np.arange(len(counts)), places[best[at + i]]].min(axis=1))
        self.budget = float(np.quantile(np.concatenate(needed), recall)) / n


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v, np.float64) for v in column.to_pylist()]


def _list_leaves(forest: Forest) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                leaves = forest.listed(forest.lifted(_vectors(part.column("v"))))
                lists = pa.FixedSizeListArray.from_arrays(leaves.ravel(), leaves.shape[1]).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "leaves"])

    return run


def _choose(forest: Forest, counts: np.ndarray, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                left, right = forest.prices(forest.lifted(_vectors(part.column("v")), query=True))
                codes, marks = [], []
                for one, two in zip(left, right, strict=True):
                    codes.append(forest.visits(one, two, counts, k))
                    bits = np.zeros(counts.size, np.uint8)
                    bits[codes[-1]] = 1
                    marks.append(np.packbits(bits).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("uid", "id", "dim", "v")), pa.array(codes, pa.list_(pa.int32())),
                     pa.array(marks, pa.binary())],
                    ["uid", "id", "dim", "v", "codes", "marks"],
                )

    return run


def _rerank(trees: int, leaves: int, k: int) -> Callable:
    """Exact scores of queries and rows that meet in a leaf and met in no earlier tree; the ``k`` best of each query."""

    def best(queries: pa.Table, rows: pa.Table, tree: int, width: int) -> Iterator[pa.RecordBatch]:
        x, uid = matrix(rows.column("v"), width), rows.column("uid").to_numpy()
        ids = rows.column("id")
        null = ids.is_null().to_numpy()
        key = ids.fill_null(0).to_numpy()
        places = matrix(rows.column("leaves"), trees).astype(np.int64)
        for at in range(0, queries.num_rows, 128):
            part = queries.slice(at, 128)
            q, own = matrix(part.column("v"), width), part.column("uid").to_numpy()
            bits = np.frombuffer(b"".join(part.column("marks").to_pylist()), np.uint8).reshape(len(q), -1)
            marks = np.unpackbits(bits, axis=1)[:, : trees * leaves].reshape(len(q), trees, leaves)
            met = own[:, None] == uid
            for before in range(tree):
                met |= marks[:, before][:, places[:, before]] > 0
            scores = np.where(met, -np.inf, q @ x.T)
            floor = np.partition(scores, -k, axis=1)[:, -k] if len(x) > k else np.full(len(q), -np.inf)
            # Rounding differs inside a product of matrices; what is near the border is scored again, row by row.
            room = 1e-9 * np.abs(q).sum(axis=1) * np.abs(x).max(initial=0)
            one, two = np.nonzero(~met & (scores >= (floor - room)[:, None]))
            value = (q[one] * x[two]).sum(axis=1)
            order = np.lexsort((uid[two], key[two], ~null[two], -value, one))
            one, two, value = one[order], two[order], value[order]
            first = np.searchsorted(one, np.arange(len(q)))
            keep = np.arange(len(one)) - first[one] < k
            one, two, value = one[keep], two[keep], value[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[one]), part.column("id").combine_chunks().take(pa.array(one)),
                 ids.combine_chunks().take(pa.array(two)), pa.array(uid[two]), pa.array(value)],
                ["uid", "query_id", "vec_id", "other", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (code, width, _, _), table in sorted_groups(batches, ["code", "dim", "qpart", "part"]):
            side = table.column("side").to_numpy()
            queries, rows = (table.filter(pa.array(side == s)) for s in (0, 1))
            if queries.num_rows and rows.num_rows:
                yield from best(queries, rows, code // leaves, width)

    return run


def fit_forest(
    vectors: DataFrame, k: int, recall: float = 0.97, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF
) -> Forest:
    """A forest fitted on at most ``sample`` rows (those whose ``v`` hashes lowest), tuned to ``recall`` among them."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    rows, longest = vectors.agg(F.count("*"), F.max(F.least(norm, F.lit(1e300)))).first()
    picked = vectors.select("v").orderBy(F.xxhash64("v")).limit(sample).toArrow().column("v")
    held = _vectors(picked)
    forest = Forest(held, longest or 1.0, trees, leaf)
    forest.tune(held, k, rows, recall)
    return forest


def nearest(
    vectors: DataFrame, asked: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    recall: float = 0.97, sample: int = SAMPLE, trees: int = TREES,
) -> DataFrame:
    """The ``k`` nearest rows found for every row where ``asked`` holds: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Nearness is the inner product in double precision, the largest first, ties by smaller key; a row is
    no neighbour of itself. All rows are indexed and all leaves hold all their rows. The forest is fitted
    on a bounded sample, and so is the number of rows that a query reads: it is what ``recall`` of
    the nearest took inside the sample. A query with ``k`` rows or fewer to find gets all of them.

    Vectors that are NULL, zero or hold NULL or non-finite components take no part. Only vectors with equally
    many components meet. Rows of one key are rows of their own, equal rows too; a NULL key is a candidate
    (first in ties) and a query where ``asked`` holds for it. An empty table has no result. Other columns are
    not read.

    A leaf with many rows is cut into parts of about ``ROWS``, and its queries into parts of about
    ``QUERIES``; a query and a row are scored in the first tree in which they meet, and nowhere else.
    """
    taken = vectors.filter(usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.size(vector).alias("dim"), F.coalesce(asked, F.lit(False)).alias("asked"),
        F.col(vector).alias("v"),
    )
    forest = fit_forest(taken, k, recall, sample, trees)
    kind = dict(taken.dtypes)["v"]
    base = f"uid long, id long, dim int, asked boolean, v {kind}"
    rows = taken.withColumn("uid", F.monotonically_increasing_id()).select("uid", "id", "dim", "asked", "v")
    rows = work_table(rows.mapInArrow(_list_leaves(forest), f"{base}, leaves array<int>"), "forest-leaves")

    # One count per leaf: as many rows as the forest has leaves, whatever the table.
    placed = rows.select("*", F.posexplode("leaves").alias("tree", "leaf"))
    placed = placed.withColumn("code", F.col("tree") * forest.leaves + F.col("leaf")).drop("tree", "leaf")
    sizes = work_table(placed.groupBy("code").agg(F.count("*").alias("n")), "forest-sizes")
    counts = np.zeros(trees * forest.leaves, np.int64)
    for code, n in sizes.collect():
        counts[code] = n
    choose = _choose(forest, counts.reshape(trees, -1), k)
    visits = rows.filter("asked").select("uid", "id", "dim", "v").mapInArrow(
        choose, f"uid long, id long, dim int, v {kind}, codes array<int>, marks binary"
    )
    visits = work_table(visits, "forest-visits").withColumn("code", F.explode("codes")).drop("codes")
    parts = sizes.join(visits.groupBy("code").agg(F.count("*").alias("nq")), "code").select(
        "code", F.ceil(F.col("n") / ROWS).cast("int").alias("parts"), F.ceil(F.col("nq") / QUERIES).cast("int").alias("qparts")
    )
    parts = work_table(parts, "forest-parts")

    def spread(frame: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        return frame.join(parts, "code").withColumns({
            own: F.pmod(F.xxhash64("uid"), F.col(mine)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)),
        }).drop("parts", "qparts")

    left = spread(visits, "qpart", "part", "qparts", "parts").withColumn("side", F.lit(0))
    right = spread(placed.drop("asked"), "part", "qpart", "parts", "qparts").withColumn("side", F.lit(1))
    keys = ["code", "dim", "qpart", "part"]
    both = left.unionByName(right, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys)
    found = both.mapInArrow(
        _rerank(trees, forest.leaves, k), "uid long, query_id long, vec_id long, other long, score double"
    )
    order = [F.desc("score"), F.asc("vec_id"), F.asc("other")]
    return top_per_group(found, ["uid"], order, k).select("query_id", "rank", "vec_id", "score")
