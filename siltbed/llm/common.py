"""Shared helpers: work tables, text as byte arrays, rolling hashes, words and shingles.

Python functions that run in tasks see texts as one byte array per slice of rows, so the work on a
slice is a handful of numpy passes and its memory is bounded by ``SLICE_BYTES`` and the longest text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.session import work_dir

SLICE_BYTES = 1_000_000
SMALL_SLICE = 100_000  # for passes with many arrays per byte of text; they are faster, too
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "2m"
BITMAP_BITS = 32_768  # of one bitmap of Spark's bitmap functions
BITMAPS = 1024
BITS_A_KEY = 16
GOLDEN = 0x9E3779B97F4A7C15
BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def work_table(rows: DataFrame, purpose: str) -> DataFrame:
    """Write ``rows`` below the shared work folder and read them back.

    Cuts the lineage (a lost executor recomputes nothing above the table) and gives Catalyst the
    true size, so that it broadcasts the table in a join only if that is below the threshold.
    """
    spark = rows.sparkSession
    path = work_dir(spark, purpose)
    rows.write.mode("errorifexists").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def texts_in_arrow(rows: DataFrame, work: Callable, schema: str | T.StructType) -> DataFrame:
    """``rows.mapInArrow`` for rows with texts, in record batches of about ``BATCH_BYTES``.

    Spark's own bound lets 10,000 texts, or 64 MB, stand in the executor and once more in each Python worker. A
    session that states a bound keeps it; otherwise it is set for the session, as Spark reads it when a plan runs.
    """
    spark = rows.sparkSession
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)
    return rows.mapInArrow(work, schema)


def task_count(rows: DataFrame, bytes_per_task: int, size: Column) -> int:
    """Number of tasks so that each gets about ``bytes_per_task`` of ``size``; one cheap scan."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    spark = rows.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / bytes_per_task))


def marked(rows: DataFrame, place: Column, keys: DataFrame, key_place: Column, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: true where ``place`` is a ``key_place`` of ``keys``, and for some other rows.

    Both are hashes (long). The places of the keys are bits of small bitmaps that every task gets, at most
    ``BITMAPS`` of 4 KB, so what is surely not among the keys can go on without a shuffle. The flag is never
    false for a row of the keys; it is true for about one other row in ``BITS_A_KEY``, and for more
    where the keys outgrow the bitmaps.
    """
    count = min(BITMAPS, max(1, math.ceil(keys.count() * BITS_A_KEY / BITMAP_BITS)))
    names = [distinct_name(rows, n) for n in ("_bit", "_at", "_bitmap")]
    bit, at, bitmap = names
    spread = F.lit(count * BITMAP_BITS)
    # A bitmap's bits come together before it is made: partial bitmaps of many tasks would be large.
    bits = keys.select(F.pmod(key_place, spread).alias(bit)).withColumn(at, F.bitmap_bucket_number(bit)).repartition(at)
    bitmaps = bits.groupBy(at).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias(bitmap))
    found = rows.withColumn(bit, F.pmod(place, spread))
    found = found.withColumn(at, F.bitmap_bucket_number(bit)).withColumn(bit, F.bitmap_bit_position(bit))
    found = found.join(F.broadcast(bitmaps), at, "left")
    byte = F.expr(f"CAST(conv(hex(substring(`{bitmap}`, CAST(`{bit}` DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)")
    test = F.expr(f"shiftleft(1, CAST(`{bit}` % 8 AS INT))")
    hit = F.coalesce(byte.bitwiseAND(test) != 0, F.lit(False))
    return found.withColumn(flag, hit).select(*[F.col(f"`{c}`") for c in rows.columns], flag)


def distinct_name(rows: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that no column of ``rows`` has (in any letter case)."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Texts as byte arrays


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same form for a list of byte strings."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text, and one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


# Vectors and groups


def usable(vector: Column, zero: bool = False) -> Column:
    """Not NULL, with components that are all finite; ``zero`` admits vectors without any other than zero."""
    number = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite if zero else finite & F.exists(number, lambda v: v != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column whose rows all have ``width`` components, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(column), width)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each value of ``keys`` (integers without NULL) as one table, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple = ()
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(int(column[a]) for column in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


# Hashes


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


class RollingHash:
    """Hashes of substrings from prefix sums of byte values times powers, modulo 2**64.

    ``prefix[j] - prefix[i]`` times the inverse power of ``i`` depends only on the bytes in
    ``[i, j)``, not on where they stand.
    """

    def __init__(self, seed: int = 1) -> None:
        with np.errstate(over="ignore"):
            counter = (np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * np.uint64(GOLDEN)
        self.values = mix(counter)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 2 * len(self.powers))
            for name, base in (("powers", BASE), ("inverses", pow(BASE, -1, 2**64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                with np.errstate(over="ignore"):
                    setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._reach(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((prefix[stop] - prefix[start]) * self.inverses[start])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a maximal run of bytes other than space and 9 to 13."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, roll: RollingHash, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle of ``size`` words, ordered by row and hash.

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    data = LOWER[data]
    starts, stops, rows = word_spans(data, offsets)
    if not len(starts):
        return rows, np.zeros(0, np.uint64)
    words = roll.span(roll.prefix(data), starts, stops)
    per_row = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(per_row) - per_row
    place = np.arange(len(words)) - first[rows]
    heads = (place + size <= per_row[rows]) | (place == 0)
    heads = np.flatnonzero(heads)
    length = np.minimum(per_row[rows[heads]], size)
    hashes = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            at = np.minimum(heads + k, len(words) - 1)
            hashes = np.where(k < length, mix(hashes * np.uint64(GOLDEN) + words[at]), hashes)
    owner = rows[heads]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every value, byte planes one after the other (they compress well)."""
    planes = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
    return np.ascontiguousarray(planes.T).tobytes()


def unpack(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 8 - width :] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)
