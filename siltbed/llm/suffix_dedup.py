"""Suffix dedup by difference-cover blockwise construction.

Two suffixes tie for ``LENGTH`` bytes if and only if those bytes occur twice. Positions p with p modulo v
in a difference cover are the sample: for any two positions i and j there is a shift below v that puts
both into the sample. So a long tie of two suffixes always contains a tie of two sample suffixes, and

1. the sample suffixes are ranked first, by their first ``LENGTH - v + 1`` bytes; a sample suffix that
   ties with no other rules out every suffix that needs it,
2. tied sample suffixes are ranked again with their whole surroundings, which settles all suffixes
   around those that tie even so, and leaves one of each class to speak for it,
3. only the suffixes next to the remaining tied samples are ranked by all ``LENGTH`` bytes.

Each ranking cuts the key space into buckets and sorts one bucket at a time, so memory follows a
bucket and never the corpus. Texts stay in blocks in a table bucketed by block: only keys and bits move.
Keys are 64-bit hashes of the bytes; with n keys in a ranking about n * n / 2**65 pairs agree by chance.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import RollingHash, pack, raw_bytes, slices, task_count, unpack, work_table

LENGTH = 200
ORDER = 11  # the cover has ORDER + 1 of ORDER**2 + ORDER + 1 residues
BLOCK_BYTES = 2_000_000
BYTES_PER_BUCKET = 16_000_000


def difference_cover(order: int) -> tuple[int, np.ndarray]:
    """Period and residues of a perfect difference cover, for a prime ``order``.

    The zeros of a linear recurrence of degree three over the field of that order, as lines of
    its projective plane; coefficients are tried until all differences occur.
    """
    period = order * order + order + 1
    for code in range(order**3):
        a, b, c = code % order, code // order % order, code // order**2
        terms = [0, 0, 1]
        while len(terms) < period:
            terms.append((a * terms[-1] + b * terms[-2] + c * terms[-3]) % order)
        zeros = [i for i, t in enumerate(terms) if t == 0]
        if len(zeros) == order + 1 and len({(x - y) % period for x in zeros for y in zeros}) == period:
            return period, np.array(zeros)
    raise ValueError(f"{order} is not a prime")


class Suffixes:
    """The three rankings of one block of texts; replies of earlier rankings narrow the next."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, order: int, roll: RollingHash) -> None:
        self.data, self.offsets, self.length, self.roll = data, offsets, length, roll
        self.period, cover = difference_cover(order)
        self.prefix = roll.prefix(data)
        short = length - self.period + 1
        starts, ends = offsets[:-1], offsets[1:]
        # Sample positions of every text, by period and residue; those too near the end fall away.
        spans = np.maximum(ends - starts - short, -1) // self.period + 1
        row = np.repeat(np.arange(len(starts)), spans)
        base = (np.arange(len(row)) - np.repeat(np.cumsum(spans) - spans, spans)) * self.period
        place = (base[:, None] + cover).ravel()
        row = np.repeat(row, len(cover))
        at = starts[row] + place
        fits = at + short <= ends[row]
        self.sample, self.row = at[fits], row[fits]
        self.keys = [roll.span(self.prefix, self.sample, self.sample + short)]

    def rank(self, reply: np.ndarray) -> np.ndarray:
        """Per key of the last ranking: 0 alone, 1 tied, 3 tied and the first of its class."""
        names, place, count = np.unique(self.keys[-1], return_inverse=True, return_counts=True)
        if not len(reply):
            reply = np.zeros(len(names), np.uint8)
        here = np.where(count > 1, np.maximum(reply, np.where(reply == 0, 3, reply)), reply)
        out = here[place]
        lead = np.zeros(len(out), bool)
        lead[np.unique(place, return_index=True)[1]] = True
        return np.where((out == 3) & ~lead, 1, out)

    def widen(self, reply: np.ndarray) -> None:
        """From the short ranking to surroundings of the tied samples."""
        tied = self.rank(reply) > 0
        self.sample, self.row = self.sample[tied], self.row[tied]
        back, ahead = self.period - 1, self.length
        self.inside = (self.sample - back >= self.offsets[self.row]) & (self.sample + ahead <= self.offsets[self.row + 1])
        at = self.sample[self.inside]
        self.keys.append(self.roll.span(self.prefix, at - back, at + ahead))

    def open_windows(self, reply: np.ndarray) -> None:
        """From the surroundings to the single suffixes that are still open."""
        state = np.zeros(len(self.sample), np.uint8)
        state[self.inside] = self.rank(reply)
        first = np.maximum(self.sample - self.period + 1, self.offsets[self.row])
        last = np.minimum(self.sample, self.offsets[self.row + 1] - self.length)
        self.settled = self._spread(first, last, state > 0)
        self.open = np.flatnonzero(self._spread(first, last, state != 1))
        self.keys.append(self.roll.span(self.prefix, self.open, self.open + self.length))

    def _spread(self, first: np.ndarray, last: np.ndarray, pick: np.ndarray) -> np.ndarray:
        pick = pick & (last >= first)
        steps = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(steps, first[pick], 1)
        np.add.at(steps, last[pick] + 1, -1)
        return np.cumsum(steps[:-1]) > 0

    def removed(self, reply: np.ndarray) -> np.ndarray:
        """Whether each byte lies in a string of ``length`` bytes that starts somewhere else too."""
        repeated = self.settled
        repeated[self.open[self.rank(reply) > 0]] = True
        at = np.flatnonzero(repeated)
        return self._spread(at, at + self.length - 1, np.ones(len(at), bool)) if len(at) else repeated


def _unzip(blob: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)


def _answers(column: pa.Array, i: int) -> np.ndarray:
    """States of a block's keys, in the order of the keys, from the replies of all buckets."""
    replies = column[i].as_py() or []
    parts = [np.frombuffer(r["states"], np.uint8) for r in sorted(replies, key=lambda r: r["bucket"])]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def _narrowed(batch: pa.RecordBatch, i: int, rounds: int, length: int, order: int, roll: RollingHash) -> Suffixes:
    lengths = np.asarray(batch.column("lengths")[i].as_py(), np.int64)
    offsets = np.append(0, np.cumsum(lengths))
    suffixes = Suffixes(_unzip(batch.column("data")[i].as_py()), offsets, length, order, roll)
    for step, move in enumerate((suffixes.widen, suffixes.open_windows)[:rounds]):
        move(_answers(batch.column(f"r{step}"), i))
    return suffixes


def _keys(rounds: int, buckets: int, length: int, order: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()
        wide = np.uint64(2**64 // buckets + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.unique(_narrowed(batch, i, rounds, length, order, roll).keys[-1])
                where = (keys // wide).astype(np.int64)
                names, first = np.unique(where, return_index=True)
                blobs = [pack(k, 8) for k in np.split(keys, first[1:])] if len(names) else []
                block = [batch.column("block")[i].as_py()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(block, pa.int64()), pa.array(blobs, pa.binary())],
                    ["bucket", "block", "keys"],
                )

    return send


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort one bucket at a time; tell every block which of its keys tie with another block's."""

    def sorted_bucket(bucket: int, blocks: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        keys = [unpack(b, 8) for b in blobs]
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        whole = np.concatenate(keys)
        order = np.argsort(whole, kind="stable")  # blocks arrive in order, so the first of a class leads
        ranked = whole[order]
        same = ranked[1:] == ranked[:-1]
        before, after = np.append(False, same), np.append(same, False)
        states = np.zeros(len(whole), np.uint8)
        states[order] = np.where(before, 1, np.where(after, 3, 0))
        cut = np.split(states, np.flatnonzero(np.diff(owner)) + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int32()),
             pa.array([c.tobytes() for c in cut], pa.binary())],
            ["block", "bucket", "states"],
        )

    held: tuple[int, list, list] | None = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("bucket", "block", "keys"))
        for bucket, block, blob in zip(*columns, strict=True):
            if held is not None and held[0] != bucket:
                yield sorted_bucket(*held)
                held = None
            if held is None:
                held = (bucket, [], [])
            held[1].append(block)
            held[2].append(blob)
    if held is not None:
        yield sorted_bucket(*held)


def _blocks(key: str) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, "t", BLOCK_BYTES):
            data, offsets = raw_bytes(part.column("t"))
            ids = part.column("id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)),
                 pa.array([np.diff(offsets)], pa.list_(pa.int64())), pa.array([squeeze(data.tobytes())], pa.binary())],
                ["block", "ids", "lengths", "data"],
            )
            number += 1

    return build


def drop_repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, order: int = ORDER
) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that starts anywhere else too.

    One row per document: ``key``, ``n_bytes``, ``spans`` (array of start and stop, the maximal removed
    runs) and ``kept`` (the remaining bytes, binary). Texts are UTF-8, NULL is empty, strings never
    cross documents and are judged on the input, overlapping ones and those in one document included,
    so all copies go and texts shorter than ``length`` stay. Rows with equal keys are documents of
    their own. ``length`` must be at least ``order**2 + order + 1``.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    tasks = task_count(slim, BYTES_PER_BUCKET, F.octet_length("t"))
    table = f"suffix_blocks_{uuid.uuid4().hex[:12]}"
    built = slim.mapInArrow(_blocks(key), f"block long, ids array<{kind}>, lengths array<long>, data binary")
    built.write.bucketBy(tasks, "block").saveAsTable(table)
    blocks = spark.table(table)
    for rounds in range(3):
        sent = blocks.mapInArrow(_keys(rounds, tasks, length, order), "bucket int, block long, keys binary")
        dealt = sent.repartition(tasks, "bucket").sortWithinPartitions("bucket", "block")
        replies = work_table(dealt.mapInArrow(_sort_buckets, "block long, bucket int, states binary"), "suffix-ranks")
        gathered = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "states")).alias(f"r{rounds}"))
        blocks = blocks.join(gathered, "block", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()
        for batch in batches:
            for i in range(batch.num_rows):
                suffixes = _narrowed(batch, i, 2, length, order, roll)
                gone = suffixes.removed(_answers(batch.column("r2"), i))
                edges, data = suffixes.offsets.tolist(), suffixes.data
                spans, kept = [], []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                    spans.append([{"start": x, "stop": y} for x, y in turns.reshape(-1, 2).tolist()])
                    kept.append(data[a:b][~gone[a:b]].tobytes())
                pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(np.diff(suffixes.offsets)),
                     pa.array(spans, pa.list_(pair)), pa.array(kept, pa.binary())],
                    [key, "n_bytes", "spans", "kept"],
                )

    return blocks.mapInArrow(
        cut, f"`{key}` {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"
    )
