"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never lie inside a token
of an encoded text, so the text may be cut there: the fragments are encoded on their own and
their ids are put one after the other. Fragments are short and repeat a lot, so each distinct one
is encoded once per task and cached.

The tokenizer first splits a text with a pattern, which looks at its neighbourhood, and a cut must
not change that split. Two rules make sure of it: no cut after white space (a run of blanks is split
by what follows it) and none before an apostrophe (it may begin a contraction).
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltbed.llm.common import SMALL_SLICE, distinct_name, raw_bytes, slices, texts_in_arrow

CACHE_ENTRIES = 120_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class FragmentCodec:
    """Encoder and decoder of one vocabulary file of the tokenizers library; built in each task."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            added = {t["content"] for t in json.load(file)["added_tokens"]}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        table = [b""] * size
        for token, number in vocabulary.items():
            whole = token in added or any(c not in letters for c in token)
            table[number] = token.encode() if whole else bytes(letters[c] for c in token)
        self.lengths = np.fromiter(map(len, table), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.cut_pairs = np.ones(65536, bool)
        inside = np.ones(len(self.flat), bool)
        inside[self.starts[self.lengths > 0]] = False
        at = np.flatnonzero(inside)
        self.cut_pairs[self.flat[at - 1].astype(np.int64) << 8 | self.flat[at]] = False
        self.left = np.zeros(256, bool)
        self.left[33:127] = True  # ASCII without blanks and control bytes
        self.cut_pairs = self.cut_pairs.reshape(256, 256)
        self.cut_pairs[:, 0x80:0xC0] = False  # a continuation byte does not begin a character
        self.cut_pairs[:, ord("'")] = False
        self.cut_pairs = self.cut_pairs.ravel()
        self.cache: dict[bytes, bytes] = {}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """For every byte, whether the text may be cut before it."""
        may = np.zeros(len(data), bool)
        if len(data) > 1:
            before, after = data[:-1], data[1:]
            ok = self.cut_pairs[before.astype(np.uint16) << np.uint16(8) | after]
            left = self.left[before]
            # Two-byte characters from U+00C0 to U+00FF are letters and two signs, never blanks.
            left[1:] |= (before[1:] >= 0x80) & (before[:-1] == 0xC3)
            np.logical_and(ok, left, out=may[1:])
        return may

    def fragments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Fragments of all rows, where each begins, and the number of fragments before each row."""
        may = self.cuts(data)
        may[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins = np.flatnonzero(may)
        ends = np.append(begins[1:], len(data)) if len(begins) else begins
        whole = data.tobytes()
        pieces = list(map(whole.__getitem__, map(slice, begins.tolist(), ends.tolist())))
        return pieces, begins, np.searchsorted(begins, offsets)

    def learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of all given fragments, each as little-endian 32-bit integers."""
        new = set(pieces).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache = {}
            new = set(pieces)
        fresh = list(new)
        found = self.tokenizer.encode_batch_fast([p.decode() for p in fresh], add_special_tokens=False)
        for piece, encoding in zip(fresh, found, strict=True):
            self.cache[piece] = np.asarray(encoding.ids, "<u4").tobytes()
        return self.cache

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        pieces, _, first = self.fragments(data, offsets)
        known = self.learn(pieces)
        ids = [known[p] for p in pieces]
        first = first.tolist()
        return [b"".join(ids[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids as UTF-8; bytes that are none become replacement characters."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or not ends[-1]:
            return b""
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(ends[-1])].tobytes().decode("utf-8", "replace").encode()


def worker_codec(path: str) -> FragmentCodec:
    """One codec per Python worker: Spark reuses workers, so the cache outlives a task."""
    held = sys.modules.setdefault("_siltbed_codecs", types.ModuleType("_siltbed_codecs")).__dict__
    if path not in held:
        held[path] = FragmentCodec(path)
    return held[path]


def bpe_encode(
    rows: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", count: str = "n_tokens",
    decoded: str | None = None,
) -> DataFrame:
    """``rows`` with ``text`` replaced by its ``ids`` (binary, little-endian unsigned 32-bit) and ``count``.

    Equal to the tokenizers library on the whole text without added special tokens. ``vocabulary``
    is the path of its file, which every executor must be able to read. ``decoded`` names a column for
    the text decoded from the ids in the same pass. NULL and empty texts have no ids. No shuffle;
    memory follows a slice of rows, or the longest text. Other columns pass through; new names that
    would clash with them are refused.
    """
    others = [c for c in rows.columns if c != text]
    new = [ids, count, *([decoded] if decoded else [])]
    if {c.lower() for c in new} & {c.lower() for c in others}:
        raise ValueError(f"The rows already have one of the columns {new}")
    schema = T.StructType([rows.schema[c] for c in others])
    schema = schema.add(ids, T.BinaryType()).add(count, T.LongType())
    schema = schema.add(decoded, T.StringType()) if decoded else schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(vocabulary)
        for part in slices(batches, text, SMALL_SLICE):
            found = codec.encode(*raw_bytes(part.column(text)))
            columns = [part.column(c) for c in others]
            columns += [pa.array(found, pa.binary()), pa.array([len(x) // 4 for x in found], pa.int64())]
            if decoded:
                texts = [codec.decode(np.frombuffer(x, "<u4")) for x in found]
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*others, *new])

    return texts_in_arrow(rows, encode, schema)


def bpe_decode(rows: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the ``text`` of ``ids``, special tokens included; NULL ids give an empty text."""
    if distinct_name(rows, text) != text:
        raise ValueError(f"The rows already have a column {text}")
    schema = T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(vocabulary)
        for part in slices(batches, ids, SMALL_SLICE):
            found = [codec.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in part.column(ids)]
            column = pa.array(found, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, text])

    return texts_in_arrow(rows, decode, schema)
