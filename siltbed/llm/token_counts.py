"""Edit-aware token counts: a tree of segment sums per document, patched where an edit touches it.

A document is cut at forced boundaries (see ``bpe``) into segments of some dozens of fragments.
Tokens never cross a forced boundary, so the count of a document is the sum over its segments. The
tree keeps characters and tokens of every subtree: an edit finds its segments by descending the
character sums, only those segments are encoded again, and the sums above them are updated.
If the bytes at an edge of the edited stretch no longer force a boundary, the neighbour is drawn in
as context until they do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltbed.llm.bpe import FragmentCodec, worker_codec
from siltbed.llm.common import raw_bytes, slices

FRAGMENTS_PER_SEGMENT = 48


class TokenTree:
    """Segments of one document with a binary tree of (characters, tokens) above them."""

    def __init__(self, codec: FragmentCodec, segments: list[str], tokens: list[int]) -> None:
        self.codec = codec
        self.encoded = 0  # bytes encoded again since the tree was built
        self._build(segments or [""], tokens or [0])

    def _build(self, segments: list[str], tokens: list[int]) -> None:
        self.segments = segments
        self.size = 1 << (len(segments) - 1).bit_length()
        pad = [0] * (self.size - len(segments))
        self.tokens = [0] * self.size + tokens + pad
        self.chars = [0] * self.size + [len(s) for s in segments] + pad
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def count(self) -> int:
        return self.tokens[1] if self.size > 1 else self.tokens[self.size]

    @property
    def length(self) -> int:
        return self.chars[1] if self.size > 1 else self.chars[self.size]

    def text(self) -> str:
        return "".join(self.segments)

    def _find(self, position: int) -> tuple[int, int]:
        """Segment that holds the character at ``position`` and the place inside it."""
        node = 1
        while node < self.size:
            node *= 2
            if position >= self.chars[node] and self.chars[node + 1]:
                position -= self.chars[node]
                node += 1
        return min(node - self.size, len(self.segments) - 1), position

    def _set(self, i: int, segment: str, tokens: int) -> None:
        self.segments[i] = segment
        node = i + self.size
        self.tokens[node], self.chars[node] = tokens, len(segment)
        while node > 1:
            node //= 2
            self._sum(node)

    def _forced(self, left: str, right: str) -> bool:
        tail = left[-2:].encode()
        pair = np.frombuffer(tail + right[:1].encode(), np.uint8)
        return bool(self.codec.cuts(pair)[len(tail)])

    def _neighbour(self, i: int, step: int) -> int | None:
        """Next segment with text, skipping segments that earlier edits emptied."""
        i += step
        while 0 <= i < len(self.segments):
            if self.segments[i]:
                return i
            i += step
        return None

    def replace(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start``; both are clipped to the document."""
        start = min(max(start, 0), self.length)
        stop = min(start + max(length, 0), self.length)
        first, a = self._find(start)
        last, b = self._find(stop) if stop > start else (first, a)
        new = self.segments[first][:a] + insert + self.segments[last][b:]
        while (left := self._neighbour(first, -1)) is not None and not (
            new and self._forced(self.segments[left], new)
        ):
            new, first = self.segments[left] + new, left
        while (right := self._neighbour(last, 1)) is not None and not (
            new and self._forced(new, self.segments[right])
        ):
            new, last = new + self.segments[right], right
        self.encoded += len(new.encode())
        segments, tokens = segmented(self.codec, new)
        if len(segments) <= last - first + 1:
            segments += [""] * (last - first + 1 - len(segments))
            tokens += [0] * (last - first + 1 - len(tokens))
            for k, (segment, n) in enumerate(zip(segments, tokens, strict=True)):
                if segment != self.segments[first + k] or n != self.tokens[self.size + first + k]:
                    self._set(first + k, segment, n)
        else:  # more segments than before: their sums are known, only the tree is laid out anew
            own = self.tokens[self.size : self.size + len(self.segments)]
            self._build(
                self.segments[:first] + segments + self.segments[last + 1 :],
                own[:first] + tokens + own[last + 1 :],
            )


def grouped(
    codec: FragmentCodec, data: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[list[str], list[int]]]:
    """Segments and their token counts for every row of a slice."""
    pieces, begins, first = codec.fragments(data, offsets)
    known = codec.learn(pieces)
    sums = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(known[p]) // 4 for p in pieces], out=sums[1:])
    edges, whole = np.append(begins, len(data)), data.tobytes()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        marks = [*range(a, b, FRAGMENTS_PER_SEGMENT), b]
        at, total = edges[marks].tolist(), sums[marks]
        texts = [whole[x:y].decode() for x, y in zip(at[:-1], at[1:], strict=True)]
        yield texts, np.diff(total).tolist()


def segmented(codec: FragmentCodec, text: str) -> tuple[list[str], list[int]]:
    raw = text.encode()
    return next(grouped(codec, np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))


def edited_token_counts(
    rows: DataFrame, vocabulary: str, text: str = "text", edits: str = "edits"
) -> DataFrame:
    """Token counts of every text before and after its edits.

    ``edits`` is an array of structs (start long, length long, insert string), applied in order;
    positions are code points of the text as the edits before it left it, clipped to its ends. NULL
    arrays, edits and fields count as no edit, 0 or an empty string; a NULL text is empty. Returns
    the other columns with ``n_tokens``, ``n_tokens_edited``, ``n_chars_edited``, ``n_segments``
    and ``bytes_reencoded``. No shuffle; other columns of those names are refused.
    """
    new = ["n_tokens", "n_tokens_edited", "n_chars_edited", "n_segments", "bytes_reencoded"]
    others = [c for c in rows.columns if c not in (text, edits)]
    if set(new) & {c.lower() for c in others}:
        raise ValueError(f"The rows already have one of the columns {new}")
    schema = T.StructType([*(rows.schema[c] for c in others), *(T.StructField(c, T.LongType()) for c in new)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(vocabulary)
        for part in slices(batches, text):
            found = []
            lists = part.column(edits).to_pylist()
            for own, built in zip(lists, grouped(codec, *raw_bytes(part.column(text))), strict=True):
                tree = TokenTree(codec, *built)
                before, segments = tree.count, len(built[0])
                for edit in own or []:
                    if edit is not None:
                        tree.replace(edit["start"] or 0, edit["length"] or 0, edit["insert"] or "")
                found.append((before, tree.count, tree.length, segments, tree.encoded))
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), *columns], [*others, *new])

    return rows.mapInArrow(count, schema)
