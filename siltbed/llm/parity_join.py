"""N-gram Jaccard join by parity sketches.

A document is its set of word shingles. Sets with a Jaccard similarity of at least 3/4 differ in at
most a seventh of the sum of their sizes. Shingles are hashed into the parts of a sketch and each part
keeps the exclusive or of the hashes in it, so every shingle that only one of two sets has spoils one
part at most, and sets that differ in ``d`` shingles agree in all parts but ``d`` (pigeonhole). Parts are
about twice as few as shingles, hence two near sets agree in more non-empty parts than they differ in,
and joining on equal parts finds every pair. Candidates are verified on the texts.

Sizes are cut into bands at powers of two, a band has one number of parts, and a document so near the
top of its band that a partner may be in the next one is also sketched for that. Of its
non-empty parts a document sends the smallest hashes only, as many as it may differ in plus a slack:
two lists of sets that share enough parts then share at least the slack.

Parts that very many documents have (a passage of boilerplate) are not joined. A document with fewer
such parts than its slack cannot lose a link by that. The others, members of large groups and
documents that are mostly boilerplate, are joined on all their parts in a second stage that needs
no pairs within what is already connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import (
    GOLDEN, SMALL_SLICE, RollingHash, joined, marked, mix, pack, raw_bytes, shingle_sets, slices, task_count, texts_in_arrow,
    unpack, work_table,
)
from siltbed.llm.components import components

SHINGLE = 5
PER_PART = 1.6  # shingles per part at the top of a band
SLACK = 24  # a document sends one part more for so many of its shingles
SMALL = 128  # sets up to this size have a part for each shingle
CROWD = 12  # distinct sets per part that are still joined pair by pair
PARTS, MARKS, LOUD = 0, 1, 2  # kinds of rows between the stages
MANY = 1 << 20  # counts as crowded in every part
BITS = 1024  # of a set's sketch in the second stage
GROUP_ROWS = 1500  # sets of a crowded part that are held against each other at a time
FIRST_PARTS = 8  # of a set's crowded parts that travel with it
BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 6_000_000


def allowed_difference(size: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Most shingles in which a set of ``size`` differs from a near set of at most ``top`` shingles."""
    return (size + np.minimum(4 * size // 3, top)) // 7


def sketch_parts(
    owner: np.ndarray, hashes: np.ndarray, n: int, whole: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner and hash of the parts that each document of a slice sends, for all its bands.

    Third, the number of parts in which the document may differ in that band, times two, plus one
    if the band is the upper of its two; fourth, the documents whose shingles happen to fill too few
    parts for the full slack. ``whole`` returns all parts.
    """
    sizes = np.bincount(owner, minlength=n).astype(np.int64)
    out, short = [], np.zeros(n, bool)
    level = np.zeros(n, np.int64)
    level[sizes > 0] = np.floor(np.log2(sizes[sizes > 0])).astype(np.int64)
    for up in (0, 1):
        band = level + up
        top = (np.int64(1) << (band + 1)) - 1
        wanted = sizes > 0 if not up else (sizes > 0) & (4 * sizes // 3 > (np.int64(1) << band) - 1)
        parts = np.where(top <= SMALL, np.int64(1) << 40, np.maximum(1, ((top + 1) / PER_PART).astype(np.int64)))
        pick = wanted[owner]
        own, h = owner[pick], hashes[pick]
        if not len(own):
            continue
        part = h % parts[own].astype(np.uint64)
        order = np.lexsort((part, own))
        own, part, h = own[order], part[order], h[order]
        starts = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (part[1:] != part[:-1])))
        value = np.bitwise_xor.reduceat(mix(h), starts)
        own, part = own[starts], part[starts]
        with np.errstate(over="ignore"):
            name = mix(value ^ mix(part * np.uint64(GOLDEN) + band[own].astype(np.uint64)))
        order = np.lexsort((name, own))
        own, name = own[order], name[order]
        count = np.bincount(own, minlength=n)
        place = np.arange(len(own)) - (np.cumsum(count) - count)[own]
        differ = allowed_difference(sizes, top)
        sent = differ + 1 + sizes // SLACK
        short |= wanted & (count < sent)
        keep = (place < sent[own]) | whole
        out.append((own[keep], name[keep], 2 * differ[own[keep]] + up))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.flatnonzero(short)
    return *(np.concatenate(c) for c in zip(*out, strict=True)), np.flatnonzero(short)


def set_name(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit name of each set: sum and parity of its shingles' hashes; 0 for the empty set."""
    if not len(owner):
        return np.zeros(n, np.uint64)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix(hashes + np.uint64(1)), starts)
        name = mix(total ^ mix(np.bitwise_xor.reduceat(hashes, starts)))
    out = np.zeros(n, np.uint64)
    out[owner[starts]] = np.maximum(name, np.uint64(1))
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roll = RollingHash()
    for part in slices(batches, "t", SMALL_SLICE):
        owner, hashes = shingle_sets(*raw_bytes(part.column("t")), roll, SHINGLE)
        names = set_name(owner, hashes, part.num_rows)
        sizes = np.bincount(owner, minlength=part.num_rows)
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("h"), pa.array(names.view(np.int64)), pa.array(sizes, pa.int64())],
            ["id", "h", "name", "size"],
        )


def _send(buckets: int):
    """Blocks of parts by bucket: hashes of parts and names of sets, as byte planes."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()
        held: list[tuple] = []
        size = 0
        for part in slices(batches, "t", SMALL_SLICE):
            data, offsets = raw_bytes(part.column("t"))
            owner, hashes = shingle_sets(data, offsets, roll, SHINGLE)
            names = set_name(owner, hashes, part.num_rows)
            own, parts, _, short = sketch_parts(owner, hashes, part.num_rows)
            held.append((parts, names[own], names[short]))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield _block(held, buckets)
                held, size = [], 0
        if held:
            yield _block(held, buckets)

    return blocks


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[new], b[new], np.diff(np.append(new, len(a)))


def _block(held: list[tuple], buckets: int) -> pa.RecordBatch:
    parts, sets, short = (np.concatenate(c) for c in zip(*held, strict=True))
    parts, sets, _ = _unique_pairs(parts, sets)
    # A part that a crowd shares within one block is settled here: one mark for its bucket, and each
    # set of the crowd is told to the bucket of its own name, so that no bucket gets the whole crowd.
    first = np.append(True, parts[1:] != parts[:-1]) if len(parts) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    crowd = (np.bincount(group) > CROWD)[group] if len(parts) else first
    loud, times = np.unique(sets[crowd], return_counts=True)
    loud, times = np.append(loud, short), np.append(times, np.full(len(short), MANY))
    wide = np.uint64(2**64 // buckets + 1)
    rows: list[tuple[int, int, bytes, bytes]] = []
    for kind, names, extra, width in (
        (PARTS, parts[~crowd], sets[~crowd], 8),
        (MARKS, parts[crowd & first], parts[:0], 8),
        (LOUD, loud, times.astype(np.uint64), 4),
    ):
        where = (names // wide).astype(np.int64)
        order = np.argsort(where, kind="stable")
        where, names = where[order], names[order]
        extra = extra[order] if len(extra) else extra
        cuts = np.flatnonzero(np.append(True, where[1:] != where[:-1])).tolist() if len(where) else []
        for a, b in zip(cuts, [*cuts[1:], len(where)][: len(cuts)], strict=True):
            rows.append((int(where[a]), kind, pack(names[a:b], 8), pack(extra[a:b], width)))
    fields = zip(*rows, strict=True) if rows else ([], [], [], [])
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(f, k) for f, k in zip(fields, kinds, strict=True)], ["bucket", "kind", "names", "extra"]
    )


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket: pairs of sets with the number of parts they share, and crowded parts per set."""
    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("bucket", "kind", "names", "extra")]
        for row in zip(*columns, strict=True):
            if held and row[0] != held[0][0]:
                yield _matched(held)
                held = []
            held.append(row)
    if held:
        yield _matched(held)


def _matched(rows: list[tuple]) -> pa.RecordBatch:
    def read(kind: int, column: int, width: int) -> np.ndarray:
        found = [unpack(r[column], width) for r in rows if r[1] == kind]
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    parts, sets, _ = _unique_pairs(read(PARTS, 2, 8), read(PARTS, 3, 8))
    starts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(parts)))
    crowded = (counts > CROWD) | np.isin(parts[starts], read(MARKS, 2, 8))
    low, high = [sets[:0]], [sets[:0]]
    for size in range(2, CROWD + 1):  # all groups of one size at once
        at = starts[(counts == size) & ~crowded]
        for i in range(size):
            for j in range(i + 1, size):
                low.append(sets[at + i])
                high.append(sets[at + j])
    # Two sets meet in many parts; they are counted here, before the shuffle.
    a, b, shared = _unique_pairs(np.concatenate(low), np.concatenate(high))
    heavy = sets[np.repeat(crowded, counts)]
    loud = np.append(heavy, read(LOUD, 2, 8))
    times = np.append(np.ones(len(heavy), np.uint64), read(LOUD, 3, 4))
    names, place = np.unique(loud, return_inverse=True)
    total = np.bincount(place, weights=times, minlength=len(names)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(a, names).view(np.int64)),
            pa.array(np.append(b, np.zeros(len(names), np.uint64)).view(np.int64)),
            pa.array(np.append(shared, total).astype(np.int64)),
        ],
        ["a", "b", "n"],
    )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets of shingles have 100 * intersection >= 75 * union."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    roll = RollingHash()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            kept = []
            for i in range(part.num_rows):
                pair = [open_(part.column(c)[i].as_py()) for c in ("ta", "tb")]
                offsets = np.array([0, len(pair[0]), len(pair[0]) + len(pair[1])])
                owner, hashes = shingle_sets(np.frombuffer(b"".join(pair), np.uint8), offsets, roll, SHINGLE)
                n = int(np.count_nonzero(owner == 0))
                both = len(np.intersect1d(hashes[:n], hashes[n:], assume_unique=True))
                kept.append(100 * both >= 75 * (len(hashes) - both))
            yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    for part in slices(batches, "t", SMALL_SLICE):
        texts = [squeeze((t.as_py() or "").encode()) for t in part.column("t")]
        columns = [part.column("id"), part.column("h"), pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "h", "t"])


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified pairs (``a``, ``b``) of set names."""
    both = pairs.join(texts.select(F.col("name").alias("a"), F.col("t").alias("ta")), "a")
    both = both.join(texts.select(F.col("name").alias("b"), F.col("t").alias("tb")), "b")
    return work_table(texts_in_arrow(both.select("a", "b", "ta", "tb"), _verify, "a long, b long"), "parity-links")


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All parts of the given sets as rows, with the band and number of parts in which a near set may differ.

    ``total`` is how many parts the set has in that band.
    """
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    roll = RollingHash()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            data, offsets = joined([open_(t.as_py()) for t in part.column("t")])
            owner, hashes = shingle_sets(data, offsets, roll, SHINGLE)
            own, parts, differ, _ = sketch_parts(owner, hashes, part.num_rows, whole=True)
            names = part.column("name").to_numpy()
            bands, place = np.unique(np.stack([own, differ]), axis=1, return_inverse=True)
            total = np.bincount(place.ravel(), minlength=bands.shape[1])[place.ravel()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts.view(np.int64)), pa.array(names[own]), pa.array(differ), pa.array(total.astype(np.int64))],
                ["part", "name", "differ", "total"],
            )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A parity sketch of ``BITS`` bits per set: every shingle turns one bit over."""
    import zstandard

    open_ = zstandard.ZstdDecompressor().decompress
    roll = RollingHash()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            data, offsets = joined([open_(t.as_py()) for t in part.column("t")])
            owner, hashes = shingle_sets(data, offsets, roll, SHINGLE)
            turns = np.bincount(owner * BITS + (hashes % np.uint64(BITS)).astype(np.int64), minlength=part.num_rows * BITS)
            bits = np.packbits((turns & 1).astype(np.uint8).reshape(-1, BITS), axis=1)
            sizes = np.bincount(owner, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("name"), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(sizes, pa.int64())],
                ["name", "bits", "size"],
            )


def _earlier(held: list[tuple]) -> list[int]:
    """For each row a number whose bits are those of its first parts that come before the group's."""
    here, place, out = held[0][0], {}, []
    for row in held:
        bits = 0
        for part in row[8]:
            if part < here:
                bits |= 1 << place.setdefault(part, len(place))
        out.append(bits)
    return out


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components whose sketches differ in no more bits than near sets may.

    Sets of one group share very many parts. A pair is not told again where the first parts of both sets name an
    earlier part in which they meet, so most pairs are told once and none is lost.
    """
    held: list[tuple] = []

    def pairs() -> pa.RecordBatch:
        earlier = _earlier(held)
        side = np.array([r[3] for r in held])
        name, component, size = (np.array([r[k] for r in held], np.int64) for k in (4, 5, 7))
        bits = np.frombuffer(b"".join(r[6] for r in held), np.uint64).reshape(len(held), -1)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = []
        for at in range(0, len(one), 64):
            some = one[at : at + 64]
            apart = np.zeros((len(some), len(two)), np.int64)
            for word in range(bits.shape[1]):
                apart += np.bitwise_count(bits[some, word][:, None] ^ bits[two, word])
            ok = (apart <= (size[some][:, None] + size[two]) // 7) & (component[some][:, None] != component[two])
            x, y = np.nonzero(ok)
            x, y = some[x], two[y]
            fresh = [not earlier[i] & earlier[j] for i, j in zip(x.tolist(), y.tolist(), strict=True)]
            fresh = np.array(fresh, bool)
            found.append((name[x[fresh]], name[y[fresh]]))
        x, y = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (name[:0], name[:0])
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    for batch in batches:
        names = ("part", "i", "j", "side", "name", "component", "bits", "size", "parts")
        columns = [batch.column(c).to_pylist() for c in names]
        for row in zip(*columns, strict=True):
            if held and row[:3] != held[0][:3]:
                yield pairs()
                held = []
            held.append(row)
    if held:
        yield pairs()


def _crowd_links(texts: DataFrame, unsafe: DataFrame, found: DataFrame) -> DataFrame:
    """Links among the sets that have too many crowded parts, in addition to ``found``.

    Their parts are all counted now, and of the parts in a band each set keeps its rarest, one more
    than it may differ in: near sets have one of those in common. What is still crowded belongs to
    large groups. First every set is held against the smallest set of each of its parts, which
    connects most of a group; then only parts that still hold several components give pairs, only
    pairs of a set outside the part's largest component with sets of other components, and only those
    whose sketches are near enough.
    """
    own = texts.join(unsafe, "name", "left_semi").select("name", "t")
    spelled = work_table(texts_in_arrow(own, _spell, "part long, name long, differ long, total long"), "parity-parts")
    # A set's parts that no other has are its rarest; they are only counted, and do not move again.
    met = spelled.groupBy("part").agg(F.count("*").alias("n")).filter("n > 1")
    shared = spelled.join(work_table(met, "parity-shared"), "part")
    band = Window.partitionBy("name", "differ")
    alone = F.col("total") - F.count("*").over(band)
    ranked = shared.withColumn("r", F.row_number().over(band.orderBy("n", "part")) + alone)
    kept = ranked.filter("r <= differ div 2 + 1")
    kept = work_table(kept.select("part", "name"), "parity-rare")
    stars = kept.join(kept.groupBy("part").agg(F.min("name").alias("a")), "part").filter("name > a")
    stars = work_table(stars.select("a", F.col("name").alias("b")).distinct(), "parity-stars")
    links = found.unionByName(_linked(stars, texts))
    reached = components(links)
    placed = kept.join(reached, kept["name"] == reached["node"], "left").select(
        "part", "name", F.coalesce("component", "name").alias("component")
    )
    sizes = placed.groupBy("part", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("part").agg(
        F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("k"), F.sum("n").alias("n")
    ).filter("k > 1").select(
        "part", F.col("top.component").alias("main"),
        F.ceil((F.col("n") - F.col("top.n")) / GROUP_ROWS).alias("p"), F.ceil(F.col("n") / GROUP_ROWS).alias("q"),
    )
    bits = texts_in_arrow(own, _bitmaps, "name long, bits binary, size long")
    open_ = work_table(placed.join(main, "part"), "parity-open-parts")
    lists = open_.groupBy("name").agg(F.slice(F.array_sort(F.collect_list("part")), 1, FIRST_PARTS).alias("parts"))
    open_ = work_table(open_.join(bits.join(lists, "name"), "name"), "parity-open")
    # Blocks of the sets outside the largest component meet blocks of all sets of the part.
    columns = ["part", "i", "j", "side", "name", "component", "bits", "size", "parts"]
    place = F.xxhash64("name")
    one = open_.filter("component <> main").withColumn("i", F.pmod(place, "p")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("q") - 1))).withColumn("side", F.lit(0))
    two = open_.withColumn("j", F.pmod(place, "q")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("p") - 1))).withColumn("side", F.lit(1))
    dealt = one.select(columns).unionByName(two.select(columns))
    dealt = dealt.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "side")
    across = texts_in_arrow(dealt, _meet, "a long, b long").distinct()
    across = work_table(across.join(stars, ["a", "b"], "left_anti"), "parity-across")
    return links.unionByName(_linked(across, texts))


def text_hash(text: str) -> Column:
    """What tells rows of one key apart; NULL counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def near_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    Words are runs of characters other than space and 9 to 13, with A-Z in lower case; a set holds
    the distinct shingles of five words, or the whole sequence if there are fewer; NULL texts
    and texts without words have no shingles and link with nothing. Documents link when
    100 * intersection >= 75 * union. Every link between different sets is found, whatever the
    sizes of the groups; documents with equal sets are one set that its smallest key stands for. Rows with
    equal keys are rows of their own, also where their texts differ, so two groups may show the same
    smallest key (``near_sets`` tells them apart). A NULL key joins and links groups without naming
    them; a group of NULL keys only has no name. Sets are compared by 64-bit hashes of their shingles.
    """
    return near_sets(docs, key, text).select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
    )


def near_sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``h`` (key and hash of the text), ``size``, ``component`` (a name of the
    group's own, NULL without shingles), ``component_id`` (its smallest key), and ``first``: ``id`` and ``h``
    of the row that stands for the group, the one with the smallest key, NULL keys last.
    """
    slim = docs.select(F.col(key).alias("id"), text_hash(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = docs.schema[key].dataType.simpleString()
    described = work_table(texts_in_arrow(slim, _describe, f"id {kind}, h long, name long, size long"), "parity-sets")
    stands = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h")).alias("first")
    sets = described.filter("size > 0").groupBy("name").agg(stands, F.min("size").alias("size"))
    sets = work_table(sets, "parity-classes")
    # About 14 bytes a part, and parts are half of the shingles.
    buckets = task_count(described, BUCKET_BYTES, F.col("size") * 7)
    sent = texts_in_arrow(slim.select("t"), _send(buckets), "bucket int, kind int, names binary, extra binary")
    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    matched = work_table(texts_in_arrow(dealt, _match, "a long, b long, n long"), "parity-matches")
    loud = matched.filter("b = 0").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("n"))
    loud = work_table(loud.join(sets, "name").select("name", "n", "size"), "parity-crowds")
    counted = matched.filter("b <> 0").groupBy("a", "b").agg(F.sum("n").alias("n"))
    size, crowds = sets.select("name", "size"), loud.select("name", "n")
    # Near sets share one part and one more per SLACK shingles of the smaller, crowded parts included.
    pairs = (
        counted.join(size.toDF("a", "sa"), "a").join(size.toDF("b", "sb"), "b")
        .filter("4 * least(sa, sb) >= 3 * greatest(sa, sb)")
        .join(crowds.toDF("a", "la"), "a", "left").join(crowds.toDF("b", "lb"), "b", "left")
        .filter(f"n + least(coalesce(la, 0), coalesce(lb, 0)) >= 1 + least(sa, sb) div {SLACK}")
    )
    pairs = work_table(pairs.select("a", "b"), "parity-pairs")
    # With fewer crowded parts than it shares with its smallest partner, a set has lost no link.
    unsafe = work_table(loud.filter(f"n >= 1 + (3 * size div 4) div {SLACK}").select("name"), "parity-unsafe")
    wanted = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name")))
    wanted = work_table(wanted.unionByName(unsafe).distinct().join(sets, "name").select(
        "name", F.col("first.id").alias("wid"), F.col("first.h").alias("wh")), "parity-wanted")
    # Key and text together name the row that stands for a set: a key alone may stand on other texts, too,
    # and a text alone on very many rows.
    # Most texts are of no such set: they are neither zipped nor moved.
    maybe = marked(slim, F.xxhash64("id", "h"), wanted, F.xxhash64("wid", "wh"), "maybe").filter("maybe").drop("maybe")
    zipped = texts_in_arrow(maybe, _zipped, f"id {kind}, h long, t binary")
    its_own = (F.col("h") == F.col("wh")) & F.col("id").eqNullSafe(F.col("wid"))
    texts = work_table(zipped.join(wanted, its_own).groupBy("name").agg(F.min("t").alias("t")), "parity-texts")
    links = _linked(pairs, texts)
    if not unsafe.isEmpty():
        links = _crowd_links(texts, unsafe, links)
    reached = components(links)
    named = sets.join(reached, sets["name"] == reached["node"], "left").select(
        sets["name"], "first", F.coalesce("component", sets["name"]).alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("first"))
    named = work_table(named.select("name", "component").join(least, "component"), "parity-components")
    return described.join(named, "name", "left").select(
        "id", "h", "size", "component", F.col("first.id").alias("component_id"), "first"
    )
