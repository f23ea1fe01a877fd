"""Structure repair of conversations by alignment with the alternating grammar.

A well-formed conversation is empty, or an optional system turn followed by pairs of user and
assistant turns, so its role initials are one string for each feasible length. The turns are aligned with
each of these strings by Wagner and Fischer's table: keep, rerole, delete, insert. All lengths with the
same last role share one table over their common endings. Ukkonen's band leaves out the cells that a known
alignment, the incumbent, already beats. The cheapest tables are walked back, and the
least audit in ASCII order wins.

A conversation may be longer than a task can hold. It is therefore cut into segments of a few turns,
each aligned from every grammar state to every other, and the segments are joined in order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import work_table

SEGMENT = 64
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STATES = ("start", "s", "u", "a")  # the last role initial of the repaired turns so far
ROLES = {"u": "user", "a": "assistant"}
INFINITE = math.inf

Turn = tuple[str, int, bool, bool]  # role initial, copies, must be deleted, truncated
Path = tuple[int, str] | None  # cost and audit


def _tables(turns: list[Turn], last: str, reach: int, slack: float) -> list[list[float]]:
    """Costs of aligning turns ``i`` and on with the ``r`` last roles of the strings that end in ``last``.

    Forced deletions are left out, as every alignment has them. ``slack`` is what an alignment may cost.
    """
    other = "a" if last == "u" else "u"
    n = len(turns)
    below = [float(INSERT * r) if INSERT * r <= slack else INFINITE for r in range(reach + 1)]
    table = [below]
    live = 0
    for i in range(n - 1, -1, -1):
        initial, _, forced, truncated = turns[i]
        if forced:
            table.append(below)
            continue
        live += 1
        low, high = max(0, math.ceil(live - slack / DELETE)), min(reach, math.floor(live + slack / INSERT))
        row = [INFINITE] * (reach + 1)
        more = TRUNCATED if truncated else 0
        for r in range(low, high + 1):
            best = below[r] + DELETE
            if r:
                head = last if r % 2 else other
                best = min(best, row[r - 1] + INSERT, below[r - 1] + more + (KEEP if initial == head else REROLE))
            row[r] = best
        table.append(row)
        below = row
    table.reverse()
    return table


def _walk(turns: list[Turn], table: list[list[float]], last: str, i: int, r: int) -> str:
    """The least audit among the cheapest alignments of turns ``i`` and on with the ``r`` last roles."""
    other = "a" if last == "u" else "u"
    letters = []
    while i < len(turns):
        initial, copies, forced, truncated = turns[i]
        if forced:
            letters.append("D" * copies)
            i += 1
            continue
        cost = table[i][r]
        if table[i + 1][r] + DELETE == cost:
            letters.append("D" * copies)
            i += 1
        elif r and table[i][r - 1] + INSERT == cost:
            letters.append("I")
            r -= 1
        else:
            head = last if r % 2 else other
            letters.append(("K" if initial == head else "R") + "D" * (copies - 1))
            i, r = i + 1, r - 1
    return "".join(letters) + "I" * r


def align(turns: list[Turn]) -> dict[tuple[str, str], Path]:
    """Cheapest alignment (cost, audit) of the turns from every grammar state to every other, where there is one."""
    n = len(turns)
    alive = [t for t in turns if not t[2]]
    live = len(alive)
    # What has to go in any case: blank turns, repeats, and all but one of equal turns.
    forced = DELETE * sum(t[1] if t[2] else t[1] - 1 for t in turns)
    marks = sum(TRUNCATED for t in alive if t[3])
    diagonal = max(sum(REROLE for j, t in enumerate(alive) if t[0] != "ua"[(j + k) % 2]) for k in (0, 1)) + marks
    # Some alignment of every kind costs no more: along the diagonal or without any turn, and two roles put in.
    incumbent = min(diagonal + INSERT, DELETE * live) + 2 * INSERT
    reach = math.floor(live + incumbent / INSERT)
    tables = {last: _tables(turns, last, reach, incumbent) for last in "ua"}
    nothing = (forced + DELETE * live, "D" * sum(t[1] for t in turns))
    found: dict[tuple[str, str], Path] = {("start", "start"): nothing, ("s", "s"): nothing}
    systems = [i for i, t in enumerate(turns) if not t[2] and t[0] == "s"]
    before = [0]
    for t in turns:
        before.append(before[-1] + (0 if t[2] else DELETE))

    def opened(at: int) -> str:
        """Turns up to the system turn ``at``, which alone is kept."""
        return "D" * sum(t[1] for t in turns[:at]) + "K" + "D" * (turns[at][1] - 1)

    def kept(at: int) -> float:
        return before[at] + (TRUNCATED if turns[at][3] else 0)

    if systems:
        alone = [(int(forced + kept(i) + before[n] - before[i + 1]),
                  opened(i) + "D" * sum(t[1] for t in turns[i + 1 :])) for i in systems]
        found["start", "s"] = min(alone)
    for entry in STATES:
        first = "a" if entry == "u" else "u"
        for last in "ua":
            table = tables[last]
            least = 0 if entry == last else 1
            # A string that begins with ``first`` and ends in ``last`` has one parity of lengths.
            lengths = range(least if (least % 2 == 1) == (first == last) else least + 1, reach + 1, 2)
            cost = min((table[0][r] for r in lengths), default=INFINITE)
            ways: list[tuple[int, int]] = [(-1, r) for r in lengths if table[0][r] == cost < INFINITE]
            if entry == "start":  # or a kept system turn first, and at least one role after it
                for i in systems:
                    for r in range(1 if last == "u" else 2, reach + 1, 2):
                        own = kept(i) + table[i + 1][r]
                        if own < cost:
                            cost, ways = own, []
                        if own == cost < INFINITE:
                            ways.append((i, r))
            if ways:
                audits = (
                    _walk(turns, table, last, 0, r) if i < 0 else opened(i) + _walk(turns, table, last, i + 1, r)
                    for i, r in ways
                )
                found[entry, last] = (int(forced + cost), min(audits))
    return found


def _align_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes = [(e, x) for e in STATES for x in STATES]
    for batch in batches:
        costs, audits, illegal, ends = [], [], [], []
        for rows in batch.column("rows").to_pylist():
            turns = [(r["initial"], r["copies"], r["forced"], r["truncated"]) for r in rows]
            found = align(turns)
            costs.append([found[c][0] if c in found else None for c in classes])
            audits.append([found[c][1] if c in found else None for c in classes])
            wrong = sum(t[1] - 1 for t in turns)  # a role after itself is never in order
            wrong += sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
            illegal.append(wrong)
            ends.append((turns[0][0], turns[-1][0]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), pa.array(costs, pa.list_(pa.int64())),
             pa.array(audits, pa.list_(pa.string())), pa.array(illegal, pa.int64()),
             pa.array([e[0] for e in ends], pa.string()), pa.array([e[1] for e in ends], pa.string())],
            ["conv", "seg", "costs", "audits", "illegal", "first", "last"],
        )


class _Chain:
    """Segments of one conversation, joined one after the other; the ways to a state share their beginnings."""

    def __init__(self) -> None:
        self.ways: dict[int, tuple] = {0: (0, None)}  # state: cost and (way before, segment, entry, audit)
        self.illegal, self.last = 0, None

    def add(self, seg: int, costs: list, audits: list, illegal: int, first: str, last: str) -> None:
        self.illegal += illegal
        if self.last is not None and self.last + first not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = last
        after: dict[int, tuple] = {}
        for entry, (cost, node) in self.ways.items():
            for leave in range(len(STATES)):
                own = costs[entry * len(STATES) + leave]
                if own is None:
                    continue
                way = (cost + own, (node, seg, entry, audits[entry * len(STATES) + leave]))
                if leave not in after or self._before(way, after[leave]):
                    after[leave] = way
        self.ways = after

    @staticmethod
    def _before(one: tuple, two: tuple) -> bool:
        """Cheaper, or as cheap with the lesser audit; only what follows the common beginning is compared."""
        if one[0] != two[0]:
            return one[0] < two[0]
        a, b = one[1], two[1]
        left, right = [], []
        while a is not b:
            left.append(a[3])
            right.append(b[3])
            a, b = a[0], b[0]
        return "".join(reversed(left)) < "".join(reversed(right))

    def end(self) -> tuple[int, list[tuple]]:
        """Cost and pieces (segment, entry, audit) of the best well-formed result."""
        ends = [self.ways[s] for s in (0, 3) if s in self.ways]
        best = ends[0] if len(ends) == 1 or self._before(ends[0], ends[1]) else ends[1]
        pieces, node = [], best[1]
        while node is not None:
            pieces.append(node[1:])
            node = node[0]
        return best[0], pieces[::-1]


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation (``seg`` NULL) with its audit, and one per segment with its part of it."""
    names = ["conv", "seg", "entry", "audit", "cost", "illegal"]
    chain, key, kind = None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        cost, pieces = chain.end()
        for at in range(0, len(pieces) + 1, 4096):
            part = pieces[at : at + 4096]
            rows = [(key, s, e, a, None, None) for s, e, a in part]
            if not at:
                rows.append((key, None, None, "".join(p[2] for p in pieces), cost, chain.illegal))
            kinds = (kind, pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(f, t) for f, t in zip(zip(*rows), kinds, strict=True)], names)

    for batch in batches:
        kind = batch.column("conv").type
        columns = [batch.column(c).to_pylist() for c in ("conv", "seg", "costs", "audits", "illegal", "first", "last")]
        for conv, *rest in zip(*columns, strict=True):
            if chain is None or conv != key:
                if chain is not None:
                    yield from done()
                chain, key = _Chain(), conv
            chain.add(*rest)
    if chain is not None:
        yield from done()


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of the repaired conversations; the audit of a segment comes before its turns."""
    names = ["conv", "seg", "place", "role", "text", "edit"]
    letters, state, place, key = iter(""), "start", 0, None
    rows: list[tuple] = []

    def wanted() -> str:
        return "a" if state == "u" else "u"

    def step(letter: str, turn: tuple | None) -> None:
        nonlocal state, place
        state = turn[1][:1] if letter == "K" else wanted()
        role, text = (turn[1], turn[2]) if letter == "K" else (ROLES[state], turn[2] if turn else "")
        rows.append((*key, place, role, text, letter))
        place += 1

    def rest() -> None:
        for letter in letters:
            step(letter, None)

    for batch in batches:
        kind = batch.column("conv").type
        columns = [batch.column(c).to_pylist() for c in ("conv", "seg", "role", "text", "copies", "audit", "entry")]
        for conv, seg, role, text, copies, audit, entry in zip(*columns, strict=True):
            if audit is not None:
                rest()
                letters, state, place, key = iter(audit), STATES[entry], 0, (conv, seg)
                continue
            letter = next(letters)
            while letter == "I":
                step(letter, None)
                letter = next(letters)
            if letter != "D":
                step(letter, (letter, role, text))
            for _ in range(copies - 1):
                next(letters)
        if rows:
            yield _turn_batch(rows, kind, names)
            rows = []
    rest()
    if rows:
        yield _turn_batch(rows, kind, names)


def _turn_batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(f, t) for f, t in zip(zip(*rows), kinds, strict=True)], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, key, kind = None, None, None
    for batch in batches:
        kind = batch.column("conv").type
        found: list[tuple] = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
            if hasher is None or conv != key:
                if hasher is not None:
                    found.append((key, hasher.hexdigest()))
                hasher, key = hashlib.sha256(), conv
            else:
                hasher.update(b"\n")
            hasher.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], pa.string())], ["conv", "sha256"])
    if hasher is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([hasher.hexdigest()])], ["conv", "sha256"])


def turn_digests(repaired: DataFrame) -> DataFrame:
    """``conv`` and ``sha256`` of its turns, ``role:text`` joined by line ends; turns stream by and are not held."""
    kind = dict(repaired.dtypes)["conv"]
    rows = repaired.select("conv", "seg", "place", "role", "text").repartition("conv")
    return rows.sortWithinPartitions("conv", "seg", "place").mapInArrow(_digests, f"conv {kind}, sha256 string")


def repair_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """A summary per conversation and the repaired turns.

    The summary has ``conv``, ``gaps`` (turn numbers missing between the first and the last), ``blank``,
    ``duplicate``, ``truncated`` (turns by their first fault), ``illegal`` (pairs of neighbours out of
    order), ``cost`` and ``audit`` (letters of the edits in order). The repaired turns have ``conv``,
    ``seg`` and ``place`` (their order), ``role``, ``text`` and ``edit`` (K, R or I).

    Turns are ordered by number (NULL first), then by role and text, so ties have one order; equal rows
    are neighbours, and all but the first are duplicates. A NULL role or text counts as one space, a NULL
    key is a conversation of its own. An empty table has no conversations. Other columns are not read.
    Lone texts of any length pass; only role initials and faults are aligned.
    ``gaps`` is NULL where it does not fit 64 bits.
    """
    t = turns.select(
        F.col(key).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    # Equal rows become one with a count, so a turn repeated without end is one row.
    t = t.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    t = t.select(
        "*", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("mark"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    t = work_table(t, "turns")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = t.groupBy("conv", "mark").agg(F.min(order).alias("f")).select(
        F.col("conv").alias("_c"), F.col("mark").alias("_m"), F.col("f.turn").alias("_t")
    )
    t = t.join(first, (F.col("mark") == F.col("_m")) & F.col("conv").eqNullSafe(F.col("_c")))
    again = ~F.col("turn").eqNullSafe(F.col("_t"))
    t = t.select(
        "conv", "turn", "role", "text", "copies", "blank", (~F.col("blank") & again).alias("again"),
        (~F.col("blank") & ~again & F.col("open")).alias("truncated"),
    )
    place = ["conv", "turn", "role", "text"]
    t = t.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("n", F.monotonically_increasing_id())
    t = work_table(t.withColumn("seg", F.floor(F.col("n") / SEGMENT)), "turns-in-order")

    feature = F.struct(
        "n", F.substring("role", 1, 1).alias("initial"), "copies",
        (F.col("blank") | F.col("again")).alias("forced"), "truncated",
    )
    segments = t.groupBy("conv", "seg").agg(F.array_sort(F.collect_list(feature)).alias("rows"))
    kind = dict(t.dtypes)["conv"]
    aligned = segments.mapInArrow(
        _align_segments,
        f"conv {kind}, seg long, costs array<long>, audits array<string>, illegal long, first string, last string",
    )
    ordered = aligned.repartition("conv").sortWithinPartitions("conv", "seg")
    joined = ordered.mapInArrow(
        _join_segments, f"conv {kind}, seg long, entry int, audit string, cost long, illegal long"
    )
    joined = work_table(joined, "turn-audits")

    copies, live = F.col("copies"), ~F.col("blank") & ~F.col("again")
    numbers = t.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("again"), copies).when(live, copies - 1).otherwise(0)).alias("duplicate"),
        F.count_if("truncated").alias("truncated"),
    )
    wide = F.col("turn").cast("decimal(20,0)")
    counted = numbers.groupBy("conv").agg(
        F.coalesce(F.max(wide) - F.min(wide) + 1 - F.count("turn"), F.lit(0)).try_cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    audits = joined.filter("seg IS NULL").select(F.col("conv").alias("_c"), "illegal", "cost", "audit")
    summary = counted.join(audits, F.col("conv").eqNullSafe(F.col("_c"))).drop("_c")

    pieces = joined.filter("seg IS NOT NULL").select("conv", "seg", "audit", "entry")
    both = pieces.unionByName(t.select("conv", "seg", "n", "role", "text", "copies"), allowMissingColumns=True)
    both = both.repartition("seg").sortWithinPartitions("seg", "conv", F.asc_nulls_first("n"))
    both = both.select("conv", "seg", "role", "text", "copies", "audit", "entry")
    repaired = both.mapInArrow(_apply, f"conv {kind}, seg long, place int, role string, text string, edit string")
    return summary, repaired


def damaged(conversations: DataFrame) -> DataFrame:
    """A tenth and more of the turns with a fault: lost, emptied, without ends of sentences, repeated, of another role."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), code.alias("code"))
    return rows.filter("code <> 0").select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("_one"),
    ).drop("_one")
