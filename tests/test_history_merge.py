"""Type-2 history and merge plans against straightforward loops."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from siltbed.operators import history, merge

COLUMNS = "wiki_code STRING, project_name STRING, language_code STRING, site_url STRING, note STRING"


def looped(snapshots):
    """The history by hand: one snapshot after the other."""
    rows, open_rows = [], {}
    for version, snapshot in snapshots.items():
        for key in list(open_rows):
            new = snapshot.get(key)
            if new is None or new[:3] != open_rows[key][1][:3]:
                start, values = open_rows.pop(key)
                rows.append((key, *values, start, version))
            else:
                open_rows[key] = (open_rows[key][0], new)
        for key, values in snapshot.items():
            open_rows.setdefault(key, (version, values))
    return set(rows) | {(k, *v, s, None) for k, (s, v) in open_rows.items()}


def random_snapshots(seed):
    rng = random.Random(seed)
    pick = lambda *options: rng.choice(options)
    return {
        version: {
            f"k{i}": (pick("a", "b", None), pick("x", None), "u", pick("n1", "n2", "n3"))
            for i in range(25)
            if rng.random() < 0.7
        }
        for version in (1, 2, 5, 6, 9)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_both_forms_match_the_loop(spark, seed):
    snapshots = random_snapshots(seed)
    rows = [(v, k, *values) for v, s in snapshots.items() for k, values in s.items()]
    stacked = spark.createDataFrame(rows, f"version INT, {COLUMNS}")
    names = [c.split()[0] for c in COLUMNS.split(", ")] + [history.START, history.END]
    expected = looped(snapshots)
    built = history.scd2_from_snapshots(stacked, "version").select(names)
    assert {tuple(r) for r in built.collect()} == expected
    empty = spark.createDataFrame([], f"{COLUMNS}, {history.START} INT, {history.END} INT")
    applied = reduce(
        lambda h, v: history.scd2_apply(h, stacked.filter(F.col("version") == v), F.lit(v)),
        snapshots, empty,
    ).select(names)
    result = [tuple(r) for r in applied.collect()]
    assert set(result) == expected and len(result) == len(expected)


def test_same_snapshot_twice_changes_nothing(spark):
    snapshot = spark.createDataFrame([("a", "A", None, "u", "n")], COLUMNS)
    empty = spark.createDataFrame([], f"{COLUMNS}, {history.START} INT, {history.END} INT")
    once = history.scd2_apply(empty, snapshot, F.lit(1))
    assert history.scd2_apply(once, snapshot, F.lit(2)).collect() == once.collect()
    touched = snapshot.withColumn("note", F.lit("other"))
    after = history.scd2_apply(once, touched, F.lit(2)).collect()
    assert len(after) == 1 and after[0].note == "other" and after[0][history.START] == 1


def test_guards(spark):
    rows = spark.createDataFrame([("a", 3, None), ("b", 1, 5)], "wiki_code STRING, __START_AT INT, __END_AT INT")
    assert not history.snapshot_order_guard(rows, F.lit(4)).first().accepted
    assert history.snapshot_order_guard(rows, F.lit(5)).first().accepted
    assert history.snapshot_order_guard(rows.filter("false"), F.lit(0)).first().accepted
    twice = rows.union(rows)
    assert history.duplicate_snapshot_keys(twice).count() == 2
    assert [r.wiki_code for r in history.scd2_as_of(rows, F.lit(2)).collect()] == ["b"]
    assert [r.wiki_code for r in history.scd2_active(rows).collect()] == ["a"]


def test_merge_plan(spark):
    ddl = "id INT, scope STRING, v STRING"
    target = spark.createDataFrame([(1, "x", "a"), (2, "x", None), (3, "x", "c"), (4, "y", "d")], ddl)
    source = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (5, "x", None)], ddl)
    plan = merge.merge_plan(target, source, ["id"])
    actions = {r.id: r._action for r in plan.collect()}
    assert actions == {1: "unchanged", 2: "update", 3: "keep", 4: "keep", 5: "insert"}
    assert {r.id: r.v for r in merge.merge_apply(plan).collect()}[2] == "b"
    within = merge.replace_within(target, source, ["id"], "scope")
    assert {r.id: r._action for r in within.collect()} == {**actions, 3: "delete"}
    assert sorted(r.id for r in merge.merge_apply(within).collect()) == [1, 2, 4, 5]
    assert sorted(r.id for r in merge.change_feed(within).collect()) == [2, 3, 5]
    diff = {r.id: r._action for r in merge.chunk_diff(target, source, ["id"]).collect()}
    assert diff == {2: "update", 3: "delete", 4: "delete", 5: "insert"}
    again = merge.unchanged_rerun(merge.merge_plan(target, target, ["id"])).first()
    assert again.idle and again.unchanged_rows == 4
    counts = {r.action: r.rows for r in merge.merge_counts(plan).collect()}
    assert counts == {"unchanged": 1, "update": 1, "keep": 2, "insert": 1}
