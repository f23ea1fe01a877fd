"""Texts that a join cannot touch are not moved, also where its keys are too many for a broadcast."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import line_spread, parity_join
from siltbed.llm.common import BITS_A_KEY, marked


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved(rows, where):
    """Rows that share a partition of the output with rows of another partition of the input."""
    at = rows.withColumn("at", F.spark_partition_id()).filter(where).groupBy("at")
    mixed = at.agg(F.countDistinct("home").alias("homes"), F.count("*").alias("n")).filter("homes > 1")
    return sum(r.n for r in mixed.collect())


def placed(documents, texts, sources=None):
    """Documents that remember their partition (a plan that is kept, so it does not change)."""
    return documents(texts, sources).localCheckpoint().withColumn("home", F.spark_partition_id()).localCheckpoint()


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_marked_rows(spark, no_broadcast, n):
    rows = spark.range(20000).select(F.when(F.col("id") % 50 != 3, F.col("id")).alias("k"), F.lit(1).alias("_bit"))
    keys = spark.range(n).select((F.col("id") * 5).alias("k"))
    found = marked(rows, F.xxhash64("k"), keys, F.xxhash64("k"), "maybe")
    assert found.columns == ["k", "_bit", "maybe"] and found.count() == 20000
    held = {5 * i for i in range(n)}
    got = [(r.k, r.maybe) for r in found.collect()]
    assert all(maybe for k, maybe in got if k in held)
    assert sum(maybe for k, maybe in got if k not in held) <= 1.5 * 20000 / BITS_A_KEY


def test_lines_leave_other_texts_where_they_are(documents, no_broadcast):
    texts = [f"own line {i}\nbanner" if i % 10 == 0 else f"own line {i}\nand text {i}" for i in range(300)]
    docs = placed(documents, texts, [f"s{i % 300}" for i in range(300)])
    rows = line_spread.drop_spread_lines(docs)
    assert {r.doc_id: r.text for r in rows.collect()} == {i: t.removesuffix("\nbanner") for i, t in enumerate(texts)}
    assert moved(rows, "doc_id % 10 <> 0") < 270 / 3


def test_duplicates_leave_other_texts_where_they_are(spark, documents, no_broadcast):
    texts = [f"{i} a{i} b{i} c{i} d{i} e{i} f{i} g{i}" for i in range(290)] + ["one two three four five six seven"] * 10
    docs = placed(documents, texts)
    rows = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in rows.collect()) == list(range(291))
    assert moved(rows, "doc_id < 290") < 290 / 3


def test_only_wanted_texts_are_zipped(documents, no_broadcast, tmp_path, monkeypatch):
    texts = [f"{i} a{i} b{i} c{i} d{i} e{i} f{i} g{i}" for i in range(290)]
    texts += [" ".join(f"w{k}" for k in range(40 + i)) for i in range(5)]
    zipped, seen = parity_join._zipped, str(tmp_path)

    def counted(batches):
        import os
        import tempfile

        def told():
            for batch in batches:
                os.close(tempfile.mkstemp(prefix=f"{batch.num_rows}-", dir=seen)[0])
                yield batch

        yield from zipped(told())

    monkeypatch.setattr(parity_join, "_zipped", counted)
    rows = parity_join.near_documents(documents(texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: min(i, 290) for i in range(295)}
    assert 5 <= sum(int(p.name.split("-")[0]) for p in tmp_path.iterdir()) < 290 / 3


@pytest.mark.parametrize("step", ["_describe", "_send"])
def test_shingles_of_few_texts_are_held_at_a_time(step):
    rows = 2000
    texts = [" ".join(f"{i}w{k}" for k in range(150)) for i in range(rows)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(rows)), "h": list(range(rows)), "t": texts})
    run = parity_join._send(64) if step == "_send" else parity_join._describe
    for _ in run(iter([batch.slice(0, 100)])):  # what is made once
        pass
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25_000_000
