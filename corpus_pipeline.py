"""A training corpus from raw documents: filter, clean, dedupe, mix, tokenise.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes
the result of every stage to the shared work folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import line_spread, mixing, parity_join, quality_model, queries
from siltbed.llm.common import distinct_name, marked, parquet, work_table
from siltbed.registry.base import Registry

R = Registry()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones outside the held-out fold."""
    model = quality_model.fit(docs, parquet(spark, sf_dir, "labels"))
    return quality_model.quality_scores(docs, model).filter("predicted = 1").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites; ``n_chars`` follows the text.

    Only documents whose whole text stands on that many sites stay as they are, for the next stage.
    """
    kept = line_spread.drop_spread_lines(docs, min_sites=queries.MIN_SITES, keep_copies=True)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest key, whatever the other rows of its key.

    Rows without words are in no group; those equal in key and text are one document all the same.
    """
    near = work_table(parity_join.near_sets(docs), "pipeline-near")
    h = distinct_name(docs, "_h")
    rows = docs.withColumn(h, parity_join.text_hash("text"))

    def among(keys: DataFrame):
        return (rows[h] == keys["_kh"]) & rows["doc_id"].eqNullSafe(keys["_kid"])

    keys = [F.col("id").alias("_kid"), F.col("h").alias("_kh")]
    losers = near.filter("size > 0 AND NOT (id <=> first.id AND h = first.h)").select(*keys).distinct()
    losers = work_table(losers, "pipeline-losers")
    # What is surely no loser stays where it is.
    flag = distinct_name(rows, "_maybe")
    rows = marked(rows, F.xxhash64("doc_id", h), losers, F.xxhash64("_kid", "_kh"), flag)
    kept = rows.filter(flag).join(losers, among(losers), "left_anti").unionByName(rows.filter(f"NOT `{flag}`"))
    # The row that stands for a group, or a row without words, may be there more than once.
    same = near.filter("size > 0 AND id <=> first.id AND h = first.h OR size = 0 AND id IS NOT NULL")
    repeats = work_table(same.groupBy(*keys).count().filter("count > 1").drop("count"), "pipeline-repeats")
    if not repeats.isEmpty():
        once = kept.join(repeats, among(repeats), "left_semi").dropDuplicates(["doc_id", h])
        kept = kept.join(repeats, among(repeats), "left_anti").unionByName(once)
    return kept.select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix, each as often as the epochs of its source take it."""
    return mixing.repeated(queries.mixed(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return queries.encoded(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixture),
    ("BPE encoding", tokens),
]

# Trained weights, hashed sketches and a BPE vocabulary are beyond SQL: tested against brute force.
ORACLE_SQL = None


@R.query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
