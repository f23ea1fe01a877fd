"""Markdown files -> documents with a title, a path and a content hash."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.plans import once
from siltbed.functions.text import digest, is_blank, strip
from siltbed.operators.chunks import PROJECT_TYPE

# The customary limit of a file, front-matter marks, allowed paths.
MAX_FILE_BYTES = 256_000
FRONT, FRONT_END = "---\n", "\n---\n"
PATH_PATTERN = r"^(?:[A-Za-z0-9_-]+/)+[A-Za-z0-9_-]+\.md$"
URL_SCHEME = "projectdoc:///"


def markdown_files(spark: SparkSession, root: str, folder: str = "docs") -> DataFrame:
    """``source_path`` (``folder`` + path below ``root``), ``length`` and raw text of every file."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.md")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    marker = root.rstrip("/").split("://")[-1].split(":")[-1] + "/"
    below = F.substring_index("path", marker, -1).alias("below")
    # Spark reads no rows from empty files, but its file listing has them; they are faults, too.
    listed = spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "path STRING")
    found = files.select(below, "length", F.decode("content", "utf-8").alias("raw"))
    return listed.select(below).join(found, "below", "left").select(
        F.concat_ws("/", F.lit(folder), "below").alias("source_path"),
        F.coalesce("length", F.lit(0)).alias("length"),
        F.coalesce("raw", F.lit("")).alias("raw"),
    )


def markdown_documents(
    files: DataFrame, now: Column | None = None, max_file_bytes: int | None = MAX_FILE_BYTES
) -> DataFrame:
    """One document per file; ``fault`` is NULL for usable ones.

    A file above ``max_file_bytes`` is a fault; with None a file may have any size.
    """
    now = F.current_timestamp() if now is None else now
    raw = F.col("raw")
    fronted = raw.startswith(FRONT)
    end = F.instr(raw, FRONT_END)
    head = F.when(fronted & (end > 0), F.substring(raw, F.lit(1), end - 1))
    body = F.when(head.isNotNull(), F.substring(raw, end + len(FRONT_END), F.length(raw)))
    listed = F.regexp_extract(head, r"(?m)^title:\s*(.+)$", 1)
    named = F.regexp_replace(strip(listed), "^[\"']+|[\"']+$", "")
    stem = F.regexp_extract("source_path", r"([^/]+)\.md$", 1)
    text = strip(F.when(fronted, body).otherwise(raw))
    too_large = F.lit(False) if max_file_bytes is None else F.col("length") > max_file_bytes
    fault = (
        F.when(fronted & (end == 0), "unclosed front matter")
        .when(is_blank(F.when(fronted, body).otherwise(raw)), "empty document")
        .when(too_large, "file too large")
        .when(~F.col("source_path").rlike(PATH_PATTERN), "path")
    )
    return once(files, "raw", raw).select(
        F.concat(F.lit("project-doc:"), "source_path").alias("document_id"),
        F.when(F.length(listed) > 0, named).otherwise(stem).alias("canonical_title"),
        "source_path",
        F.concat(F.lit(URL_SCHEME), "source_path").alias("source_url"),
        F.lit(PROJECT_TYPE).alias("document_type"),
        digest(raw).alias("revision"),
        digest(raw).alias("content_hash"),
        now.alias("fetched_at"),
        text.alias("text"),
        "length",
        fault.alias("fault"),
    )


def document_set_gate(
    documents: DataFrame, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """One row: has the set a file, no faults, and no more files and bytes than the caller allows?"""
    accepted = (F.col("files") >= 1) & (F.col("faults") == 0)
    for column, limit in (("files", max_files), ("bytes", max_bytes)):
        if limit is not None:
            accepted = accepted & (F.col(column) <= limit)
    return documents.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.count("fault").alias("faults"),
    ).withColumn("accepted", accepted)
