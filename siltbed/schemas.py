"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

# The event payload, as delivered in JSON.
PAYLOAD = """
    id BIGINT, type STRING, namespace BIGINT, title STRING, title_url STRING, comment STRING,
    timestamp BIGINT, user STRING, bot BOOLEAN, minor BOOLEAN, patrolled BOOLEAN,
    server_name STRING, wiki STRING,
    meta STRUCT<id: STRING, domain: STRING, dt: STRING>,
    length STRUCT<old: BIGINT, new: BIGINT>,
    _producer STRUCT<source: STRING, producer_timestamp_utc: STRING>
"""

# Table layouts.
INBOX = "event_json STRING, event_key STRING, produced_at BIGINT"
REFERENCE = "wiki_code STRING, project_name STRING, language_code STRING, site_url STRING"
FACT = """
    event_id BIGINT, date_key INT, project_key STRING, editor_type_key INT, user STRING,
    title STRING, event_time TIMESTAMP, length_old BIGINT, length_new BIGINT,
    byte_change BIGINT, abs_byte_change BIGINT, is_minor_edit BOOLEAN, gold_ingested_at TIMESTAMP
"""
DOCUMENT = """
    document_id STRING, wiki STRING, page_id BIGINT, canonical_title STRING, description STRING,
    extract STRING, source_url STRING, revision STRING, fetched_at TIMESTAMP,
    document_type STRING, text STRING, content_hash STRING, response_json STRING
"""
CHUNK = """
    chunk_id STRING, document_id STRING, corpus_id STRING, text STRING, content_hash STRING,
    source_url STRING, title STRING, document_type STRING, fetched_at TIMESTAMP,
    revision STRING, start_utc TIMESTAMP, end_utc TIMESTAMP, generation STRING
"""
MANIFEST = """
    corpus_id STRING, status STRING, generation STRING, report_json STRING, updated_at TIMESTAMP
"""
ALIAS = "wiki STRING, title STRING, document_id STRING"


def column_names(ddl: str) -> list[str]:
    """Top-level column names of a DDL string."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fieldNames()
