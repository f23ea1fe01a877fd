import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from texts (or from pairs of key and text)."""

    def build(texts, sources=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [
            (k, t, ("en", "de", None)[i % 3], (sources[i] if sources else f"src{i % 4}"), len(t or ""))
            for i, (k, t) in enumerate(rows)
        ]
        return spark.createDataFrame(rows, T._parse_datatype_string(DOCS)).repartition(3)

    return build
