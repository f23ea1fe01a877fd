"""Every registered query against its SQL oracle, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from siltbed.registry import all_registries

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in found), key=str)


@pytest.mark.parametrize("name", sorted(n for r in all_registries() for n in r.oracles))
def test_query_matches_oracle(spark, duck, name):
    frame = entry.queries()[name](spark, DATA)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows(frame.columns, frame.collect()) == rows(names, cursor.fetchall())


def test_registry_is_complete():
    for registry in all_registries():
        assert set(registry.queries) == set(registry.oracles)


def test_flagship(spark):
    assert entry.entry(spark).columns[:2] == ["language_name", "project_name"]
