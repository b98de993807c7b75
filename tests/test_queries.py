"""Every registered query against its SQL over the smallest generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
from marquee.plans import catalog, flows  # noqa: E402

OWN = catalog.QUERIES | flows.QUERIES
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, database, name):
    frame = QUERIES[name](spark, tables)
    columns = sorted(frame.columns)
    got = [tuple(row[c] for c in columns) for row in frame.collect()]
    result = database.sql(ORACLES[name])
    at = [result.columns.index(c) for c in columns]
    assert sorted(result.columns) == columns
    want = [tuple(row[i] for i in at) for row in result.fetchall()]
    assert got, "the query must give rows"
    assert ordered(got) == ordered(want)
