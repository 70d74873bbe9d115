"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100


def test_entry(spark):
    row = entry_module.entry(spark).first()
    assert 0 < row["ndcg_10"] <= 1
