"""Every registered query against its SQL twin."""

import math
import os

import duckdb
import pytest

from landfall.plans import catalog, oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()
QUERIES = catalog.QUERIES
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _kind(name):
    name = name.lower()
    return {"bigint": "bigint", "integer": "int", "varchar": "string", "hugeint": "HUGEINT"}.get(
        name, name
    )


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    duck.execute(SQL[name])
    columns = [d[0] for d in duck.description]
    kinds = {d[0]: _kind(str(d[1])) for d in duck.description}
    expected = _rows(columns, duck.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert dict(df.dtypes) == kinds
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected)
    assert actual == expected
    assert expected
