"""Registered queries against their SQL twins, on the given tables."""

import os
import re

import duckdb
import pytest

from landfall.llm import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    con.execute(registry.ORACLE_SQL[name])
    columns = sorted(d[0] for d in con.description)
    at = [[d[0] for d in con.description].index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in at) for r in con.fetchall()), key=repr)
    df = registry.QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == expected


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in registry.QUERIES
