"""Queries with SQL agree with it."""

import duckdb
import pytest

from gridloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = db.execute(SQL[name])
    columns = [c[0] for c in want.description]
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want.fetchall()))
