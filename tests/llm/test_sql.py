"""Queries with a counterpart in SQL give the same rows."""

import duckdb
import pytest

from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import SQL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf_dir, name):
    with duckdb.connect() as con:
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        found = con.execute(SQL[name])
        columns = [c[0] for c in found.description]
        wanted = [dict(zip(columns, row, strict=True)) for row in found.fetchall()]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    columns.sort()
    rows = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted((tuple(plain(r[c]) for c in columns) for r in wanted), key=repr)
    assert rows
