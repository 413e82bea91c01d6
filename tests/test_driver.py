"""Every registered query against its SQL counterpart, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.plans import driver_queries, driver_sql


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_catalogue_is_complete():
    assert set(driver_queries.QUERIES) == set(driver_sql.SQL) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert "hourly_liquidity_key" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(columns).collect()) == wanted
