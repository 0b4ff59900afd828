"""Every registered query runs; those with SQL give the same rows in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return c


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, con, name):
    got = QUERIES[name](spark, data).toPandas()
    spark.catalog.clearCache()
    assert len(got)
    if name in ORACLE:
        assert rows_of(got) == rows_of(con.execute(ORACLE[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 5
