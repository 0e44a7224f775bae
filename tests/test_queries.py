"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.check_oracle import TABLES, rows_of

QUERIES = entry.library_queries()
ORACLE = entry.library_oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert Counter(got) == Counter(rows_of(cols, res.fetchall()))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "id" in df.columns
