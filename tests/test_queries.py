"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    out = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert out.startswith(("ok", "rows-only")), out


def test_entry(spark):
    assert entry.entry(spark).count() == 5
