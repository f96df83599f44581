"""Every registered query against its DuckDB statement, on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, digest

from conftest import SF_SMALL

SQL = entry.network_oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_is_registered_with_sql_or_documented():
    rows_only = {"src_file_meta"}
    assert set(entry.network_queries()) - set(SQL) == rows_only


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "packet_id"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(ocols, want)[0]
