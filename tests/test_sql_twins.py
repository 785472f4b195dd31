"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{D}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize() + 0)
    return str(v) if isinstance(v, (datetime.datetime, datetime.date)) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_twin(spark, con, name):
    df = entry.queries()[name](spark, D)
    cols = sorted(df.columns)
    r = con.execute(entry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert cols == sorted(names)
    want = Counter(tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall())
    got = Counter(tuple(plain(row[c]) for c in cols) for row in df.collect())
    assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["recording_mbid", "listen_date", "split_version_id"] and df.count() >= 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
