"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str([plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equal(spark, db, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    theirs = db.sql(entry.oracle_sql()[name])
    assert sorted(theirs.columns) == columns
    assert ours == sorted(tuple(map(plain, r)) for r in theirs.select(*(f'"{c}"' for c in columns)).fetchall())


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns
