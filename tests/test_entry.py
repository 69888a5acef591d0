"""Every query runs on the smallest data and, where it has SQL, gives the same rows as DuckDB."""

import glob
import os

import duckdb
import pytest

from ledgerloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, con, f, sql):
    df = f(spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if sql is None:
        return
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    compare(spark, con, catalog.QUERIES[name], catalog.SQL.get(name))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
