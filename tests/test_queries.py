"""Every query against its SQL on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def norm(v):
    return "N" if v is None or isinstance(v, float) and math.isnan(v) else str(v)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted(tuple(norm(r[cols.index(c)]) for c in order) for r in cur.fetchall())
    assert sorted(tuple(norm(r[c]) for c in order) for r in rows) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
