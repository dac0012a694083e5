"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

from gridloom.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.date):
        return v.isoformat()
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f).split('.')[0]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want
