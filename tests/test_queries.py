"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from skein.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat() if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE_SQL:
        return
    want = db.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
