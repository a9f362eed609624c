"""Every core query against its SQL, on the smallest tables."""

import datetime
import glob
import math
import os

import pytest

from textmill.plans import catalog

DATA = os.environ.get("TEXTMILL_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    got = df.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    r = duck.execute(sql)
    names = [c[0] for c in r.description]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    a = sorted((tuple(plain(x[c]) for c in cols) for x in got), key=repr)
    b = sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or float(p) == pytest.approx(float(q)) for p, q in zip(x, y) if p is not None or q is not None), (x, y)
