"""Queries of the training-data operators that SQL can express, against that SQL, on the smallest tables."""

import glob
import os

import pytest

from textmill.llm import queries as q

DATA = os.environ.get("TEXTMILL_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = pytest.importorskip("duckdb").connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query(spark, duck, name):
    df = q.queries()[name](spark, DATA)
    r = duck.execute(q.oracle_sql()[name])
    names = [c[0] for c in r.description]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    key = lambda v: tuple(float(x) if isinstance(x, (int, float)) or hasattr(x, "as_tuple") else x for x in v)
    a = sorted((key(x[c] for c in cols) for x in df.collect()), key=repr)
    b = sorted((key(x[names.index(c)] for c in cols) for x in r.fetchall()), key=repr)
    assert a == b
