"""Every query against its oracle on the smallest tables."""

import glob
import os

import duckdb
import pytest

from kinweave.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
FAST = list(queries.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return round(float(v), 5) if type(v).__name__ in ("float", "Decimal") else v


@pytest.mark.parametrize("name", FAST)
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want
