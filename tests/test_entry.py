import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables aren't here")
CORE = sorted(n for n in entry.registry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "uri", "a", "c", "g2", "lift", "rank"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", CORE)
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    r = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(str(tuple(str(v) for v in row)) for row in r.fetchall())
    assert sorted(str(tuple(str(v) for v in row)) for row in df.select(*[f"`{c}`" for c in cols]).collect()) == want
