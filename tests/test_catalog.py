"""Every registered query of the library against its SQL in another engine."""

import glob
import os

import duckdb
import pytest

from tessera.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    answer = con.execute(catalog.ORACLE[name])
    at = [c[0] for c in answer.description]
    want = sorted((tuple(plain(r[at.index(c)]) for c in names) for r in answer.fetchall()), key=repr)
    assert got == want
