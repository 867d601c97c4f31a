"""Every bound query against DuckDB on the smallest tables."""

import collections
import os

import duckdb
import pytest

from threadloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def value(v):
    if v is None or v != v:
        return None
    return int(v) if isinstance(v, (bool, float)) and v == int(v) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, DATA)
    got = collections.Counter(tuple(value(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in registry.oracle_sql():
        assert got
        return
    cur = con.execute(registry.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    assert got == collections.Counter(tuple(value(r[i]) for i in order) for r in cur.fetchall())
