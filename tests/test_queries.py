"""Every query against its SQL on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from matchloom.plans import page_queries, registry, scalar_queries, table_queries

assert page_queries and scalar_queries and table_queries
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in registry.ORACLES:
        assert rows
        return
    out = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    want = sorted(tuple(plain(r[k]) for k in at) for r in out.fetchall())
    assert sorted(tuple(plain(r[c]) for c in sorted(names)) for r in rows) == want
