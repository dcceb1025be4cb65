"""Every pipeline operator's query against its SQL on the smallest tables."""

import os

import pytest

from linkframe.llm import queries

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(D):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, D)
    r = duck.execute(queries.oracle_sql()[name])
    cols = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted((tuple(plain(row[c]) for c in sorted(cols)) for row in df.collect()), key=repr)
    assert got == sorted((tuple(plain(row[cols.index(c)]) for c in sorted(cols)) for row in r.fetchall()), key=repr)
