"""Every query of the catalog against its SQL on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from packloom.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    con = duck.execute(catalog.SQL[name])
    assert sorted(df.columns) == sorted(c[0] for c in con.description)
    rows = df.collect()
    assert rows, "nothing is compared"
    assert _rows(df.columns, rows) == _rows([c[0] for c in con.description], con.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
