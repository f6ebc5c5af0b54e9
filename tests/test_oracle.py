"""Every registered query against its DuckDB oracle on the smallest scale."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from tablewatch.plans import load_all
from tablewatch.sources.fixtures import BASE_TABLES
from tests.conftest import SMALL

QUERIES, ORACLE = load_all()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in BASE_TABLES:
        c.execute(f"create view {name} as select * from read_parquet('{SMALL}/{name}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    srows = df.collect()
    cur = con.execute(ORACLE[key])
    dnames = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dnames)
    assert _rows(df.columns, srows) == _rows(dnames, cur.fetchall())
