"""Corpus queries against their SQL in DuckDB."""

import duckdb
import pytest

from tablewatch.llm.queries import ORACLE, QUERIES
from tests.conftest import SMALL


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as select * from read_parquet('{SMALL}/{name}.parquet')")
    found = con.execute(ORACLE[key])
    columns, want = [d[0] for d in found.description], found.fetchall()
    got = QUERIES[key](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)
