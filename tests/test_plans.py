"""Plan properties: pushdown, no Python UDFs, no data cross products."""

import pytest

from tablewatch.plans import load_all
from tests.conftest import SMALL

QUERIES, ORACLE = load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_to_scan(spark):
    plan = _plan(QUERIES["scan_parquet"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("key", ["suite_run", "rec_row_diff", "c01_all_purpose_jobs", "classify_failures",
                                 "dup_class", "doc_valid", "profile_columns", "overlapping_runs"])
def test_no_python_udf(spark, key):
    plan = _plan(QUERIES[key](spark, SMALL))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_every_query_has_entry():
    assert len(QUERIES) >= 150
    missing = [k for k in ORACLE if k not in QUERIES]
    assert not missing
