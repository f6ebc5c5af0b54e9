from pyspark.sql import functions as F

from tablewatch.operators import quality as q
from tablewatch.operators import suite as s


def test_nulls_pass_value_tests(spark):
    df = spark.createDataFrame([(None, None), ("x", 5)], "c string, n int")
    assert q.dq_accepted_values(df, "c", ["y"]).count() == 1
    assert q.dq_range(df, "n", 0, 1).count() == 1
    assert q.dq_not_null(df, "c").count() == 1
    assert q.dq_not_blank(df, "c").count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k int, ts timestamp_ntz")
    assert q.dq_not_empty(empty).count() == 1
    # A table without rows is not fresh: it is reported, without a newest value.
    assert [r["max_ts"] for r in q.dq_freshness(empty, "ts", "2024-01-01 00:00:00", 24).collect()] == [None]
    assert q.dq_unique(empty, "k").count() == 0


def test_unique_counts_and_null_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    rows = {r["k"]: r["n"] for r in q.dq_unique(df, "k").collect()}
    assert rows == {1: 2, None: 2}


def test_outlier_uses_one_row_stats(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x")).union(spark.createDataFrame([(10000.0,)], "x double"))
    out = q.dq_outlier_sigma(df, "x", 3.0)
    assert [r["x"] for r in out.collect()] == [10000.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan or "BroadcastExchange" in plan


def test_suite_skips_missing_column_and_fuses(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "b")], "k int, c string")
    tests = [s.TestSpec("nn", "not_null", "c"), s.TestSpec("uq", "unique", "k"),
             s.TestSpec("missing", "not_blank", "zz")]
    out = {r["test_name"]: r for r in s.suite_run(df, tests, "t", "2024-01-01 00:00:00").collect()}
    assert out["nn"]["violations"] == 1 and out["nn"]["verdict"] == "FAILED"
    assert out["uq"]["violations"] == 1
    assert out["missing"]["status"] == "skipped" and out["missing"]["needs"] == "zz"


def test_violation_count_before_sample_limit(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("c"))
    out = s.violation_sample(df, [s.TestSpec("nn", "not_null", "c")], ["k"], "2024-01-01 00:00:00", limit=100)
    rows = out.collect()
    assert len(rows) == 100 and {r["violations_total"] for r in rows} == {500}
