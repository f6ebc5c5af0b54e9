import pytest
from pyspark.sql import functions as F

from tablewatch.functions.thresholds import ThresholdError, parse_threshold, verdict


@pytest.mark.parametrize("expr,parsed", [("> 0", (">", 0)), ("!=0", ("!=", 0)), (">= 5", (">=", 5)),
                                         ("<=10", ("<=", 10)), ("= 3", ("=", 3))])
def test_accepts(expr, parsed):
    assert parse_threshold(expr) == parsed


@pytest.mark.parametrize("expr", ["== 0", "> 0.01", "> -5", "${{ x }}", "", "0", "> abc", None])
def test_rejects(expr):
    with pytest.raises(ThresholdError):
        parse_threshold(expr)


def test_verdict_error_wins(spark):
    df = spark.createDataFrame([(0,), (5,), (150,), (None,)], "n int")
    out = {r["n"]: r["v"] for r in df.select("n", verdict(F.col("n"), "> 0", "> 100").alias("v")).collect()}
    assert out == {0: "SUCCEEDED", 5: "WARNING", 150: "FAILED", None: "SUCCEEDED"}


def test_threshold_exactly_met(spark):
    df = spark.createDataFrame([(100,)], "n int")
    assert df.select(verdict(F.col("n"), ">= 100", "> 100").alias("v")).first()["v"] == "WARNING"
