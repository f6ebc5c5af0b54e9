"""Profiles, samples and run analytics: exact results, no row copies, hot keys split."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tablewatch.functions.windows import RANGE, in_ranges
from tablewatch.operators import freshness, nested, profile, runs, suite
from tablewatch.sources import files
from tablewatch.streaming import stream
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_are_exact(spark):
    """Heavy ties, nulls, one value, no value: the interpolated ranks of the sorted values."""
    rng = random.Random(2)
    cols = {"a": [rng.gauss(0, 5) for _ in range(1000)], "b": [rng.choice([1.0, 1.0, 1.0, 7.5]) for _ in range(1000)],
            "c": [float(i) if i % 3 else None for i in range(1000)], "d": [None] * 999 + [4.0], "e": [None] * 1000}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(6)
    got = {r["i"]: r["q"] for r in profile.exact_quantiles(df, list(cols), (0.0, 0.01, 0.5, 0.993, 1.0)).collect()}
    for i, v in enumerate(cols.values()):
        v = [x for x in v if x is not None]
        assert (i in got) == bool(v)
        if v:
            assert np.allclose(got[i], np.quantile(v, [0.0, 0.01, 0.5, 0.993, 1.0])), i
    rows = {r["column_name"]: r for r in profile.profile_numeric(df, list(cols)).collect()}
    assert rows["e"]["p50"] is None and rows["d"]["p50"] == 4.0 and set(rows) == set(cols)


def test_no_buffer_of_all_values(spark):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = plan(profile.profile_numeric(df, ["l_quantity", "l_tax"]))
    assert "percentile(" not in text and "ObjectHashAggregate" not in text
    assert "Expand" not in plan(profile.profile_columns(df))


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, "x", 0.0, [1]), (1, "y", -0.0, [1]), (None, None, 2.5, None), (3, "x", None, [2])],
                               "k int, s string, d double, a array<int>")
    got = {r["column_name"]: (r["rows"], r["non_null"], r["nulls"], r["distinct_vals"], r["min_val"]) for r in profile.profile_columns(df).collect()}
    assert got == {"k": (4, 3, 1, 2, "1"), "s": (4, 3, 1, 2, "x"), "d": (4, 3, 1, 2, got["d"][4]), "a": (4, 3, 1, 2, "[1]")}
    assert {r["column_name"]: r["nulls"] for r in profile.null_profile(df).collect()} == {c: 1 for c in "ksda"}
    empty = {r["column_name"]: (r["rows"], r["distinct_vals"], r["null_pct"]) for r in profile.profile_columns(df.limit(0)).collect()}
    assert empty == {c: (0, 0, None) for c in "ksda"}


def test_type_does_not_change_as_data_grows(spark):
    """200 values that come 50 times each, and as often again: a category both times; near-unique text never is."""
    def kinds(n):
        df = spark.range(n).select(F.concat(F.lit("v"), (F.col("id") % (n // 50)).cast("string")).alias("status"),
                                   F.concat(F.lit("t"), (F.col("id") % (n // 2)).cast("string")).alias("note"))
        return {r["column_name"]: r["semantic_type"] for r in profile.classify_columns(profile.profile_columns(df)).collect()}

    assert kinds(1_000) == kinds(10_000) == {"status": "category", "note": "free_text"}


def test_sample_reads_the_table_twice(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    tests = [suite.TestSpec(f"t{i}", "range", "o_totalprice", {"lo": 1000 * i, "hi": 100_000}) for i in range(8)]
    out = suite.violation_sample(df, tests, ["o_orderkey"], "2024-01-01", limit=5)
    assert plan(out).count("FileScan") <= 2
    rows = out.collect()
    for i in range(8):
        bad = sorted(r["o_orderkey"] for r in df.where(~F.col("o_totalprice").between(1000 * i, 100_000)).collect())
        mine = [r for r in rows if r["test_name"] == f"t{i}"]
        assert sorted(r["o_orderkey"] for r in mine) == bad[:5] and all(r["violations_total"] == len(bad) for r in mine)


def test_one_pipeline_on_one_day(spark):
    """All runs of one pipeline on one day: split into ranges (small ones are not merged here), equal to brute force."""
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        _one_pipeline(spark)
    finally:
        spark.conf.set(merge, "true")


def _one_pipeline(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        s = start + dt.timedelta(seconds=rng.randrange(80_000))
        rows.append((1 if i % 10 else 2, "main", i, s, s + dt.timedelta(seconds=rng.choice([1, 5, 30, 4000]))))
    df = spark.createDataFrame(rows, "pipeline_id long, branch string, pipeline_run_id long, run_start timestamp_ntz, run_end timestamp_ntz")
    got = {r["pipeline_run_id"]: r["prev_max_end"] for r in runs.overlapping_runs(df).collect()}
    want = {}
    for p in (1, 2):
        most = None
        for _, _, i, s, e in sorted((r for r in rows if r[0] == p), key=lambda r: (r[3], r[2])):
            if most is not None and s < most:
                want[i] = most
            most = e if most is None else max(most, e)
    assert got == want
    sizes = [r["count"] for r in in_ranges(df, ["pipeline_id", "run_start"]).groupBy(RANGE).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 1000
    tasks = df.select("pipeline_id", F.col("pipeline_run_id").alias("task_run_id"), F.col("run_start").alias("started_at"),
                      (F.unix_timestamp(F.col("run_end").cast("timestamp")) - F.unix_timestamp(F.col("run_start").cast("timestamp"))).cast("double").alias("duration_s"))
    rate = {r["pipeline_id"]: (r["tasks"], r["conflicts"]) for r in runs.resource_conflict_rate(tasks).collect()}
    for p in (1, 2):
        mine = sorted(((s, i, e) for q, _, i, s, e in rows if q == p))
        assert rate[p] == (len(mine), sum(a[2] > b[0] for a, b in zip(mine, mine[1:])))


def test_latest_failed_knows_nothing_later(spark):
    rows = [(1, 10, dt.datetime(2024, 1, 1), 1, "FAILED"), (1, 11, dt.datetime(2024, 3, 1), 2, "FAILED"), (2, 12, dt.datetime(2024, 1, 2), 1, "FAILED")]
    df = spark.createDataFrame(rows, "pipeline_id long, pipeline_run_id long, run_start timestamp_ntz, failed_tasks long, run_status string")
    got = [(r["pipeline_id"], r["pipeline_run_id"], r["failed_runs"]) for r in runs.latest_failed(df, "2024-01-02 00:00:00").collect()]
    assert got == [(1, 10, 1)]


def test_failure_categories(spark):
    rows = [("row 401 of table loaded", "PYTHON", "UNKNOWN"), ("HTTP 401", "HTTP", "AUTH_FAILURE"), ("status code: 403", "HTTP", "AUTH_FAILURE"),
            ("401 Client Error", "HTTP", "AUTH_FAILURE"), ("Sync failed: token expired", "FIVETRAN", "TOOL_OR_INFRASTRUCTURE"),
            ("Sync failed: token expired", "PYTHON", "AUTH_FAILURE"), ("error in connector 7", "airbyte", "TOOL_OR_INFRASTRUCTURE"),
            ("rows synced", "FIVETRAN", "UNKNOWN"), (None, "FIVETRAN", "UNKNOWN"), ("Traceback", None, "SCRIPT_ERROR")]
    df = spark.createDataFrame([r[:2] for r in rows], "message string, integration string")
    out = runs.route_failures(runs.classify_failures(df, integration_col="integration"))
    assert sorted(((r["message"], r["integration"], r["category"]) for r in out.collect()), key=str) == sorted(rows, key=str)
    assert {r["handler"] for r in out.where("category = 'TOOL_OR_INFRASTRUCTURE'").collect()} == {"mend_in_vendor_tool"}


def test_dotted_paths_and_missing_names(spark):
    docs = [('{"items": [{"id": "a", "meta": {"kind": {"v": 1}}}, {"id": "b", "meta": {"kind": {"v": 1}}, "need": null}]}',),
            ('{"items": [{"id": "a", "meta": {"kind": {"v": 1}}, "need": 3}, {"meta": null}]}',), ('{"items": []}',), ("not json",), (None,)]
    df = nested.parse_docs(spark.createDataFrame(docs, "doc string"), "struct<items:array<struct<id:string, meta:struct<kind:struct<v:int>>>>>")
    items = F.col("p.items")
    got = df.select(nested.every_item(items, "meta.kind.v", 1).alias("all"), nested.some_item(items, "meta.kind.v", 1).alias("any"),
                    nested.children_without("doc", "$.items", "need", "id").alias("lost")).collect()
    assert [(r["all"], r["any"], r["lost"]) for r in got] == [
        (True, True, ["a"]), (False, True, ["1"]), (False, False, []), (False, False, []), (False, False, [])]


def test_regex_minimum(spark):
    df = spark.createDataFrame([("Foo foo FOO",), ("foo",), (None,)], "t string")
    got = [tuple(r) for r in df.select(nested.regex_count("t", "foo"), nested.regex_count("t", "foo", True), nested.regex_at_least("t", "foo", 2),
                                       nested.regex_at_least("t", "foo", 2, True)).collect()]
    assert got == [(1, 3, False, True), (1, 1, False, False), (None, None, False, False)]


def test_file_facts_open_no_file(spark, tmp_path):
    spark.range(10).withColumn("day", F.concat(F.lit("d"), F.col("id") % 3)).write.partitionBy("day").parquet(f"{tmp_path}/t")
    listed = files.listed_files(spark, f"{tmp_path}/t")
    assert "content" not in plan(listed).split("ReadSchema")[1] and all(not r["path"].rsplit("/", 1)[1].startswith("_") for r in listed.collect())
    due = spark.createDataFrame([("d0",), ("d2",), ("d7",)], "day string")
    got = {r["day"]: (r["arrived"], r["bytes"] > 0) for r in files.day_arrivals(spark, f"{tmp_path}/t", "day", due).collect()}
    assert got == {"d0": (True, True), "d2": (True, True), "d7": (False, False)}
    facts = freshness.freshness_metadata(spark, {"t": f"{tmp_path}/t", "t0": f"{tmp_path}/t/day=d0"}).collect()
    assert {r["table_name"] for r in facts} == {"t", "t0"} and all(r["files"] > 0 and r["last_modified"] for r in facts)


def test_batches_have_a_verdict_of_their_own(spark, tmp_path):
    """Each run is a batch; a batch without a side fails, the cursor stays with the slower side."""
    def rows(*v):
        return spark.createDataFrame([(x, dt.datetime(2024, 1, x)) for x in v], "id long, ts timestamp_ntz")

    schema = "id long, ts timestamp_ntz"
    out = {}
    for k, (src, dst) in enumerate([((1, 2), (1, 2)), ((3, 4), (3,)), ((5,), (5, 5))]):
        for side, v in (("src", src), ("dst", dst)):
            stream.land(rows(*v), f"{tmp_path}/{side}/in", f"a{k}")
            out[side] = stream.stream_side_totals(spark, f"{tmp_path}/{side}/in", schema, "ts", f"{tmp_path}/{side}/out", f"{tmp_path}/{side}/ckpt")
        dq = stream.stream_dq(spark, f"{tmp_path}/src/in", schema, {"big": F.col("id") > 2}, f"{tmp_path}/dq", f"{tmp_path}/dq_ckpt")
    drift = [(r["batch_id"], r["count_drift"], r["count_verdict"], r["max_verdict"], r["cached_cursor"] and r["cached_cursor"].day, r["new_cursor"].day)
             for r in stream.cursor_drift(out["src"], out["dst"]).orderBy("batch_id").collect()]
    assert drift == [(0, 0, "SUCCEEDED", "SUCCEEDED", None, 2), (1, -1, "FAILED", "FAILED", 2, 3), (2, 1, "FAILED", "SUCCEEDED", 3, 5)]
    assert [(r["violations"], r["verdict"]) for r in dq.orderBy("batch_id").collect()] == [(0, "SUCCEEDED"), (2, "FAILED"), (1, "FAILED")]
