"""Graph walks run to their fixed point: long chains, cycles, and repeated rows of failures."""

import datetime as dt

from tablewatch.functions.graph import connected, least_below
from tablewatch.operators import runs
from tablewatch.operators.freshness import build_propagate

DEPTH = 66


def chain(spark, extra=()):
    return spark.createDataFrame([(i, i + 1) for i in range(DEPTH)] + list(extra), "parent long, child long")


def test_long_chain_and_cycle(spark):
    depth = {r["node"]: r["depth"] for r in runs.chain_depth(chain(spark), 2).collect()}
    assert depth == {i: i for i in range(2, DEPTH + 1)}
    loop = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (3, 4)], "parent long, child long")
    assert {r["node"]: r["depth"] for r in runs.chain_depth(loop, 0).collect()} == {1: 0, 2: None, 3: None, 4: None}


def test_upstream_walk_has_no_depth_limit(spark):
    symptoms = spark.createDataFrame([(DEPTH,)], "symptom long")
    first = spark.createDataFrame([(0,)], "node long")
    assert [tuple(r) for r in runs.upstream_walk(chain(spark), symptoms, first).collect()] == [(DEPTH, 0, DEPTH)]
    loop = spark.createDataFrame([(1, 2), (2, 1), (0, 1)], "parent long, child long")
    walk = runs.upstream_walk(loop, spark.createDataFrame([(2,)], "symptom long"), first)
    assert [tuple(r) for r in walk.collect()] == [(2, 0, 2)]
    assert runs.upstream_walk(loop, spark.createDataFrame([(2,)], "symptom long"), first.where("false")).collect() == []


def test_propagation_reaches_the_end(spark):
    old = dt.datetime(2020, 1, 1)
    sources = spark.createDataFrame([(1, 0, old)], "source_id long, model_id long, loaded_at timestamp_ntz")
    out = {r["model_id"]: r["depth"] for r in build_propagate(chain(spark, [(DEPTH, 30)]), sources, "2024-01-01 00:00:00").collect()}
    assert out == {i: i for i in range(DEPTH + 1)}


def test_connected_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(DEPTH)] + [(500, 501), (7, 7)], "a long, b long")
    out = {r["id"]: r["component_id"] for r in connected(links).collect()}
    assert out == {i: 0 for i in range(DEPTH + 1)} | {500: 500, 501: 500}


def test_equal_failures_stay_and_numbers_are_no_status_codes(spark):
    rows = [(1, "SNOWFLAKE", "deadline exceeded"), (1, "SNOWFLAKE", "deadline exceeded"), (2, "PYTHON", "row 240155 of load failed"),
            (3, "HTTP", "status 401 from server"), (4, "PYTHON", "NameError: x"), (5, "HTTP", "NameError: x")]
    df = spark.createDataFrame(rows, "task_run_id long, integration string, message string")
    out = sorted((r["task_run_id"], r["category"], r["handler"], r["action"]) for r in runs.route_failures(runs.classify_failures(df)).collect())
    assert out == [(1, "TIMEOUT", "rerun_task", "confirm")] * 2 + [
        (2, "UNKNOWN", "investigate", "escalate"), (3, "AUTH_FAILURE", "update_connection_credentials", "escalate"),
        (4, "SCRIPT_ERROR", "fix_script", "confirm"), (5, "SCRIPT_ERROR", "investigate", "escalate")]


def test_least_below(spark):
    """The strictest value climbs to all ancestors, over a cycle too."""
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (1, 4), (4, 5), (6, 5), (7, 8)], "parent long, child long")
    values = spark.createDataFrame([(3, 30), (5, 10), (4, 50), (5, 20), (8, None)], "node long, value long")
    got = {r["node"]: r["value"] for r in least_below(edges, values).collect()}
    assert got == {1: 10, 2: 30, 3: 30, 4: 10, 5: 10, 6: 10}
    assert least_below(edges, values.limit(0)).count() == 0
