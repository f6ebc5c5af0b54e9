"""Test suites: many tests, one scan per table, verdicts by threshold.

Row tests of one table are fused into a single aggregate of conditional counts
(``count_if(predicate)``), so a suite of k tests reads the table once instead of
k times. Tests that need a join or a group (unique, referential, outlier,
freshness) run as their own plans and are unioned in. Before fusing, every
test's columns are checked against the schema; a test that cannot run is
reported as ``skipped`` with what it needs, and the others still run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.thresholds import parse_threshold, severity_downgrade, verdict
from tablewatch.operators import quality as q


@dataclass
class TestSpec:
    name: str
    kind: str
    column: str | list | None = None
    params: dict = field(default_factory=dict)
    warn: str | None = "> 0"
    error: str | None = "> 0"
    treat_failure_as_warning: bool = False

    def columns(self) -> list[str]:
        cols = []
        if isinstance(self.column, str):
            cols.append(self.column)
        elif self.column:
            cols += list(self.column)
        for key in ("later", "lat", "lon", "total"):
            if key in self.params:
                cols.append(self.params[key])
        cols += list(self.params.get("parts", []))
        return cols


def _pred(spec: TestSpec, as_of) -> Column | None:
    """Row predicate for fusable kinds, else None."""
    c, p = spec.column, spec.params
    k = spec.kind
    if k == "not_null":
        return q.not_null_predicate(c)
    if k == "not_future":
        return q.not_future_predicate(c, as_of)
    if k == "not_ancient":
        return q.not_ancient_predicate(c, p.get("min_year", 2000))
    if k == "ts_order":
        return q.ts_order_predicate(c, p["later"])
    if k == "older_than":
        return q.older_than_predicate(c, as_of, p.get("days", 7))
    if k == "non_negative":
        return q.non_negative_predicate(c)
    if k == "range":
        return q.range_predicate(c, p["lo"], p["hi"])
    if k == "accepted_values":
        return q.accepted_values_predicate(c, p["values"])
    if k == "not_blank":
        return q.not_blank_predicate(c)
    if k == "max_length":
        return q.max_length_predicate(c, p["max_len"])
    if k == "placeholder":
        return q.placeholder_predicate(c)
    if k == "stray_space":
        return q.stray_space_predicate(c)
    if k == "regex":
        return q.regex_predicate(c, p.get("pattern", q.EMAIL_PATTERN))
    if k == "boolean_domain":
        return q.boolean_domain_predicate(c, p.get("numeric", False))
    if k == "percent":
        return q.percent_predicate(c, p.get("upper", 100))
    if k == "geo":
        return q.geo_predicate(p["lat"], p["lon"])
    if k == "row_sum":
        return q.row_sum_predicate(p["total"], p["parts"])
    return None


def _plan(spec: TestSpec, df: DataFrame, as_of, refs: dict[str, DataFrame]) -> DataFrame:
    """Violating-row plan for a test that cannot be fused into the scan."""
    c, p = spec.column, spec.params
    if spec.kind in ("unique", "unique_composite"):
        return q.dq_unique(df, c)
    if spec.kind == "referential":
        return q.dq_referential(df, refs[p["parent"]], c, p["pk"])
    if spec.kind == "outlier_sigma":
        return q.dq_outlier_sigma(df, c, p.get("k", 3.0))
    if spec.kind == "freshness":
        return q.dq_freshness(df, c, as_of, p["lag_hours"])
    if spec.kind == "not_empty":
        return q.dq_not_empty(df)
    raise ValueError(f"unknown test kind {spec.kind!r}")


def test_rows(spec: TestSpec, df: DataFrame, as_of, refs: dict | None = None) -> DataFrame:
    """Violating rows of one test (fused kinds become a filter)."""
    pred = _pred(spec, as_of)
    if pred is not None:
        return df.where(pred)
    return _plan(spec, df, as_of, refs or {})


def _verdict_case(tests: list[TestSpec], name_col: Column, value: Column) -> Column:
    out = F.lit(None).cast("string")
    for s in tests:
        v = verdict(value, s.warn, s.error)
        if s.treat_failure_as_warning:
            v = severity_downgrade(v, True)
        out = F.when(name_col == s.name, v).otherwise(out)
    return out


def suite_counts(df: DataFrame, tests: list[TestSpec], as_of, refs: dict | None = None) -> DataFrame:
    """(test_name, violations) for runnable tests: one fused agg + one plan per join/group test."""
    fused = [(s, _pred(s, as_of)) for s in tests]
    fusable = [(s, p) for s, p in fused if p is not None]
    parts = []
    if fusable:
        agg = df.agg(*[F.count_if(p).alias(f"c{i}") for i, (_, p) in enumerate(fusable)])
        stack = ", ".join(f"'{s.name}', c{i}" for i, (s, _) in enumerate(fusable))
        parts.append(agg.selectExpr(f"stack({len(fusable)}, {stack}) as (test_name, violations)"))
    for s, p in fused:
        if p is None:
            plan = _plan(s, df, as_of, refs or {})
            parts.append(plan.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(s.name).alias("test_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("test_name", F.col("violations").cast("bigint"))


def suite_run(df: DataFrame, tests: list[TestSpec], table_name: str, as_of,
              refs: dict | None = None) -> DataFrame:
    """Run every test; return (table_name, test_name, kind, column_name, violations, verdict, status, needs).

    Thresholds are validated up front (bad grammar raises before planning).
    A test whose columns or reference tables are missing is ``skipped`` and
    listed with what it needs; it does not abort the rest.
    """
    spark = df.sparkSession
    refs = refs or {}
    for s in tests:
        for expr in (s.warn, s.error):
            if expr is not None:
                parse_threshold(expr)
    present = set(df.columns)
    runnable, skipped = [], []
    for s in tests:
        missing = [c for c in s.columns() if c not in present]
        if s.kind == "referential" and s.params.get("parent") not in refs:
            missing.append(f"table:{s.params.get('parent')}")
        (skipped if missing else runnable).append((s, missing))
    meta_rows = [(s.name, s.kind, ",".join(s.columns()), ",".join(m)) for s, m in runnable + skipped]
    meta = spark.createDataFrame(meta_rows, "test_name string, kind string, column_name string, needs string")
    run_tests = [s for s, _ in runnable]
    if run_tests:
        counts = suite_counts(df, run_tests, as_of, refs)
    else:
        counts = spark.createDataFrame([], "test_name string, violations bigint")
    # Both sides hold one row per test (bounded by the spec, not the data).
    joined = meta.join(counts, "test_name", "left")
    status = F.when(F.col("violations").isNull(), F.lit("skipped")).otherwise(F.lit("ran"))
    return joined.select(
        F.lit(table_name).alias("table_name"), "test_name", "kind", "column_name", "violations",
        F.when(F.col("violations").isNull(), F.lit("SKIPPED"))
        .otherwise(_verdict_case(run_tests, F.col("test_name"), F.col("violations"))).alias("verdict"),
        status.alias("status"), F.when(status == "skipped", F.col("needs")).alias("needs"))


def suite_matrix(targets: dict[str, DataFrame], kind: str, columns: dict[str, list[str]], as_of,
                 params: dict | None = None, warn: str | None = "> 0", error: str | None = "> 0") -> DataFrame:
    """One test shape fanned over many (table, column) targets; one fused scan per table."""
    out = None
    for table_name, cols in columns.items():
        specs = [TestSpec(f"{kind}:{table_name}.{c}", kind, c, dict(params or {}), warn, error) for c in cols]
        counts = suite_counts(targets[table_name], specs, as_of)
        part = counts.select(
            F.lit(kind).alias("kind"), F.lit(table_name).alias("table_name"),
            F.element_at(F.split(F.col("test_name"), r"\."), -1).alias("column_name"),
            "violations", verdict(F.col("violations"), warn, error).alias("verdict"))
        out = part if out is None else out.unionByName(part)
    return out


def violation_sample(df: DataFrame, tests: list[TestSpec], order_by: list[str], as_of,
                     key_cols: list[str] | None = None, limit: int = 100, refs: dict | None = None) -> DataFrame:
    """Up to ``limit`` example rows per test next to the full violation count.

    The count comes from the fused aggregate (before any limit). All row tests take their examples from
    one more read: each row is listed once for every test it fails. The sample is ``row_number() <= limit``
    per test: Spark plans it as a WindowGroupLimit that keeps at most ``limit`` rows per test in every task
    before the shuffle, so no test's rows are gathered into one task.
    """
    key_cols = key_cols or order_by
    names = [F.when(p, F.lit(s.name)) for s in tests if (p := _pred(s, as_of)) is not None]
    parts = df.select(*key_cols, F.explode(F.array_compact(F.array(*names))).alias("test_name")) if names else None
    for s in tests:
        if _pred(s, as_of) is None:
            rows = _plan(s, df, as_of, refs or {}).select(*key_cols).withColumn("test_name", F.lit(s.name))
            parts = rows if parts is None else parts.unionByName(rows)
    w = Window.partitionBy("test_name").orderBy(*order_by)
    sample = parts.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= limit)
    counts = suite_counts(df, tests, as_of, refs).withColumnRenamed("violations", "violations_total")
    return sample.join(F.broadcast(counts), "test_name", "inner")


def gate_groups(task_status: DataFrame, group_col: str, status_col: str,
                terminal=("SUCCEEDED", "FAILED", "SKIPPED", "WARNING", "CANCELLED")) -> DataFrame:
    """Group status aggregation: a dependent test group runs once every upstream task
    *completed* (any terminal status, failures included)."""
    done = F.col(status_col).isin(list(terminal))
    return (task_status.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("n_tasks"),
                 F.bool_and(done).alias("all_completed"),
                 F.bool_and(F.col(status_col) == "SUCCEEDED").alias("all_succeeded"),
                 F.bool_or(F.col(status_col) == "FAILED").alias("any_failed"))
            .withColumn("run_dependents", F.col("all_completed")))


def threshold_suggest(profile: DataFrame) -> DataFrame:
    """Error threshold per column from a profile: tolerated nulls -> that count, else ``> 0``."""
    return profile.select(
        "column_name", "nulls",
        F.when(F.col("nulls") > 0, F.concat(F.lit("> "), F.col("nulls").cast("string")))
        .otherwise(F.lit("> 0")).alias("error_threshold"))
