"""Run-metadata analytics over task runs, pipeline runs and logs.

Per-run and per-pipeline facts are grouped aggregates (``min_by``/``max_by``
instead of sorting whole groups). Ordered comparisons between consecutive
runs use the bucketed helpers in ``functions.windows`` so a pipeline with a
third of all runs is not processed by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.graph import Known, layers
from tablewatch.functions.timeutil import epoch_seconds, ts_lit
from tablewatch.functions.windows import RANGE, in_ranges, with_prev_running_max, with_prev_value

# Failure categories in priority order with their log signals
# (case-insensitive, RE2/Java-compatible). Earlier categories win when a
# message matches several; every match is also listed.
FAILURE_SIGNALS = [
    ("AUTH_FAILURE", r"(?i)((http|status|code|error)[^0-9a-z]{0,6}40[13]\b|^40[13]\b|unauthorized|forbidden|access denied|token expired|invalid credentials|"
                     r"authentication failed|could not assume role|insufficient permissions|request timed out)"),
    ("TIMEOUT", r"(?i)(timeout|timed out|deadline exceeded|execution time limit)"),
    ("NETWORK_ERROR", r"(?i)(connection refused|econnrefused|dns resolution failed|could not connect|"
                      r"network unreachable|host not found|request timed out)"),
    ("RESOURCE_CONFLICT", r"(?i)(already running|resource is busy|lock timeout|concurrent modification)"),
    ("DBT_COMPILATION", r"(?i)(compilation error)"),
    ("IMPORT_ERROR", r"(?i)(modulenotfounderror|importerror|no module named)"),
    ("SECRET_MISSING", r"(?i)(keyerror: '|os\.environ|environment variable not set)"),
    ("SCRIPT_ERROR", r"(?i)(traceback|nameerror|typeerror|valueerror|keyerror)"),
]
# Integrations that ingest by a vendor's own connectors, and what their failures say. Such a failure
# is mended in the vendor's tool whatever else the message names.
INGESTION = ("FIVETRAN", "AIRBYTE", "ESTUARY")
TOOL_SIGNAL = r"(?i)((sync|connector|replication)[^.]{0,40}(fail|error|broken|paused)|(fail|error)[^.]{0,40}(sync|connector|replication))"

# Routing table (category, integration or '*', writes or '*') -> handler, action.
ROUTES = [
    ("AUTH_FAILURE", "*", "*", "update_connection_credentials", "escalate"),
    ("TIMEOUT", "*", "no", "rerun_task", "auto_retry"),
    ("TIMEOUT", "*", "yes", "rerun_task", "confirm"),
    ("NETWORK_ERROR", "*", "*", "allow_network_path", "escalate"),
    ("RESOURCE_CONFLICT", "*", "*", "widen_schedule_interval", "auto_retry"),
    ("DBT_COMPILATION", "DBT_CORE", "*", "fix_model_code", "confirm"),
    ("IMPORT_ERROR", "PYTHON", "*", "fix_requirements", "confirm"),
    ("SECRET_MISSING", "*", "*", "add_secret", "escalate"),
    ("SCRIPT_ERROR", "PYTHON", "*", "fix_script", "confirm"),
    ("SCRIPT_ERROR", "*", "*", "investigate", "escalate"),
    ("TOOL_OR_INFRASTRUCTURE", "*", "*", "mend_in_vendor_tool", "escalate"),
    ("UNKNOWN", "*", "*", "investigate", "escalate"),
]

WRITING_INTEGRATIONS = ("SNOWFLAKE", "DBT_CORE")


def classify_failures(df: DataFrame, message_col: str = "message", integration_col: str | None = None) -> DataFrame:
    """Adds ``category`` (first matching signal, else UNKNOWN) and ``all_categories``.

    With ``integration_col``, sync and connector failures of ingestion integrations are
    TOOL_OR_INFRASTRUCTURE, before any other category."""
    msg = F.col(message_col)
    cat = F.lit("UNKNOWN")
    for name, pattern in reversed(FAILURE_SIGNALS):
        cat = F.when(msg.rlike(pattern), F.lit(name)).otherwise(cat)
    hits = [F.when(msg.rlike(p), F.lit(n)) for n, p in FAILURE_SIGNALS]
    if integration_col is not None:
        tool = F.upper(F.col(integration_col)).isin(*INGESTION) & msg.rlike(TOOL_SIGNAL)
        cat = F.when(tool, F.lit("TOOL_OR_INFRASTRUCTURE")).otherwise(cat)
        hits = [F.when(tool, F.lit("TOOL_OR_INFRASTRUCTURE")), *hits]
    hits = F.concat_ws(",", *hits)
    return df.withColumn("category", cat).withColumn("all_categories", hits)


def route_failures(classified: DataFrame, integration_col: str = "integration") -> DataFrame:
    """Category + integration + write effect -> handler and action (most specific rule wins).
    One conditional expression over the fixed rules: no join and no shuffle."""
    writes = F.when(F.col(integration_col).isin(*WRITING_INTEGRATIONS), "yes").otherwise("no")
    x = classified.withColumn("writes", writes)
    # Most specific rule first; rows stay as they are, repeated ones too.
    chosen = None
    for category, integration, needs, handler, action in sorted(ROUTES, key=lambda r: (r[1] == "*", r[2] == "*")):
        applies = F.col("category") == category
        if integration != "*":
            applies &= F.col(integration_col) == integration
        if needs != "*":
            applies &= F.col("writes") == needs
        route = F.struct(F.lit(handler).alias("handler"), F.lit(action).alias("action"))
        chosen = F.when(applies, route) if chosen is None else chosen.when(applies, route)
    return x.withColumn("__r", chosen).select(*x.columns, "__r.handler", "__r.action")


def first_failure(tasks: DataFrame, run_col="pipeline_run_id", ts_col="started_at", id_col="task_run_id",
                  status_col="status") -> DataFrame:
    """First FAILED task per run; later FAILED or SKIPPED tasks are counted as symptoms."""
    failed = F.col(status_col) == "FAILED"
    order = F.struct(F.col(ts_col), F.col(id_col))
    first = (tasks.where(failed).groupBy(run_col)
             .agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("failed_tasks")))
    later = tasks.where(F.col(status_col).isin("FAILED", "SKIPPED")).join(first, run_col).where(
        F.struct(F.col(ts_col), F.col(id_col)) > F.col("f"))
    symptoms = later.groupBy(run_col).agg(F.count(F.lit(1)).alias("symptoms"))
    return (first.join(symptoms, run_col, "left")
            .select(run_col, F.col(f"f.{id_col}").alias("first_failed_task"), F.col(f"f.{ts_col}").alias("failed_at"),
                    "failed_tasks", F.coalesce(F.col("symptoms"), F.lit(0)).alias("symptoms")))


def task_end(start: str = "started_at", duration_s: str = "duration_s") -> Column:
    """Start plus a duration in seconds, truncated to whole microseconds."""
    micros = F.floor(F.col(duration_s) * 1000000).cast("decimal(18,0)")
    return F.col(start) + F.make_dt_interval(secs=micros / 1000000)


def pipeline_runs(tasks: DataFrame) -> DataFrame:
    """One row per pipeline run: start, end, task counts and run status."""
    end = task_end()
    return (tasks.groupBy("pipeline_id", "pipeline_run_id", "branch")
            .agg(F.min("started_at").alias("run_start"), F.max(end).alias("run_end"),
                 F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("status") == "FAILED").alias("failed_tasks"),
                 F.count_if(F.col("status") == "SKIPPED").alias("skipped_tasks"))
            .withColumn("run_status", F.when(F.col("failed_tasks") > 0, "FAILED").otherwise("SUCCEEDED")))


def latest_failed(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Latest FAILED run per pipeline in the ``days`` before ``as_of`` — one line each (``max_by``); later runs are
    not known then."""
    recent = runs.where((F.col("run_status") == "FAILED") & (F.col("run_start") < ts_lit(as_of))
                        & (F.col("run_start") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")))
    g = recent.groupBy("pipeline_id").agg(F.max_by(F.struct("pipeline_run_id", "run_start", "failed_tasks"),
                                                   F.struct("run_start", "pipeline_run_id")).alias("r"),
                                          F.count(F.lit(1)).alias("failed_runs"))
    return g.select("pipeline_id", "r.pipeline_run_id", "r.run_start", "r.failed_tasks", "failed_runs")


def feature_branch_runs(tasks: DataFrame, main: str = "main") -> DataFrame:
    """Pipelines failing only on non-main branches while main is green."""
    on_main = F.col("branch") == main
    failed = F.col("status") == "FAILED"
    g = tasks.groupBy("pipeline_id").agg(F.count_if(failed & ~on_main).alias("branch_failures"),
                                         F.count_if(failed & on_main).alias("main_failures"),
                                         F.count_if(on_main).alias("main_tasks"))
    return (g.where(F.col("branch_failures") > 0)
            .withColumn("main_green", (F.col("main_failures") == 0) & (F.col("main_tasks") > 0))
            .withColumn("feature_only", F.col("main_failures") == 0))


def overlapping_runs(runs: DataFrame) -> DataFrame:
    """Runs that start before an earlier run of the same pipeline and branch has ended:
    the running max of earlier end times, swept over ranges of (pipeline, branch, start) with carried maxima,
    so a pipeline with all its runs on one day is split as well."""
    x = in_ranges(runs.withColumn("ord", F.struct("run_start", "pipeline_run_id")), ["pipeline_id", "branch", "run_start", "pipeline_run_id"])
    x = with_prev_running_max(x, ["pipeline_id", "branch"], "ord", "run_end", F.col(RANGE), "prev_max_end")
    return (x.where(F.col("run_start") < F.col("prev_max_end"))
            .select("pipeline_id", "branch", "pipeline_run_id", "run_start", "prev_max_end"))


def resource_conflict_rate(tasks: DataFrame) -> DataFrame:
    """Per pipeline: how often a task starts while the previous task is still running."""
    end = task_end()
    x = tasks.select("pipeline_id", "started_at", "task_run_id", end.alias("task_end")).withColumn("ord", F.struct("started_at", "task_run_id"))
    x = in_ranges(x, ["pipeline_id", "started_at", "task_run_id"])
    x = with_prev_value(x, ["pipeline_id"], "ord", "task_end", F.col(RANGE), "prev_end")
    g = x.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("tasks"),
                                     F.count_if(F.col("prev_end") > F.col("started_at")).alias("conflicts"))
    return g.withColumn("conflict_pct", (F.col("conflicts") * 100 / F.col("tasks")).cast("decimal(18,2)")
                        .cast("double"))


def near_timeout(tasks: DataFrame, timeout_s: int, near: float = 0.8, structural_share: int = 50) -> DataFrame:
    """Structural vs transient timeouts: share of runs within ``near`` of the limit."""
    close = F.col("duration_s") >= timeout_s * near
    g = tasks.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(close).alias("near_limit_runs"))
    share = (F.col("near_limit_runs") * 100 / F.col("runs"))
    kind = F.when(share >= structural_share, "structural").when(F.col("near_limit_runs") > 0, "transient") \
        .otherwise("none")
    return g.select("pipeline_id", "runs", "near_limit_runs", share.cast("decimal(18,2)").cast("double")
                    .alias("near_pct"), kind.alias("kind"))


def stale_assets(assets: DataFrame, ops: DataFrame, key: str, ts_col: str, as_of, days: int = 7) -> DataFrame:
    """Assets with no operation in ``days`` (or none ever): last operation per asset
    left-joined to the asset list."""
    last = ops.groupBy(key).agg(F.max(ts_col).alias("last_op"))
    j = assets.select(key).distinct().join(last, key, "left")
    age = F.floor((epoch_seconds(ts_lit(as_of)) - epoch_seconds("last_op")) / 86400).cast("bigint")
    return (j.where(F.col("last_op").isNull() | (F.col("last_op") < ts_lit(as_of) - F.expr(f"INTERVAL {days} DAYS")))
            .select(key, "last_op", age.alias("days_since")))


def idle_schedules(runs: DataFrame, min_runs: int = 20) -> DataFrame:
    """Pipelines whose runs often do no work (every task skipped)."""
    idle = F.col("skipped_tasks") == F.col("tasks")
    g = runs.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(idle).alias("idle_runs"))
    return g.where((F.col("runs") >= min_runs) & (F.col("idle_runs") > 0)).withColumn(
        "idle_pct", (F.col("idle_runs") * 100 / F.col("runs")).cast("decimal(18,2)").cast("double"))


def task_duration_totals(tasks: DataFrame) -> DataFrame:
    """Task count and total minutes by integration and ISO week."""
    return (tasks.groupBy("integration", F.date_trunc("week", "started_at").alias("week"))
            .agg(F.count(F.lit(1)).alias("tasks"),
                 (F.sum(F.col("duration_s").cast("decimal(18,2)")) / 60).cast("decimal(18,2)").cast("double")
                 .alias("total_minutes")))


def skip_rate(tasks: DataFrame, as_of, days: int = 7) -> DataFrame:
    recent = tasks.where((F.col("started_at") >= ts_lit(as_of) - F.expr(f"INTERVAL {days} DAYS"))
                         & (F.col("started_at") < ts_lit(as_of)))
    g = recent.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("tasks"),
                                          F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
                                          F.count_if(F.col("status") == "FAILED").alias("failed"))
    return g.withColumn("failure_pct", (F.col("failed") * 100 / F.col("tasks")).cast("decimal(18,2)").cast("double"))


def inventory_counts(inv: DataFrame) -> DataFrame:
    """Counts by storage provider, by paused flag and by cadence in one grouping-sets pass."""
    columns = [F.col(c) for c in ("provider", "paused", "cadence")]
    return inv.groupingSets([[c] for c in columns], *columns).agg(F.count(F.lit(1)).alias("n"))


def chain_depth(edges: DataFrame, min_depth: int = 2) -> DataFrame:
    """Nodes triggered through a chain longer than one level: longest path from any root. Nodes on
    or behind a cycle have no longest path; they are reported with a null depth."""
    return layers(edges).where(F.col("depth").isNull() | (F.col("depth") >= min_depth))


def test_failures(results: DataFrame, ts_col: str) -> DataFrame:
    """Failing tests from stored results arrays: explode, keep fail/error, count per test."""
    x = results.select(ts_col, F.explode("results").alias("r"))
    bad = x.where(F.col("r.status").isin("fail", "error"))
    return bad.groupBy(F.col("r.name").alias("test_name")).agg(F.count(F.lit(1)).alias("failures"),
                                                               F.max(ts_col).alias("last_failed_at"))


def upstream_walk(edges: DataFrame, symptoms: DataFrame, anomalies: DataFrame) -> DataFrame:
    """From each symptom node walk upstream one layer at a time; stop at the first layer
    that holds an anomaly and report those anomalous ancestors with their depth. A symptom's walk
    also ends when no new node is left, so cycles end and chains may be of any length."""
    rev = edges.select(F.col("child").alias("node"), F.col("parent").alias("up")).distinct().checkpoint(eager=True)
    anom = anomalies.select(F.col("node").alias("up")).distinct().withColumn("anomalous", F.lit(True)).checkpoint(eager=True)
    frontier = symptoms.select("symptom", F.col("symptom").alias("node")).distinct().checkpoint(eager=True)
    seen, depth = Known(frontier), 0
    found = Known(frontier.where(F.lit(False)).select("symptom", F.col("node").alias("anomaly_node"), F.lit(0).alias("depth")))
    while not frontier.isEmpty():
        depth += 1
        step = (frontier.join(rev, "node").select("symptom", F.col("up").alias("node")).distinct()
                .join(seen.rows, ["symptom", "node"], "left_anti")
                .join(anom.withColumnRenamed("up", "node"), "node", "left").checkpoint(eager=True))
        hit = step.where(F.col("anomalous")).select("symptom", F.col("node").alias("anomaly_node"), F.lit(depth).alias("depth"))
        found.add(hit)
        done = hit.select("symptom").distinct()
        frontier = (step.where(F.col("anomalous").isNull()).join(done, "symptom", "left_anti")
                    .select("symptom", "node").checkpoint(eager=True))
        seen.add(frontier)
    return found.rows


# Secret-shaped key names and token shapes. A name is one of the four words, alone or
# after a word that ends in an underscore or is itself a usual prefix ("monkey" is none); JSON keys
# have a quote before the colon.
SECRET_ASSIGN = (r"(?i)(?:^|[^a-z0-9_])((?:[a-z0-9_]*_|api|access|auth|private|secret|db)?(?:key|token|password|secret))"
                 r"[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9/+_\-]{8,}")
SECRET_SHAPES = [("aws_access_key", r"AKIA[0-9A-Z]{16}"), ("github_token", r"ghp_[A-Za-z0-9]{36}"),
                 ("private_key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----")]


def plain_secrets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Locations and names of literal secrets; the value never leaves the plan. One read of the
    text: a row's names are gathered in one array."""
    text = F.col(text_col)
    names = F.transform(F.regexp_extract_all(text, F.lit(SECRET_ASSIGN), 1), F.lower)
    shaped = [F.array_repeat(F.lit(name), F.regexp_count(text, F.lit(pattern))) for name, pattern in SECRET_SHAPES]
    found = df.select(id_col, F.explode(F.concat(names, *shaped)).alias("secret_name"))
    return found.groupBy(id_col, "secret_name").agg(F.count(F.lit(1)).alias("occurrences"))
