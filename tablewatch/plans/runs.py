"""Registered run-metadata queries (section 2.9) on task runs derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.operators import runs as r
from tablewatch.plans.common import AS_OF_EVENTS, AS_OF_LINEITEM, query, t

A = AS_OF_EVENTS
END = "started_at + to_microseconds(cast(floor(duration_s * 1000000) as bigint))"
RUNS_SQL = f"""runs as (select pipeline_id, pipeline_run_id, branch, min(started_at) as run_start, max({END}) as run_end,
  count(*) as tasks, count_if(status = 'FAILED') as failed_tasks, count_if(status = 'SKIPPED') as skipped_tasks,
  case when count_if(status = 'FAILED') > 0 then 'FAILED' else 'SUCCEEDED' end as run_status
  from task_runs group by 1, 2, 3)"""

CASES = [(n, p.replace("'", "''")) for n, p in r.FAILURE_SIGNALS]
# Every fourth task is taken to be a vendor's connector, whose messages say so.
INGESTED_SQL = "(select * replace (case when integration = 'HTTP' then 'FIVETRAN' else integration end as integration, case when integration = 'HTTP' and event_kind then concat('connector sync failed: ', message) else message end as message) from (select *, task_run_id % 8 = 3 as event_kind from task_runs))"
TOOL_SQL = f"(upper(integration) in {r.INGESTION} and regexp_matches(message, '{r.TOOL_SIGNAL}'))"
CAT_SQL = f"case when {TOOL_SQL} then 'TOOL_OR_INFRASTRUCTURE' " + " ".join(f"when regexp_matches(message, '{p}') then '{n}'" for n, p in CASES) + " else 'UNKNOWN' end"
ALL_SQL = f"concat_ws(',', case when {TOOL_SQL} then 'TOOL_OR_INFRASTRUCTURE' end, " + ", ".join(f"case when regexp_matches(message, '{p}') then '{n}' end" for n, p in CASES) + ")"


def _tasks(spark, d):
    return t(spark, d, "task_runs")


@query("classify_failures", f"""
select task_run_id, message, {CAT_SQL} as category, {ALL_SQL} as all_categories
from {INGESTED_SQL} where status = 'FAILED'""")
def _classify(spark, d):
    tr = _ingested(spark, d).where(F.col("status") == "FAILED").select("task_run_id", "message", "integration")
    return r.classify_failures(tr, integration_col="integration").drop("integration")


def _ingested(spark, d):
    http = F.col("integration") == "HTTP"
    message = F.when(http & (F.col("task_run_id") % 8 == 3), F.concat(F.lit("connector sync failed: "), "message")).otherwise(F.col("message"))
    return _tasks(spark, d).withColumns({"message": message, "integration": F.when(http, "FIVETRAN").otherwise(F.col("integration"))})


ROUTES_SQL = ", ".join(f"('{a}', '{b}', '{c}', '{h}', '{x}')" for a, b, c, h, x in r.ROUTES)


@query("route_failures", f"""
with c as (select task_run_id, integration, {CAT_SQL} as category,
             case when integration in ('SNOWFLAKE', 'DBT_CORE') then 'yes' else 'no' end as writes
           from {INGESTED_SQL} where status = 'FAILED'),
rules as (select * from (values {ROUTES_SQL}) as v(r_category, r_integration, r_writes, handler, action)),
j as (select c.*, rules.handler, rules.action,
        (case when r_integration <> '*' then 2 else 0 end) + (case when r_writes <> '*' then 1 else 0 end) as spec
      from c left join rules on c.category = rules.r_category
        and (r_integration = '*' or r_integration = c.integration) and (r_writes = '*' or r_writes = c.writes))
select task_run_id, integration, category, writes, arg_max(handler, spec) as handler, arg_max(action, spec) as action
from j group by 1, 2, 3, 4""")
def _route(spark, d):
    tr = _ingested(spark, d).where(F.col("status") == "FAILED").select("task_run_id", "integration", "message")
    return r.route_failures(r.classify_failures(tr, integration_col="integration")).drop("message", "all_categories")


@query("first_failure", """
with f as (select pipeline_run_id, min({'s': started_at, 'i': task_run_id}) as f, count(*) as failed_tasks
           from task_runs where status = 'FAILED' group by 1),
s as (select t.pipeline_run_id, count(*) as symptoms from task_runs t join f using (pipeline_run_id)
      where t.status in ('FAILED', 'SKIPPED') and {'s': t.started_at, 'i': t.task_run_id} > f.f group by 1)
select pipeline_run_id, f.f.i as first_failed_task, f.f.s as failed_at, failed_tasks, coalesce(symptoms, 0) as symptoms
from f left join s using (pipeline_run_id)""")
def _first(spark, d):
    return r.first_failure(_tasks(spark, d))


@query("latest_failed", f"""with {RUNS_SQL}
select pipeline_id, arg_max(pipeline_run_id, {{'s': run_start, 'r': pipeline_run_id}}) as pipeline_run_id,
  max(run_start) as run_start, arg_max(failed_tasks, {{'s': run_start, 'r': pipeline_run_id}}) as failed_tasks,
  count(*) as failed_runs
from runs where run_status = 'FAILED' and run_start < timestamp '{A}' and run_start >= timestamp '{A}' - interval 7 day group by 1""")
def _latest(spark, d):
    return r.latest_failed(r.pipeline_runs(_tasks(spark, d)), A, 7)


@query("feature_branch_runs", """
with g as (
  select pipeline_id, count_if(status = 'FAILED' and branch <> 'main') as branch_failures,
    count_if(status = 'FAILED' and branch = 'main') as main_failures, count_if(branch = 'main') as main_tasks
  from task_runs where not (pipeline_id % 10 = 0 and branch = 'main' and status = 'FAILED')
    and not (pipeline_id % 20 = 0 and branch = 'main') group by 1)
select *, main_failures = 0 and main_tasks > 0 as main_green, main_failures = 0 as feature_only
from g where branch_failures > 0""")
def _feature(spark, d):
    """Every tenth pipeline is green on main, every twentieth never ran there."""
    on_main, p = F.col("branch") == "main", F.col("pipeline_id")
    tasks = _tasks(spark, d).where(~((p % 10 == 0) & on_main & (F.col("status") == "FAILED")) & ~((p % 20 == 0) & on_main))
    return r.feature_branch_runs(tasks)


@query("overlapping_runs", f"""with {RUNS_SQL},
x as (select *, max(run_end) over (partition by pipeline_id, branch order by run_start, pipeline_run_id
                                   rows between unbounded preceding and 1 preceding) as prev_max_end from runs)
select pipeline_id, branch, pipeline_run_id, run_start, prev_max_end from x where run_start < prev_max_end""")
def _overlap(spark, d):
    return r.overlapping_runs(r.pipeline_runs(_tasks(spark, d)))


@query("resource_conflict_rate", f"""
with x as (select pipeline_id, started_at,
             lag({END}) over (partition by pipeline_id order by started_at, task_run_id) as prev_end from task_runs)
select pipeline_id, count(*) as tasks, count_if(prev_end > started_at) as conflicts,
  cast(cast(count_if(prev_end > started_at) * 100 / count(*) as decimal(18,2)) as double) as conflict_pct
from x group by 1""")
def _conflict(spark, d):
    return r.resource_conflict_rate(_tasks(spark, d))


@query("near_timeout", """
select pipeline_id, count(*) as runs, count_if(duration_s >= 28800 * 0.8) as near_limit_runs,
  cast(cast(count_if(duration_s >= 28800 * 0.8) * 100 / count(*) as decimal(18,2)) as double) as near_pct,
  case when count_if(duration_s >= 28800 * 0.8) * 100 / count(*) >= 50 then 'structural'
       when count_if(duration_s >= 28800 * 0.8) > 0 then 'transient' else 'none' end as kind
from task_runs group by 1""")
def _near(spark, d):
    return r.near_timeout(_tasks(spark, d), 28800, 0.8, 50)


@query("stale_assets", f"""
with last as (select l_partkey as table_id, max(l_shipdate) as last_op from lineitem group by 1)
select p.p_partkey as table_id, last.last_op,
  cast(floor((epoch(timestamp '{AS_OF_LINEITEM}') - epoch(last.last_op)) / 86400) as bigint) as days_since
from part p left join last on p.p_partkey = last.table_id
where last.last_op is null or last.last_op < timestamp '{AS_OF_LINEITEM}' - interval 7 day""")
def _stale(spark, d):
    assets = t(spark, d, "part").select(F.col("p_partkey").alias("table_id"))
    ops = t(spark, d, "lineitem").select(F.col("l_partkey").alias("table_id"), "l_shipdate")
    return r.stale_assets(assets, ops, "table_id", "l_shipdate", AS_OF_LINEITEM, 7)


@query("idle_schedules", f"""with {RUNS_SQL}
select pipeline_id, count(*) as runs, count_if(skipped_tasks = tasks) as idle_runs,
  cast(cast(count_if(skipped_tasks = tasks) * 100 / count(*) as decimal(18,2)) as double) as idle_pct
from runs group by 1 having count(*) >= 20 and count_if(skipped_tasks = tasks) > 0""")
def _idle(spark, d):
    return r.idle_schedules(r.pipeline_runs(_tasks(spark, d)), 20)


@query("task_duration_totals", """
select integration, date_trunc('week', started_at) as week, count(*) as tasks,
  cast(cast(sum(cast(duration_s as decimal(18,2))) / 60 as decimal(18,2)) as double) as total_minutes
from task_runs group by 1, 2""")
def _durations(spark, d):
    return r.task_duration_totals(_tasks(spark, d))


@query("skip_rate", f"""
select pipeline_id, count(*) as tasks, count_if(status = 'SKIPPED') as skipped, count_if(status = 'FAILED') as failed,
  cast(cast(count_if(status = 'FAILED') * 100 / count(*) as decimal(18,2)) as double) as failure_pct
from task_runs where started_at >= timestamp '{A}' - interval 7 day and started_at < timestamp '{A}' group by 1""")
def _skip(spark, d):
    return r.skip_rate(_tasks(spark, d), A, 7)


@query("inventory_counts", """
select c_mktsegment as provider, c_acctbal < 0 as paused,
  case c_nationkey % 3 when 0 then 'hourly' when 1 then 'daily' else 'weekly' end as cadence, count(*) as n
from customer group by grouping sets ((provider), (paused), (cadence))""")
def _inventory(spark, d):
    c = t(spark, d, "customer")
    inv = c.select(F.col("c_mktsegment").alias("provider"), (F.col("c_acctbal") < 0).alias("paused"),
                   F.when(F.col("c_nationkey") % 3 == 0, "hourly").when(F.col("c_nationkey") % 3 == 1, "daily")
                   .otherwise("weekly").alias("cadence"))
    return r.inventory_counts(inv)


@query("chain_depth", """
with recursive r(node, depth) as (
  select distinct parent, 0 from model_edges where parent not in (select child from model_edges)
  union
  select e.child, r.depth + 1 from r join model_edges e on e.parent = r.node)
select node, max(depth) as depth from r group by 1 having max(depth) >= 2""")
def _chain(spark, d):
    return r.chain_depth(t(spark, d, "model_edges"), 2)


RESULTS_SQL = """select started_at, [{'name': 'unique_order_id', 'status': case when task_run_id % 3 = 0 then 'fail' else 'pass' end},
  {'name': 'not_null_customer', 'status': case when task_run_id % 5 = 0 then 'fail' else 'pass' end},
  {'name': 'accepted_status', 'status': case when status = 'FAILED' then 'error' else 'pass' end}] as results
from task_runs where integration = 'DBT_CORE'"""


@query("test_failures", f"""
select r.name as test_name, count(*) as failures, max(started_at) as last_failed_at
from (select started_at, unnest(results) as r from ({RESULTS_SQL}))
where r.status in ('fail', 'error') group by 1""")
def _tests(spark, d):
    tr = _tasks(spark, d).where(F.col("integration") == "DBT_CORE")
    k = F.col("task_run_id")

    def res(name, status):
        return F.struct(F.lit(name).alias("name"), status.alias("status"))
    results = tr.select("started_at", F.array(
        res("unique_order_id", F.when(k % 3 == 0, "fail").otherwise("pass")),
        res("not_null_customer", F.when(k % 5 == 0, "fail").otherwise("pass")),
        res("accepted_status", F.when(F.col("status") == "FAILED", "error").otherwise("pass"))).alias("results"))
    return r.test_failures(results, "started_at")


@query("upstream_walk", """
with recursive w(symptom, node, depth) as (
  select child, parent, 1 from model_edges where child % 48 = 0
  union
  select w.symptom, e.parent, w.depth + 1 from w join model_edges e on e.child = w.node),
a as (select * from w where node % 48 between 1 and 3),
m as (select symptom, min(depth) as d from a group by 1)
select distinct a.symptom, a.node as anomaly_node, a.depth from a join m on a.symptom = m.symptom and a.depth = m.d""")
def _walk(spark, d):
    e = t(spark, d, "model_edges")
    nodes = e.select(F.col("child").alias("node")).union(e.select(F.col("parent").alias("node"))).distinct()
    symptoms = e.select(F.col("child").alias("symptom")).where(F.col("symptom") % 48 == 0).distinct()
    anomalies = nodes.where((F.col("node") % 48).between(1, 3))
    return r.upstream_walk(e, symptoms, anomalies)


SECRET_SQL = r.SECRET_ASSIGN.replace("'", "''")
SHAPES_SQL = "\nunion all ".join(
    f"select doc_id, '{n}' as secret_name from (select doc_id, unnest(regexp_extract_all(text, '({p})', 1)) as v "
    f"from documents)" for n, p in r.SECRET_SHAPES)


@query("plain_secrets", f"""
with hits as (
  select doc_id, lower(v) as secret_name from (
    select doc_id, unnest(regexp_extract_all(text, '{SECRET_SQL}', 1)) as v from documents)
  union all {SHAPES_SQL})
select doc_id, secret_name, count(*) as occurrences from hits group by 1, 2""")
def _secrets(spark, d):
    return r.plain_secrets(t(spark, d, "documents"), "doc_id", "text")
