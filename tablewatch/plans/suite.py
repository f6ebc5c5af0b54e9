"""Registered suite, threshold and verdict queries (section 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.functions.thresholds import severity_downgrade, threshold_eval, verdict
from tablewatch.functions.timeutil import ts_lit
from tablewatch.operators import suite as s
from tablewatch.plans.common import AS_OF_ORDERS, query, t

ORDERS_SUITE = [
    s.TestSpec("nn_custkey", "not_null", "o_custkey", warn="> 0", error="> 100"),
    s.TestSpec("status_values", "accepted_values", "o_orderstatus", {"values": ["F", "O", "P"]},
               warn="> 0", error="> 200"),
    s.TestSpec("price_non_negative", "non_negative", "o_totalprice"),
    s.TestSpec("date_not_future", "not_future", "o_orderdate"),
    s.TestSpec("priority_placeholder", "placeholder", "o_orderpriority", warn="> 0", error=">= 500"),
    s.TestSpec("key_unique", "unique", "o_orderkey"),
    s.TestSpec("cust_fk", "referential", "o_custkey", {"parent": "customer", "pk": "c_custkey"},
               treat_failure_as_warning=True),
    s.TestSpec("comment_not_blank", "not_blank", "o_comment"),
    s.TestSpec("price_range", "range", "o_totalprice", {"lo": 1000, "hi": 400000}, warn="> 5000", error="> 10000"),
]

SUITE_COUNTS_SQL = f"""
select 'nn_custkey' as test_name, count_if(o_custkey is null) as violations from orders_dirty
union all select 'status_values', count_if(o_orderstatus not in ('F','O','P')) from orders_dirty
union all select 'price_non_negative', count_if(o_totalprice < 0) from orders_dirty
union all select 'date_not_future', count_if(o_orderdate > timestamp '{AS_OF_ORDERS}') from orders_dirty
union all select 'priority_placeholder',
  count_if(lower(o_orderpriority) in ('n/a','na','null','none','test','-','unknown')) from orders_dirty
union all select 'key_unique', count(*) from (select o_orderkey from orders_dirty group by 1 having count(*) > 1)
union all select 'cust_fk', count(*) from orders_dirty o
  where o_custkey is not null and not exists (select 1 from customer c where c.c_custkey = o.o_custkey)
union all select 'price_range', count_if(not (o_totalprice between 1000 and 400000)) from orders_dirty"""


@query("suite_run", f"""
with c as ({SUITE_COUNTS_SQL}),
m as (select * from (values
  ('nn_custkey', 'not_null', 'o_custkey', ''), ('status_values', 'accepted_values', 'o_orderstatus', ''),
  ('price_non_negative', 'non_negative', 'o_totalprice', ''), ('date_not_future', 'not_future', 'o_orderdate', ''),
  ('priority_placeholder', 'placeholder', 'o_orderpriority', ''), ('key_unique', 'unique', 'o_orderkey', ''),
  ('cust_fk', 'referential', 'o_custkey', ''), ('comment_not_blank', 'not_blank', 'o_comment', 'o_comment'),
  ('price_range', 'range', 'o_totalprice', '')) as v(test_name, kind, column_name, needs))
select 'orders_dirty' as table_name, m.test_name, m.kind, m.column_name, c.violations,
  case when c.violations is null then 'SKIPPED'
       when m.test_name = 'nn_custkey' then case when c.violations > 100 then 'FAILED' when c.violations > 0 then 'WARNING' else 'SUCCEEDED' end
       when m.test_name = 'status_values' then case when c.violations > 200 then 'FAILED' when c.violations > 0 then 'WARNING' else 'SUCCEEDED' end
       when m.test_name = 'priority_placeholder' then case when c.violations >= 500 then 'FAILED' when c.violations > 0 then 'WARNING' else 'SUCCEEDED' end
       when m.test_name = 'cust_fk' then case when c.violations > 0 then 'WARNING' else 'SUCCEEDED' end
       when m.test_name = 'price_range' then case when c.violations > 10000 then 'FAILED' when c.violations > 5000 then 'WARNING' else 'SUCCEEDED' end
       else case when c.violations > 0 then 'FAILED' else 'SUCCEEDED' end end as verdict,
  case when c.violations is null then 'skipped' else 'ran' end as status,
  case when c.violations is null then m.needs end as needs
from m left join c using (test_name)""")
def _suite_run(spark, d):
    return s.suite_run(t(spark, d, "orders_dirty"), ORDERS_SUITE, "orders_dirty", AS_OF_ORDERS,
                       refs={"customer": t(spark, d, "customer")})


@query("threshold_eval", """
with d as (select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1)
select day, n, n > 340 as gt_340, n >= 345 as ge_345, n < 330 as lt_330, n <= 330 as le_330,
  n = 333 as eq_333, n != 0 as ne_0 from d""")
def _threshold_eval(spark, d):
    daily = (t(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
             .agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    return daily.select("day", "n", threshold_eval(n, "> 340").alias("gt_340"),
                        threshold_eval(n, ">=345").alias("ge_345"), threshold_eval(n, "< 330").alias("lt_330"),
                        threshold_eval(n, "<= 330").alias("le_330"), threshold_eval(n, "= 333").alias("eq_333"),
                        threshold_eval(n, "!= 0").alias("ne_0"))


@query("suite_verdict", """
select strftime(started_at, '%Y-%m-%d') as day, count_if(status = 'FAILED') as failed,
  case when count_if(status = 'FAILED') > 75 then 'FAILED' when count_if(status = 'FAILED') > 60 then 'WARNING'
       else 'SUCCEEDED' end as verdict
from task_runs group by 1""")
def _suite_verdict(spark, d):
    daily = (t(spark, d, "task_runs").groupBy(F.date_format("started_at", "yyyy-MM-dd").alias("day"))
             .agg(F.count_if(F.col("status") == "FAILED").alias("failed")))
    return daily.select("day", "failed", verdict(F.col("failed"), "> 60", "> 75").alias("verdict"))


@query("suite_matrix", """
select 'not_null' as kind, 'orders_dirty' as table_name, 'o_orderkey' as column_name, count_if(o_orderkey is null) as violations from orders_dirty
union all select 'not_null', 'orders_dirty', 'o_custkey', count_if(o_custkey is null) from orders_dirty
union all select 'not_null', 'orders_dirty', 'o_orderpriority', count_if(o_orderpriority is null) from orders_dirty
union all select 'not_null', 'orders_dst', 'o_orderpriority', count_if(o_orderpriority is null) from orders_dst
union all select 'not_null', 'orders_dst', 'o_custkey', count_if(o_custkey is null) from orders_dst
union all select 'not_null', 'lineitem', 'l_shipdate', count_if(l_shipdate is null) from lineitem""")
def _suite_matrix(spark, d):
    out = s.suite_matrix(
        {"orders_dirty": t(spark, d, "orders_dirty"), "orders_dst": t(spark, d, "orders_dst"),
         "lineitem": t(spark, d, "lineitem")},
        "not_null", {"orders_dirty": ["o_orderkey", "o_custkey", "o_orderpriority"],
                     "orders_dst": ["o_orderpriority", "o_custkey"], "lineitem": ["l_shipdate"]},
        AS_OF_ORDERS)
    return out.drop("verdict")


@query("severity_downgrade", f"""
with c as ({SUITE_COUNTS_SQL})
select test_name, violations,
  case when violations > 0 and test_name in ('price_non_negative', 'key_unique') then 'WARNING'
       when violations > 0 then 'FAILED' else 'SUCCEEDED' end as verdict
from c""")
def _severity_downgrade(spark, d):
    specs = [x for x in ORDERS_SUITE if x.name != "comment_not_blank"]
    counts = s.suite_counts(t(spark, d, "orders_dirty"), specs, AS_OF_ORDERS,
                            refs={"customer": t(spark, d, "customer")})
    downgrade = F.col("test_name").isin("price_non_negative", "key_unique")
    return counts.select("test_name", "violations",
                         severity_downgrade(verdict(F.col("violations")), downgrade).alias("verdict"))


SAMPLE_TESTS = [
    s.TestSpec("nn_custkey", "not_null", "o_custkey"),
    s.TestSpec("status_values", "accepted_values", "o_orderstatus", {"values": ["F", "O", "P"]}),
    s.TestSpec("price_non_negative", "non_negative", "o_totalprice"),
    s.TestSpec("priority_placeholder", "placeholder", "o_orderpriority"),
    s.TestSpec("price_range", "range", "o_totalprice", {"lo": 1000, "hi": 400000}),
]


@query("violation_sample", """
with v as (
  select 'nn_custkey' as test_name, o_orderkey from orders_dirty where o_custkey is null
  union all select 'status_values', o_orderkey from orders_dirty where o_orderstatus not in ('F','O','P')
  union all select 'price_non_negative', o_orderkey from orders_dirty where o_totalprice < 0
  union all select 'priority_placeholder', o_orderkey from orders_dirty
    where lower(o_orderpriority) in ('n/a','na','null','none','test','-','unknown')
  union all select 'price_range', o_orderkey from orders_dirty where not (o_totalprice between 1000 and 400000)),
r as (select test_name, o_orderkey, cast(row_number() over (partition by test_name order by o_orderkey) as integer) as sample_rank from v),
c as (select test_name, count(*) as violations_total from v group by 1)
select r.test_name, r.o_orderkey, r.sample_rank, c.violations_total from r join c using (test_name)
where sample_rank <= 100""")
def _violation_sample(spark, d):
    return s.violation_sample(t(spark, d, "orders_dirty"), SAMPLE_TESTS, ["o_orderkey"], AS_OF_ORDERS)


GATE_AS_OF = "2024-01-15 12:00:00"


@query("gate_groups", f"""
with st as (
  select pipeline_run_id,
    case when started_at + to_microseconds(cast(floor(duration_s * 1000000) as bigint)) > timestamp '{GATE_AS_OF}'
         then 'RUNNING' else status end as status
  from task_runs where started_at <= timestamp '{GATE_AS_OF}')
select pipeline_run_id, count(*) as n_tasks,
  bool_and(status in ('SUCCEEDED','FAILED','SKIPPED','WARNING','CANCELLED')) as all_completed,
  bool_and(status = 'SUCCEEDED') as all_succeeded, bool_or(status = 'FAILED') as any_failed,
  bool_and(status in ('SUCCEEDED','FAILED','SKIPPED','WARNING','CANCELLED')) as run_dependents
from st group by 1""")
def _gate_groups(spark, d):
    tr = t(spark, d, "task_runs").where(F.col("started_at") <= ts_lit(GATE_AS_OF))
    end = F.col("started_at") + F.make_dt_interval(
        secs=(F.col("duration_s") * 1000000).cast("bigint").cast("decimal(18,0)") / 1000000)
    st = tr.select("pipeline_run_id",
                   F.when(end > ts_lit(GATE_AS_OF), F.lit("RUNNING")).otherwise(F.col("status")).alias("status"))
    return s.gate_groups(st, "pipeline_run_id", "status")
