"""Registered streaming queries (section 2.13). ``events`` is landed as five file groups
(``event_id % 5``) in a fresh folder and consumed with ``availableNow``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewatch.plans.common import AS_OF_EVENTS, query, t
from tablewatch.session import scratch_path
from tablewatch.streaming import stream as st

SCHEMA = st.EVENTS_SCHEMA


def _landed(spark, d, where=None):
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex}")
    e = t(spark, d, "events")
    if where is not None:
        e = e.where(where)
    st.split_to_files(e, f"{base}/source", F.col("event_id") % 5, 5)
    return base


@query("stream_incremental_count", "select count(*) as new_rows, 5 as batches from events")
def _incremental(spark, d):
    base = _landed(spark, d)
    per_batch = st.stream_incremental_count(spark, f"{base}/source", SCHEMA, f"{base}/sink", f"{base}/ckpt")
    return per_batch.agg(F.sum("new_rows").alias("new_rows"), F.countDistinct("batch_id").cast("int").alias("batches"))


ARRIVALS = 5
TESTS_SQL = """with b as (select *, cast(event_id % 5 as int) as batch_id from events),
v as (select batch_id, 'value_over_100' as test_name, count_if(value > 100) as violations from b group by 1
  union all select batch_id, 'unknown_type', count_if(event_type not in ('click', 'view', 'error', 'signup', 'purchase')) from b group by 1
  union all select batch_id, 'null_user', count_if(user_id is null) from b group by 1)
select *, case when violations > 0 then 'FAILED' else 'SUCCEEDED' end as verdict from v"""


@query("stream_dq", TESTS_SQL)
def _stream_dq(spark, d):
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex}")
    tests = {"value_over_100": F.col("value") > 100,
             "unknown_type": ~F.col("event_type").isin("click", "view", "error", "signup", "purchase"),
             "null_user": F.col("user_id").isNull()}
    e = t(spark, d, "events")
    for k in range(ARRIVALS):  # each arrival is a run, and a batch, of its own
        st.land(e.where(F.col("event_id") % ARRIVALS == k), f"{base}/source", f"arrival={k}")
        out = st.stream_dq(spark, f"{base}/source", SCHEMA, tests, f"{base}/sink", f"{base}/ckpt")
    return out.select(F.col("batch_id").cast("int").alias("batch_id"), "test_name", "violations", "verdict")


@query("stream_freshness", f"""
select max(ts) as max_ts, count(*) as rows,
  cast(floor(epoch(timestamp '{AS_OF_EVENTS}')) - floor(epoch(max(ts))) as bigint) as age_s,
  case when floor(epoch(timestamp '{AS_OF_EVENTS}')) - floor(epoch(max(ts))) > 259200 then 'error'
       when floor(epoch(timestamp '{AS_OF_EVENTS}')) - floor(epoch(max(ts))) > 86400 then 'warn' else 'pass' end as state
from events""")
def _stream_freshness(spark, d):
    base = _landed(spark, d)
    state = st.stream_freshness(spark, f"{base}/source", SCHEMA, "ts", f"{base}/sink", f"{base}/ckpt")
    return st.freshness_of(state, AS_OF_EVENTS)


@query("stream_cursor_drift", """
with s as (select cast(event_id % 5 as int) as batch_id, count(*) as n, max(ts) as mx from events group by 1),
d as (select cast(event_id % 5 as int) as batch_id, count(*) as n, max(ts) as mx from events where event_id % 97 <> 0 group by 1),
j as (select batch_id, coalesce(s.n, 0) as src_rows, coalesce(d.n, 0) as dst_rows, s.mx as src_max, d.mx as dst_max,
  least(max(s.mx) over w, max(d.mx) over w) as new_cursor
  from s full join d using (batch_id) window w as (order by batch_id rows between unbounded preceding and current row))
select batch_id, lag(new_cursor) over (order by batch_id) as cached_cursor, src_rows, dst_rows, dst_rows - src_rows as count_drift, src_max, dst_max,
  cast(floor(epoch(dst_max)) - floor(epoch(src_max)) as bigint) as max_drift_s,
  case when dst_rows <> src_rows then 'FAILED' else 'SUCCEEDED' end as count_verdict,
  case when abs(floor(epoch(dst_max)) - floor(epoch(src_max))) > 60 then 'FAILED' else 'SUCCEEDED' end as max_verdict, new_cursor
from j""")
def _stream_drift(spark, d):
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex}")
    e, out = t(spark, d, "events"), {}
    for k in range(ARRIVALS):
        part = e.where(F.col("event_id") % ARRIVALS == k)
        for side, df in (("src", part), ("dst", part.where(F.col("event_id") % 97 != 0))):  # the copy that lost some rows
            st.land(df, f"{base}/{side}/source", f"arrival={k}")
            out[side] = st.stream_side_totals(spark, f"{base}/{side}/source", SCHEMA, "ts", f"{base}/{side}/sink", f"{base}/{side}/ckpt")
    return st.cursor_drift(out["src"], out["dst"])


@query("ready_check", """
with c as (select 'orders_since_2001' as check_name,
             (select count(*) from (select 1 from orders where o_orderdate >= timestamp '2001-01-01 00:00:00' limit 1)) > 0 as passed
           union all select 'lineitem_shipped_late_2001',
             (select count(*) from (select 1 from lineitem where l_shipdate >= timestamp '2001-11-01 00:00:00' limit 1)) > 0
           union all select 'events_after_as_of',
             (select count(*) from (select 1 from events where ts > timestamp '2024-01-31 00:00:00' limit 1)) > 0)
select * from c union all select 'ALL', bool_and(passed) from c""")
def _ready(spark, d):
    checks = {
        "orders_since_2001": t(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")),
        "lineitem_shipped_late_2001": t(spark, d, "lineitem").where(
            F.col("l_shipdate") >= F.lit("2001-11-01").cast("timestamp_ntz")),
        "events_after_as_of": t(spark, d, "events").where(F.col("ts") > F.lit(AS_OF_EVENTS).cast("timestamp_ntz")),
    }
    return st.ready_check(checks)


@query("ready_timeout", """
select strftime(cast(ts as date), '%Y-%m-%d') as day,
  min(case when ts >= cast(cast(ts as date) as timestamp) + interval 6 hour
            and ts <= cast(cast(ts as date) as timestamp) + interval 6 hour + interval 20 minute then ts end) as first_arrival,
  min(case when ts >= cast(cast(ts as date) as timestamp) + interval 6 hour
            and ts <= cast(cast(ts as date) as timestamp) + interval 6 hour + interval 20 minute then ts end) is not null as ready
from events group by 1""")
def _ready_timeout(spark, d):
    return st.ready_timeout(t(spark, d, "events"), "ts", 6, 20)
