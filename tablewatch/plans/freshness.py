"""Registered freshness and rebuild-gating queries (section 2.7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewatch.operators import freshness as fr
from tablewatch.plans.common import AS_OF_EVENTS, AS_OF_LINEITEM, query, t
from tablewatch.sources.catalog import schema_catalog_many
from tablewatch.session import scratch_path
from tablewatch.sources.fixtures import BASE_TABLES, FIXTURE_SQL

A = AS_OF_EVENTS


def _state_sql(max_expr: str, as_of: str = A, warn_s: int = 86400, error_s: int = 259200) -> str:
    age = f"(floor(epoch(timestamp '{as_of}')) - floor(epoch({max_expr})))"
    return (f"cast({age} as bigint) as age_s, case when {max_expr} is null then 'error' when {age} > {error_s} "
            f"then 'error' when {age} > {warn_s} then 'warn' else 'pass' end as state")


@query("source_freshness", f"""
select user_id, max(ts) as max_loaded_at, timestamp '{A}' as snapshotted_at, {_state_sql('max(ts)')}
from events group by user_id""")
def _source(spark, d):
    return fr.source_freshness(t(spark, d, "events"), ["user_id"], "ts", A)


@query("freshness_filter", f"""
select user_id, max(ts) as max_loaded_at, timestamp '{A}' as snapshotted_at, {_state_sql('max(ts)')}
from events where event_type <> 'error' group by user_id""")
def _filter(spark, d):
    return fr.freshness_filter(t(spark, d, "events"), ["user_id"], "ts", A, F.col("event_type") != "error")


@query("freshness_bounded", f"""
select max(l_shipdate) as max_loaded_at, {_state_sql('max(l_shipdate)', AS_OF_LINEITEM)},
  case when max(l_shipdate) is null then 'no_rows' end as reason
from lineitem where l_shipdate >= timestamp '{AS_OF_LINEITEM}' - interval 60 day
  and l_shipdate <= timestamp '{AS_OF_LINEITEM}'""")
def _bounded(spark, d):
    return fr.freshness_bounded(t(spark, d, "lineitem"), "l_shipdate", AS_OF_LINEITEM, 60)


@query("freshness_metadata", f"""
select concat('events of ', strftime(ts, '%Y-%m-%d')) as table_name, true as landed, true as fresh from events where ts < timestamp '2024-01-08 00:00:00' group by 1""")
def _metadata(spark, d):
    """The first week of events, landed by day: every day's files are newer than the start of the landing."""
    base = scratch_path(spark, f"days/{uuid.uuid4().hex}")
    begun = spark.sql("select date_trunc('SECOND', current_timestamp()) as at").first()["at"]
    week = t(spark, d, "events").where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    week.write.partitionBy("day").parquet(base)
    days = sorted(r["day"] for r in week.select("day").distinct().collect())  # seven at most
    facts = fr.freshness_metadata(spark, {f"events of {x}": f"{base}/day={x}" for x in days})
    return facts.select("table_name", (F.col("files") > 0).alias("landed"), (F.col("last_modified") >= F.lit(begun)).alias("fresh"))


def _inherit_frames(spark, d):
    users = t(spark, d, "events").select("user_id").distinct()
    sources = users.select("user_id", F.lit(24).alias("s_warn_hours"), F.lit(72).alias("s_error_hours"))
    u = F.col("user_id")
    tables = users.where((u % 3 == 0) | (u % 7 == 0)).select(
        "user_id", F.when(u % 3 == 0, F.lit(12)).alias("t_warn_hours"),
        F.lit(None).cast("int").alias("t_error_hours"), (u % 7 == 0).alias("t_disabled"))
    return sources, tables


@query("freshness_inherit", """
with u as (select distinct user_id from events)
select user_id,
  case when user_id % 7 = 0 then null when user_id % 3 = 0 then 12 else 24 end as warn_hours,
  case when user_id % 7 = 0 then null else 72 end as error_hours,
  user_id % 7 <> 0 as enabled
from u""")
def _inherit(spark, d):
    return fr.freshness_inherit(*_inherit_frames(spark, d), "user_id")


PICKED = [*BASE_TABLES, "model_sources", "task_runs", "access_log", "clusters"]
PICKED_COLUMNS = "\nunion all ".join(
    f"select '{n}' as table_name, column_name from (describe {FIXTURE_SQL.get(n, 'select * from ' + n)})" for n in PICKED)
RANKS_SQL = ", ".join(f"('{n}', {i + 1})" for i, n in enumerate(fr.LOADED_AT_NAMES))


@query("pick_loaded_at", f"""
with c as ({PICKED_COLUMNS}),
hit as (select c.table_name, arg_min(c.column_name, r.rank) as loaded_at_column, min(r.rank) >= 8 as weak
        from c join (values {RANKS_SQL}) as r(name, rank) on lower(c.column_name) = r.name group by 1)
select t.table_name, loaded_at_column, weak from (select distinct table_name from c) t left join hit using (table_name)""")
def _pick(spark, d):
    frames = {n: t(spark, d, n) for n in PICKED}
    return fr.pick_loaded_at(schema_catalog_many(frames, spark))


TZ_SQL = ("case when user_id % 3 = 1 then ts - interval 2 hour when user_id % 3 = 2 then ts + interval 5 hour "
          "else ts end")


@query("tz_to_utc", f"""
select user_id, max({TZ_SQL}) as max_loaded_at, timestamp '{A}' as snapshotted_at, {_state_sql(f'max({TZ_SQL})')}
from events group by user_id""")
def _tz(spark, d):
    e = t(spark, d, "events").withColumn(
        "tz", F.when(F.col("user_id") % 3 == 1, "+02:00").when(F.col("user_id") % 3 == 2, "-05:00").otherwise("UTC"))
    return fr.source_freshness(fr.tz_to_utc(e, "ts", "tz"), ["user_id"], "ts_utc", A)


BUILT_SQL = "timestamp '2024-01-30 00:00:00' + to_hours(model_id % 48)"


def _models(spark, d):
    e = t(spark, d, "model_edges")
    ids = e.select(F.col("child").alias("model_id")).union(e.select(F.col("parent").alias("model_id"))).distinct()
    return ids.select("model_id", (F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
                                   + F.make_dt_interval(hours=(F.col("model_id") % 48).cast("int")))
                      .alias("last_built_at"))


@query("build_gate", f"""
with ids as (select child as model_id from model_edges union select parent from model_edges),
m as (select model_id, {BUILT_SQL} as last_built_at from ids),
up as (select e.child as model_id, p.last_built_at as upstream_at from model_edges e join m p on p.model_id = e.parent
       union all select model_id, loaded_at from model_sources),
g as (select m.model_id, m.last_built_at, bool_or(up.upstream_at > m.last_built_at) as any_fresh,
        bool_and(up.upstream_at > m.last_built_at) as all_fresh
      from up join m using (model_id) group by 1, 2)
select model_id, epoch(timestamp '{A}') - epoch(last_built_at) >= 43200 as elapsed, any_fresh, all_fresh,
  (epoch(timestamp '{A}') - epoch(last_built_at) >= 43200) and any_fresh as rebuild
from g""")
def _gate(spark, d):
    models = _models(spark, d)
    e = t(spark, d, "model_edges")
    up = (e.join(models.withColumnRenamed("model_id", "parent"), "parent")
          .select(F.col("child").alias("model_id"), F.col("last_built_at").alias("upstream_at"))
          .unionByName(t(spark, d, "model_sources").select("model_id", F.col("loaded_at").alias("upstream_at"))))
    return fr.build_gate(models, up, A, 12, "hour", "any")


EXPECT_SQL = "select child as model_id, cast((child % 48 + 1) * 3600 as bigint) as expected_s from (select distinct child from model_edges) where child % 7 = 0"


@query("build_propagate", f"""
with recursive r(node, depth) as (
  select distinct model_id, 0 from model_sources where loaded_at < timestamp '{A}' - interval 24 hour
  union
  select e.child, r.depth + 1 from r join model_edges e on e.parent = r.node),
x(node, expected_s) as ({EXPECT_SQL} union select e.parent, x.expected_s from x join model_edges e on e.child = x.node),
down as (select node, min(depth) as depth from r group by 1),
up as (select node, min(expected_s) as expected_s from x group by 1)
select coalesce(down.node, up.node) as model_id, depth, expected_s from down full join up on down.node = up.node""")
def _propagate(spark, d):
    e = t(spark, d, "model_edges")
    expected = (e.select(F.col("child").alias("model_id")).distinct().where("model_id % 7 = 0")
                .withColumn("expected_s", ((F.col("model_id") % 48 + 1) * 3600).cast("bigint")))
    return fr.build_propagate(e, t(spark, d, "model_sources"), A, 24, expected)


@query("usage_reads", f"""
select o.name as table_name, count(*) as reads
from (select unnest(objects_accessed) as o from access_log
      where event_time >= timestamp '{A}' - interval 7 day and event_time < timestamp '{A}')
group by 1""")
def _reads(spark, d):
    return fr.usage_reads(t(spark, d, "access_log"), A, 7)


@query("usage_sla", f"""
with x as (select unnest(objects_accessed).name as table_name, event_time from access_log
           where event_time >= timestamp '{A}' - interval 30 day and event_time < timestamp '{A}'),
g as (select table_name, count(*) as reads, min(event_time) as first_read, max(event_time) as last_read from x group by 1),
h as (select *, case when reads > 1 then cast(floor((epoch(last_read) - epoch(first_read)) / (reads - 1)) as bigint) end
        as mean_gap_s from g)
select *, case when mean_gap_s is null then 'none' when mean_gap_s <= 3600 then 'hourly'
               when mean_gap_s <= 86400 then 'daily' else 'weekly' end as proposed_sla from h""")
def _sla(spark, d):
    return fr.usage_sla(t(spark, d, "access_log"), A, 30)
