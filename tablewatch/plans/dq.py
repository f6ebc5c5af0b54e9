"""Registered data-quality test queries (section 2.4) on the planted-fault fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.operators import quality as q
from tablewatch.plans.common import AS_OF_EVENTS, AS_OF_LINEITEM, AS_OF_ORDERS, query, t

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("dq_not_null", "select * from orders_dirty where o_custkey is null")
def _not_null(spark, d):
    return q.dq_not_null(t(spark, d, "orders_dirty"), "o_custkey")


@query("dq_unique", "select o_orderkey, count(*) as n from orders_dirty group by o_orderkey having count(*) > 1")
def _unique(spark, d):
    return q.dq_unique(t(spark, d, "orders_dirty"), "o_orderkey")


@query("dq_unique_composite", """
select l_orderkey, l_linenumber, count(*) as n from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""")
def _unique_composite(spark, d):
    return q.dq_unique_composite(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_referential", """
select c.* from orders_dirty c
where c.o_custkey is not null and not exists (select 1 from customer p where p.c_custkey = c.o_custkey)""")
def _referential(spark, d):
    return q.dq_referential(t(spark, d, "orders_dirty"), t(spark, d, "customer"), "o_custkey", "c_custkey")


@query("dq_not_future", f"select * from orders_dirty where o_orderdate > timestamp '{AS_OF_ORDERS}'")
def _not_future(spark, d):
    return q.dq_not_future(t(spark, d, "orders_dirty"), "o_orderdate", AS_OF_ORDERS)


@query("dq_not_ancient", "select * from orders_dirty where year(o_orderdate) < 1950")
def _not_ancient(spark, d):
    return q.dq_not_ancient(t(spark, d, "orders_dirty"), "o_orderdate", 1950)


@query("dq_ts_order", """
select l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
where o.o_orderdate > l.l_shipdate""")
def _ts_order(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return q.dq_ts_order_across(li, o, "l_orderkey", "l_shipdate", "o_orderdate")


@query("dq_freshness", f"""
select max(l_shipdate) as max_ts from lineitem
having max(l_shipdate) < timestamp '{AS_OF_LINEITEM}' - interval 24 hour""")
def _freshness(spark, d):
    return q.dq_freshness(t(spark, d, "lineitem"), "l_shipdate", AS_OF_LINEITEM, 24)


@query("dq_older_than", f"select * from events where ts < timestamp '{AS_OF_EVENTS}' - interval 7 day")
def _older_than(spark, d):
    return q.dq_older_than(t(spark, d, "events"), "ts", AS_OF_EVENTS, 7)


@query("dq_hours_stale", f"""
select max(l_shipdate) as max_ts,
  cast(floor((epoch(timestamp '{AS_OF_LINEITEM}') - floor(epoch(max(l_shipdate)))) / 3600) as bigint) as hours_stale
from lineitem""")
def _hours_stale(spark, d):
    return q.dq_hours_stale(t(spark, d, "lineitem"), "l_shipdate", AS_OF_LINEITEM)


@query("dq_non_negative", "select * from orders_dirty where o_totalprice < 0")
def _non_negative(spark, d):
    return q.dq_non_negative(t(spark, d, "orders_dirty"), "o_totalprice")


@query("dq_range", "select * from orders_dirty where not (o_totalprice between 1000 and 400000)")
def _range(spark, d):
    return q.dq_range(t(spark, d, "orders_dirty"), "o_totalprice", 1000, 400000)


@query("dq_outlier_sigma", """
select * from orders_dirty
where abs(o_totalprice - (select avg(o_totalprice) from orders_dirty))
      > 3 * (select stddev_samp(o_totalprice) from orders_dirty)""")
def _outlier(spark, d):
    return q.dq_outlier_sigma(t(spark, d, "orders_dirty"), "o_totalprice", 3.0)


@query("dq_accepted_values", "select * from orders_dirty where o_orderstatus not in ('F', 'O', 'P')")
def _accepted(spark, d):
    return q.dq_accepted_values(t(spark, d, "orders_dirty"), "o_orderstatus", ["F", "O", "P"])


@query("dq_cardinality", """
select count(distinct o_orderpriority) as distinct_vals from orders_dirty
having not (count(distinct o_orderpriority) between 1 and 5)""")
def _cardinality(spark, d):
    return q.dq_cardinality(t(spark, d, "orders_dirty"), "o_orderpriority", 1, 5)


@query("dq_not_blank", "select * from orders_dirty where coalesce(trim(o_orderpriority), '') = ''")
def _not_blank(spark, d):
    return q.dq_not_blank(t(spark, d, "orders_dirty"), "o_orderpriority")


@query("dq_max_length", "select * from orders_dirty where length(o_orderpriority) > 15")
def _max_length(spark, d):
    return q.dq_max_length(t(spark, d, "orders_dirty"), "o_orderpriority", 15)


@query("dq_placeholder", """
select * from orders_dirty where lower(o_orderpriority) in ('n/a','na','null','none','test','-','unknown')""")
def _placeholder(spark, d):
    return q.dq_placeholder(t(spark, d, "orders_dirty"), "o_orderpriority")


@query("dq_stray_space", "select * from orders_dirty where o_orderpriority <> trim(o_orderpriority)")
def _stray(spark, d):
    return q.dq_stray_space(t(spark, d, "orders_dirty"), "o_orderpriority")


@query("dq_regex", "select * from orders_dirty where not regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')")
def _regex(spark, d):
    return q.dq_regex(t(spark, d, "orders_dirty"), "o_orderpriority", r"^[1-5]-[A-Z ]+$")


@query("dq_boolean_domain", """
with x as (select doc_id, quality, case when doc_id % 50 = 0 then 2 when doc_id % 50 = 1 then null else toxic end as toxic from labels)
select * from x where toxic is not null and toxic not in (0, 1)""")
def _boolean(spark, d):
    """Labels of which some hold a number that is no truth value, and some none."""
    k = F.col("doc_id") % 50
    labels = t(spark, d, "labels").select("doc_id", "quality", F.when(k == 0, 2).when(k != 1, F.col("toxic")).alias("toxic"))
    return q.dq_boolean_domain(labels, "toxic", numeric=True)


@query("dq_percent", "select * from events where not (value between 0 and 100)")
def _percent(spark, d):
    return q.dq_percent(t(spark, d, "events"), "value", 100)


@query("dq_geo", """
select c_custkey, c_acctbal / 100 as lat, c_acctbal / 50 as lon from customer
where not (c_acctbal / 100 between -90 and 90) or not (c_acctbal / 50 between -180 and 180)""")
def _geo(spark, d):
    c = t(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 100).alias("lat"),
                                       (F.col("c_acctbal") / 50).alias("lon"))
    return q.dq_geo(c, "lat", "lon")


@query("dq_not_empty", """
select 1 as empty_table from (select count(*) as n from orders_dirty) where n = 0
union all select 1 from (select count(*) as n from orders_dirty where o_orderstatus = 'Z') where n = 0""")
def _not_empty(spark, d):
    """A table with rows, and a part of it that has none."""
    o = t(spark, d, "orders_dirty")
    return q.dq_not_empty(o).unionByName(q.dq_not_empty(o.where(F.col("o_orderstatus") == "Z")))


@query("dq_volume_drop", """
with e as (select cast(ts as date) as day, count(*) as n from events where hour(ts) <> 3 and day(ts) % 11 <> 0 group by 1),
cal as (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from e),
d as (select day, coalesce(n, 0) as n from cal left join e using (day)),
h as (select day, n, avg(n) over (order by day rows between 7 preceding and 1 preceding) as hist_avg,
             count(n) over (order by day rows between 7 preceding and 1 preceding) as hist_days from d)
select cast(day as varchar) as day, n, cast(round(cast(hist_avg as decimal(18,6)), 2) as double) as hist_avg
from h where hist_days = 7 and n * 100 < hist_avg * 80""")
def _volume_drop(spark, d):
    # Every eleventh day of a month delivered nothing: a drop to zero.
    ev = t(spark, d, "events").where((F.hour("ts") != 3) & (F.dayofmonth("ts") % 11 != 0))
    out = q.dq_volume_drop(ev, "ts", 20, 7)
    return out.select(F.col("day").cast("string").alias("day"), "n", F.col("hist_avg").cast("double"))


@query("dq_row_sum", """
select l_orderkey, l_linenumber from (
  select l_orderkey, l_linenumber, l_extendedprice, l_tax,
    l_extendedprice + l_tax + case when l_orderkey % 83 = 0 then 1.0 else 0.0 end as total from lineitem)
where cast(total as decimal(18,2)) <> cast(l_extendedprice as decimal(18,2)) + cast(l_tax as decimal(18,2))""")
def _row_sum(spark, d):
    li = t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_tax",
        (F.col("l_extendedprice") + F.col("l_tax")
         + F.when(F.col("l_orderkey") % 83 == 0, 1.0).otherwise(0.0)).alias("total"))
    return q.dq_row_sum(li, "total", ["l_extendedprice", "l_tax"]).select("l_orderkey", "l_linenumber")


@query("dq_row_count_bounds", """
select count(*) as row_count, case when count(*) between 5000 and 200000 then 0 else 1 end as out_of_bounds
from lineitem""")
def _row_count_bounds(spark, d):
    return q.dq_row_count_bounds(t(spark, d, "lineitem"), 5000, 200000)


@query("dq_min_rows", "select count(*) as row_count, cast(count(*) < 5000 as integer) as below_min from orders")
def _min_rows(spark, d):
    return q.dq_min_rows(t(spark, d, "orders"), 5000)


@query("dq_null_rate", """
select count(*) as rows, count(*) - count(o_custkey) as nulls,
  case when count(*) = 0 then null else cast(floor((count(*) - count(o_custkey)) * 10000 / count(*)) as bigint) end as null_bp,
  (count(*) - count(o_custkey)) * 10000 > count(*) * 500 as over_tolerance
from orders_dirty""")
def _null_rate(spark, d):
    return q.dq_null_rate(t(spark, d, "orders_dirty"), "o_custkey", 500)


SCHEMA_SPEC = [
    {"name": "o_orderkey", "type": "bigint", "primary_key": True},
    {"name": "o_custkey", "type": "bigint", "nullable": False},
    {"name": "o_totalprice", "type": "decimal(18,2)"},
    {"name": "o_orderdate", "type": "timestamp_ntz", "nullable": False},
    {"name": "o_comment", "type": "string"},
]


@query("dq_schema_column", """
select * from (values ('o_orderkey', 'type', 0), ('o_custkey', 'type', 0), ('o_totalprice', 'type', 1),
                      ('o_orderdate', 'type', 0), ('o_comment', 'type', 1)) as v(column_name, rule, violations)
union all select 'o_orderkey', 'not_null', count_if(o_orderkey is null) from orders_dirty
union all select 'o_orderkey', 'unique', count(*) from
  (select o_orderkey from orders_dirty where o_orderkey is not null group by 1 having count(*) > 1)
union all select 'o_custkey', 'not_null', count_if(o_custkey is null) from orders_dirty
union all select 'o_orderdate', 'not_null', count_if(o_orderdate is null) from orders_dirty""")
def _schema_column(spark, d):
    return q.dq_schema_column(t(spark, d, "orders_dirty"), SCHEMA_SPEC)


@query("dq_anomaly", """
with e as (select cast(ts as date) as day, cast(count(*) as double) as metric from events group by 1),
cal as (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from e),
d as (select day, coalesce(metric, 0) as metric from cal left join e using (day)),
s as (select day, metric,
        avg(metric) over w as mu, stddev_samp(metric) over w as sd, count(metric) over w as k
      from d window w as (order by day rows between 14 preceding and 1 preceding))
select cast(day as varchar) as day, metric, cast(round(cast((metric - mu) / sd as decimal(18,6)), 3) as double) as z_score
from s where k >= 2 and sd > 0 and abs((metric - mu) / sd) > 2""")
def _anomaly(spark, d):
    out = q.dq_anomaly(t(spark, d, "events"), "ts", 14, 2.0)
    return out.select(F.col("day").cast("string").alias("day"), "metric", F.col("z_score").cast("double"))
