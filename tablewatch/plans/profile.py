"""Registered profiling queries (section 2.3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tablewatch.operators import profile as pr
from tablewatch.operators.suite import threshold_suggest
from tablewatch.plans.common import AS_OF_ORDERS, query, t

# (table, [(column, spark type name)]) profiled by the registered queries.
ORDERS_DIRTY_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
CLASSIFY_TABLES = {
    "orders_dirty": ORDERS_DIRTY_COLS,
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
}


def _profile_sql(table: str, cols) -> str:
    parts = []
    for c, dtype in cols:
        parts.append(
            f"select '{table}' as table_name, '{c}' as column_name, '{dtype}' as data_type, count(*) as rows, "
            f"count({c}) as non_null, count(*) - count({c}) as nulls, "
            f"case when count(*) = 0 then null else cast(((count(*) - count({c})) * 2000 + count(*)) // "
            f"(count(*) * 2) as double) / 10 end as null_pct, count(distinct {c}) as distinct_vals, "
            f"cast(min({c}) as varchar) as min_val, cast(max({c}) as varchar) as max_val from {table}")
    return "\nunion all ".join(parts)


CLASSIFY_CASE = """case when data_type = 'boolean' then 'boolean'
  when regexp_matches(data_type, '^(timestamp|date)') then 'timestamp'
  when regexp_matches(column_name, '(?i)(^id$|_id$|key$)') and distinct_vals = non_null and nulls = 0 then 'id'
  when regexp_matches(column_name, '(?i)(^id$|_id$|key$)') then 'foreign_key'
  when regexp_matches(column_name, '(?i)e_?mail') then 'email'
  when regexp_matches(column_name, '(?i)(^|_)(lat|lon|lng|latitude|longitude)$') then 'geo'
  when regexp_matches(column_name, '(?i)(pct|percent|ratio|rate)$') then 'percent'
  when regexp_matches(data_type, '^(tinyint|smallint|int|bigint|float|double|decimal)') and distinct_vals <= 2
       and min_val = '0' and max_val = '1' then 'boolean'
  when regexp_matches(data_type, '^(tinyint|smallint|int|bigint|float|double|decimal)') then 'measure'
  when distinct_vals * 10 <= non_null then 'category'
  else 'free_text' end"""

ALL_PROFILE_SQL = "\nunion all ".join(_profile_sql(tb, cols) for tb, cols in CLASSIFY_TABLES.items())


def _classified(spark, d):
    parts = []
    for tb in CLASSIFY_TABLES:
        prof = pr.profile_columns(t(spark, d, tb))
        parts.append(pr.classify_columns(prof).withColumn("table_name", F.lit(tb)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("profile_columns", f"select * exclude (table_name) from ({_profile_sql('orders_dirty', ORDERS_DIRTY_COLS)})")
def _profile_columns(spark, d):
    return pr.profile_columns(t(spark, d, "orders_dirty"))


@query("profile_timestamps", f"""
select 'o_orderdate' as column_name, count_if(o_orderdate > timestamp '{AS_OF_ORDERS}') as future_vals,
  count_if(year(o_orderdate) < 2000) as ancient_vals from orders_dirty""")
def _profile_timestamps(spark, d):
    return pr.profile_timestamps(t(spark, d, "orders_dirty"), AS_OF_ORDERS, 2000)


def _strings_sql(table, cols):
    return "\nunion all ".join(
        f"select '{c}' as column_name, cast(min(length({c})) as bigint) as min_len, "
        f"case when count({c}) = 0 then null else cast((sum(length({c})) * 200 + count({c})) // (count({c}) * 2) "
        f"as double) / 100 end as avg_len, cast(max(length({c})) as bigint) as max_len, "
        f"count_if(coalesce(trim({c}), '') = '') as blanks from {table}" for c in cols)


@query("profile_strings", _strings_sql("orders_dirty", ["o_orderstatus", "o_orderpriority"]))
def _profile_strings(spark, d):
    return pr.profile_strings(t(spark, d, "orders_dirty"))


NUMERIC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("profile_numeric", "\nunion all ".join(
    f"select '{c}' as column_name, cast(cast(avg({c}) as decimal(24,4)) as double) as avg_val, "
    f"cast(cast(stddev_samp({c}) as decimal(24,4)) as double) as stddev_val, "
    f"cast(cast(quantile_cont({c}, 0.01) as decimal(24,4)) as double) as p01, "
    f"cast(cast(quantile_cont({c}, 0.5) as decimal(24,4)) as double) as p50, "
    f"cast(cast(quantile_cont({c}, 0.99) as decimal(24,4)) as double) as p99 from lineitem" for c in NUMERIC_COLS))
def _profile_numeric(spark, d):
    return pr.profile_numeric(t(spark, d, "lineitem"), NUMERIC_COLS)


@query("sample_distinct", """
select 'o_orderpriority' as column_name, value from (
  select distinct cast(o_orderpriority as varchar) as value from orders_dirty where o_orderpriority is not null
  order by value limit 50)""")
def _sample_distinct(spark, d):
    return pr.sample_distinct(t(spark, d, "orders_dirty"), "o_orderpriority", 50)


@query("classify_columns", f"""
select table_name, column_name, data_type, {CLASSIFY_CASE} as semantic_type from ({ALL_PROFILE_SQL})""")
def _classify(spark, d):
    return _classified(spark, d)


_RULES_SQL = ", ".join(f"('{a}', '{b}')" for a, b in pr.SUGGESTED_TESTS)


@query("suggest_tests", f"""
with c as (select table_name, column_name, {CLASSIFY_CASE} as semantic_type from ({ALL_PROFILE_SQL})),
r as (select * from (values {_RULES_SQL}) as v(semantic_type, test_kind))
select c.table_name, c.column_name, c.semantic_type, r.test_kind from c join r using (semantic_type)""")
def _suggest(spark, d):
    parts = []
    for tb in CLASSIFY_TABLES:
        cl = pr.classify_columns(pr.profile_columns(t(spark, d, tb)))
        parts.append(pr.suggest_tests(cl).withColumn("table_name", F.lit(tb)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("threshold_suggest", f"""
select column_name, nulls, case when nulls > 0 then concat('> ', cast(nulls as varchar)) else '> 0' end as error_threshold
from ({_profile_sql('orders_dirty', ORDERS_DIRTY_COLS)})""")
def _threshold_suggest(spark, d):
    return threshold_suggest(pr.null_profile(t(spark, d, "orders_dirty")))
