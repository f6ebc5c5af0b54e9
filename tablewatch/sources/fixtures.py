"""Derived test tables.

Each fixture is derived by Spark from the driver tables (all rows, so its size
grows with the scale factor) and has a portable SQL twin used by the DuckDB
oracle. Faults are planted by key arithmetic; no rows are dropped to make a
check cheaper.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Portable SQL text of every derived view. Spark builds the same rows with the
# DataFrame functions below; tests check the two agree.
# ---------------------------------------------------------------------------
FIXTURE_SQL: dict[str, str] = {
    "orders_dirty": """
select o_orderkey,
  case when o_orderkey % 89 = 0 then null when o_orderkey % 151 = 0 then -1 else o_custkey end as o_custkey,
  case when o_orderkey % 131 = 0 then 'X' else o_orderstatus end as o_orderstatus,
  case when o_orderkey % 127 = 0 then -o_totalprice else o_totalprice end as o_totalprice,
  case when o_orderkey % 113 = 0 then timestamp '2099-01-01 00:00:00'
       when o_orderkey % 199 = 0 then timestamp '1900-01-01 00:00:00' else o_orderdate end as o_orderdate,
  case when o_orderkey % 137 = 0 then 'N/A' when o_orderkey % 139 = 0 then concat(' ', o_orderpriority)
       when o_orderkey % 157 = 0 then '' else o_orderpriority end as o_orderpriority
from orders
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderkey % 149 = 0""",
    "orders_dst": """
select o_orderkey, o_custkey, o_orderstatus,
  cast(o_totalprice + case when o_orderkey % 101 = 0 then 1.0 else 0.0 end as decimal(18,2)) as o_totalprice,
  o_orderdate,
  case when o_orderkey % 211 = 0 then null else o_orderpriority end as o_orderpriority
from orders where o_orderkey % 97 <> 0
union all
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)), o_orderdate, o_orderpriority
from orders where o_orderkey % 503 = 0 and o_orderkey % 97 <> 0
union all
select o_orderkey + 10000000, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)), o_orderdate, o_orderpriority
from orders where o_orderkey % 307 = 0""",
    "usage": """
select cast(l_suppkey % 4 as varchar) as workspace_id,
  case l_returnflag when 'A' then 'ALL_PURPOSE_COMPUTE' when 'N' then 'JOBS_COMPUTE' else 'JOBS_COMPUTE_PHOTON' end as sku_name,
  l_shipdate as usage_date, l_quantity as usage_quantity,
  case when l_linenumber <= 4 then cast(l_suppkey as varchar) end as cluster_id,
  case when l_linenumber % 2 = 0 then l_partkey % 50 end as job_id,
  case when l_linenumber > 5 then cast(l_suppkey % 10 as varchar) end as warehouse_id,
  case when l_partkey % 3 = 0 then 'team' when l_partkey % 3 = 1 then 'env' end as tag_key
from lineitem""",
    "list_prices": """
select * from (values ('ALL_PURPOSE_COMPUTE', 0.55, 'USD', cast(null as timestamp)),
                      ('ALL_PURPOSE_COMPUTE', 0.40, 'USD', timestamp '1999-01-01 00:00:00'),
                      ('JOBS_COMPUTE', 0.15, 'USD', cast(null as timestamp)),
                      ('JOBS_COMPUTE', 0.12, 'EUR', cast(null as timestamp)),
                      ('JOBS_COMPUTE_PHOTON', 0.20, 'USD', cast(null as timestamp)))
  as t(sku_name, unit_price, currency_code, price_end_time)""",
    "task_runs": """
select event_id as task_run_id, user_id as pipeline_id,
  user_id * 100 + day(ts) as pipeline_run_id, ts as started_at, value * 60 as duration_s,
  case event_type when 'error' then 'FAILED' when 'view' then 'SKIPPED' else 'SUCCEEDED' end as status,
  case when event_id % 4 = 0 then 'PYTHON' when event_id % 4 = 1 then 'DBT_CORE'
       when event_id % 4 = 2 then 'SNOWFLAKE' else 'HTTP' end as integration,
  case when (user_id * 100 + day(ts)) % 7 = 0 then 'feature/x' else 'main' end as branch,
  case when event_type <> 'error' then null when event_id % 5 = 0 then '401 Unauthorized: token expired'
       when event_id % 5 = 1 then 'Request timed out' when event_id % 5 = 2 then 'could not connect: DNS resolution failed'
       when event_id % 5 = 3 then 'sync already running' else 'KeyError: value' end as message
from events""",
    "query_history": """
select o_orderkey as query_id, cast(o_custkey % 4 as varchar) as workspace_id,
  cast(o_custkey % 10 as varchar) as warehouse_id, o_orderdate as start_time,
  concat('SELECT ', o_orderpriority, ' FROM t', cast(o_custkey as varchar), ' WHERE id = ', cast(o_orderkey as varchar),
         case when o_custkey % 2 = 0 then ' AND x > 1' else '' end) as statement_text,
  case when o_orderstatus = 'P' then 'INSERT' else 'SELECT' end as statement_type,
  case when o_orderkey % 13 = 0 then 'FAILED' else 'FINISHED' end as execution_status,
  o_totalprice * 10 as total_duration_ms, o_totalprice * 1000000 as read_bytes, o_orderkey % 20 as read_files,
  case when o_orderpriority like '1%' then 0 else o_orderkey % 7 end as pruned_files
from orders""",
    "node_timeline": """
select cast(l_suppkey as varchar) as cluster_id, l_shipdate as start_time, l_linenumber = 1 as driver,
  l_discount * 100 + l_suppkey % 30 as cpu_user_percent, l_tax * 50 as cpu_system_percent,
  l_quantity as mem_used_percent
from lineitem""",
    "clusters": """
select cast(s_suppkey as varchar) as cluster_id, s_name as cluster_name, cast(s_nationkey as varchar) as owned_by,
  cast(s_suppkey % 4 as varchar) as workspace_id, timestamp '2001-01-01 00:00:00' as change_time,
  cast(null as timestamp) as delete_time,
  case when s_suppkey % 7 = 0 then null else (s_suppkey % 5) * 30 end as auto_termination_minutes,
  case when s_suppkey % 3 = 0 then s_suppkey % 20 end as worker_count,
  case when s_suppkey % 3 <> 0 then 2 end as min_autoscale_workers,
  case when s_suppkey % 2 = 0 then 'UI' else 'JOB' end as cluster_source,
  case when s_suppkey % 4 = 0 then 'ON_DEMAND_AZURE' when s_suppkey % 4 = 1 then 'SPOT_WITH_FALLBACK' end as aws_availability,
  case when s_suppkey % 4 = 2 then 'ON_DEMAND' end as azure_availability,
  cast(null as varchar) as gcp_availability
from supplier
union all
select cast(s_suppkey as varchar), s_name, cast(s_nationkey as varchar), cast(s_suppkey % 4 as varchar),
  timestamp '2000-01-01 00:00:00', cast(null as timestamp), 0, 50, null, 'UI', 'ON_DEMAND', null, null
from supplier""",
    "table_reads": """
select l_partkey as table_id, l_shipdate as read_at from lineitem""",
    "managed_tables": """
select p_partkey as table_id, p_name as table_name,
  case when p_partkey % 10 = 0 then 'VIEW' else 'MANAGED' end as table_type
from part""",
    "model_edges": """
select p_partkey as child, p_partkey // 10 as parent from part where p_partkey >= 10
union
select p_partkey as child, p_partkey % 9 as parent from part where p_partkey >= 10""",
    "model_sources": """
select user_id as source_id, user_id % 10 as model_id, max(ts) as loaded_at from events group by user_id""",
    "job_run_timeline": """
select o_custkey % 60 as job_id, o_orderkey as run_id, cast(o_custkey % 4 as varchar) as workspace_id,
  case o_orderstatus when 'F' then 'SUCCEEDED' when 'O' then 'FAILED' else 'CANCELLED' end as result_state,
  o_orderdate as period_start_time,
  o_orderdate + to_seconds(cast(floor(o_totalprice / 10) as bigint)) as period_end_time
from orders""",
    "job_names": """
select c_custkey as job_id, c_name as job_name, timestamp '2000-01-01 00:00:00' as change_time from customer
union all
select c_custkey, concat(c_name, ' v2'), timestamp '2001-06-01 00:00:00' from customer where c_custkey % 3 = 0""",
    "access_log": """
select event_id as access_id, ts as event_time,
  [{'name': concat('tbl_', cast(user_id % 40 as varchar))},
   {'name': concat('tbl_', cast((user_id * 7) % 40 as varchar))}] as objects_accessed
from events""",
}

# Fixture dependencies on other fixtures (for CTE ordering in the oracle).
FIXTURE_DEPS: dict[str, list[str]] = {}


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every derived view it names."""
    needed: list[str] = []

    def visit(name: str):
        for dep in FIXTURE_DEPS.get(name, []):
            visit(dep)
        if name not in needed:
            needed.append(name)

    for name in FIXTURE_SQL:
        if re.search(rf"\b{name}\b", sql):
            visit(name)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n]}\n)" for n in needed)
    body = sql.lstrip()
    if body[:14].lower() == "with recursive":
        return f"with recursive {ctes},\n{body[14:].lstrip()}"
    if body[:4].lower() == "with":
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------

def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    dirty = o.select(
        k,
        F.when(k % 89 == 0, F.lit(None)).when(k % 151 == 0, F.lit(-1)).otherwise(F.col("o_custkey"))
        .cast("bigint").alias("o_custkey"),
        F.when(k % 131 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 127 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 113 == 0, F.lit("2099-01-01 00:00:00").cast("timestamp_ntz"))
        .when(k % 199 == 0, F.lit("1900-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(k % 137 == 0, F.lit("N/A"))
        .when(k % 139 == 0, F.concat(F.lit(" "), F.col("o_orderpriority")))
        .when(k % 157 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    copies = o.where(k % 149 == 0).select(dirty.columns)
    return dirty.unionByName(copies)


def orders_dst(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    dec = "decimal(18,2)"
    main = o.where(k % 97 != 0).select(
        k, "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") + F.when(k % 101 == 0, F.lit(1.0)).otherwise(F.lit(0.0))).cast(dec)
        .alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 211 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"))
    dups = o.where((k % 503 == 0) & (k % 97 != 0)).select(
        k, "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(dec).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    extra = o.where(k % 307 == 0).select(
        (k + 10000000).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast(dec).alias("o_totalprice"), "o_orderdate", "o_orderpriority")
    return main.unionByName(dups).unionByName(extra)


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing usage rows with a ``usage_metadata`` struct and ``custom_tags`` map."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_suppkey") % 4).cast("string").alias("workspace_id"),
        F.when(F.col("l_returnflag") == "A", "ALL_PURPOSE_COMPUTE")
        .when(F.col("l_returnflag") == "N", "JOBS_COMPUTE").otherwise("JOBS_COMPUTE_PHOTON").alias("sku_name"),
        F.col("l_shipdate").alias("usage_date"),
        F.col("l_quantity").alias("usage_quantity"),
        F.struct(
            F.when(F.col("l_linenumber") <= 4, F.col("l_suppkey").cast("string")).alias("cluster_id"),
            F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey") % 50).alias("job_id"),
            F.when(F.col("l_linenumber") > 5, (F.col("l_suppkey") % 10).cast("string")).alias("warehouse_id"),
        ).alias("usage_metadata"),
        F.when(F.col("l_partkey") % 3 == 0, F.create_map(F.lit("team"), F.lit("1")))
        .when(F.col("l_partkey") % 3 == 1, F.create_map(F.lit("env"), F.lit("1")))
        .alias("custom_tags"),
    )


def list_prices(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Price list: a dimension of a handful of SKUs (bounded by the SKU catalogue)."""
    rows = [("ALL_PURPOSE_COMPUTE", 0.55, "USD", None),
            ("ALL_PURPOSE_COMPUTE", 0.40, "USD", "1999-01-01 00:00:00"),
            ("JOBS_COMPUTE", 0.15, "USD", None),
            ("JOBS_COMPUTE", 0.12, "EUR", None),
            ("JOBS_COMPUTE_PHOTON", 0.20, "USD", None)]
    df = spark.createDataFrame(rows, "sku_name string, unit_price double, currency_code string, end_text string")
    return df.select("sku_name", F.struct(F.col("unit_price").alias("default")).alias("pricing"),
                     "currency_code", F.col("end_text").cast("timestamp_ntz").alias("price_end_time"))


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    eid, et = F.col("event_id"), F.col("event_type")
    return e.select(
        eid.alias("task_run_id"), F.col("user_id").alias("pipeline_id"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("pipeline_run_id"),
        F.col("ts").alias("started_at"), (F.col("value") * 60).alias("duration_s"),
        F.when(et == "error", "FAILED").when(et == "view", "SKIPPED").otherwise("SUCCEEDED").alias("status"),
        F.when(eid % 4 == 0, "PYTHON").when(eid % 4 == 1, "DBT_CORE").when(eid % 4 == 2, "SNOWFLAKE")
        .otherwise("HTTP").alias("integration"),
        F.when((F.col("user_id") * 100 + F.dayofmonth("ts")) % 7 == 0, "feature/x").otherwise("main")
        .alias("branch"),
        F.when(et != "error", F.lit(None).cast("string"))
        .when(eid % 5 == 0, "401 Unauthorized: token expired").when(eid % 5 == 1, "Request timed out")
        .when(eid % 5 == 2, "could not connect: DNS resolution failed")
        .when(eid % 5 == 3, "sync already running").otherwise("KeyError: value").alias("message"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    return o.select(
        ok.alias("query_id"), (ck % 4).cast("string").alias("workspace_id"), F.col("o_orderdate").alias("start_time"),
        F.concat(F.lit("SELECT "), F.col("o_orderpriority"), F.lit(" FROM t"), ck.cast("string"),
                 F.lit(" WHERE id = "), ok.cast("string"),
                 F.when(ck % 2 == 0, " AND x > 1").otherwise("")).alias("statement_text"),
        F.when(F.col("o_orderstatus") == "P", "INSERT").otherwise("SELECT").alias("statement_type"),
        F.when(ok % 13 == 0, "FAILED").otherwise("FINISHED").alias("execution_status"),
        (F.col("o_totalprice") * 10).alias("total_duration_ms"),
        (F.col("o_totalprice") * 1000000).alias("read_bytes"),
        (ok % 20).alias("read_files"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit(0)).otherwise(ok % 7).cast("bigint")
        .alias("pruned_files"),
        F.struct((ck % 10).cast("string").alias("warehouse_id")).alias("compute"),
    )


def node_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("cluster_id"), F.col("l_shipdate").alias("start_time"),
        (F.col("l_linenumber") == 1).alias("driver"),
        (F.col("l_discount") * 100 + F.col("l_suppkey") % 30).alias("cpu_user_percent"),
        (F.col("l_tax") * 50).alias("cpu_system_percent"),
        F.col("l_quantity").alias("mem_used_percent"))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    null_str = F.lit(None).cast("string")
    cur = s.select(
        k.cast("string").alias("cluster_id"), F.col("s_name").alias("cluster_name"),
        F.col("s_nationkey").cast("string").alias("owned_by"), (k % 4).cast("string").alias("workspace_id"),
        F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("change_time"),
        F.lit(None).cast("timestamp_ntz").alias("delete_time"),
        F.when(k % 7 == 0, F.lit(None)).otherwise((k % 5) * 30).cast("bigint").alias("auto_termination_minutes"),
        F.when(k % 3 == 0, k % 20).cast("bigint").alias("worker_count"),
        F.when(k % 3 != 0, F.lit(2)).cast("bigint").alias("min_autoscale_workers"),
        F.when(k % 2 == 0, "UI").otherwise("JOB").alias("cluster_source"),
        F.struct(F.when(k % 4 == 0, "ON_DEMAND_AZURE").when(k % 4 == 1, "SPOT_WITH_FALLBACK")
                 .alias("availability")).alias("aws_attributes"),
        F.struct(F.when(k % 4 == 2, "ON_DEMAND").alias("availability")).alias("azure_attributes"),
        F.struct(null_str.alias("availability")).alias("gcp_attributes"),
    )
    old = s.select(
        k.cast("string").alias("cluster_id"), F.col("s_name").alias("cluster_name"),
        F.col("s_nationkey").cast("string").alias("owned_by"), (k % 4).cast("string").alias("workspace_id"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("change_time"),
        F.lit(None).cast("timestamp_ntz").alias("delete_time"),
        F.lit(0).cast("bigint").alias("auto_termination_minutes"),
        F.lit(50).cast("bigint").alias("worker_count"),
        F.lit(None).cast("bigint").alias("min_autoscale_workers"),
        F.lit("UI").alias("cluster_source"),
        F.struct(F.lit("ON_DEMAND").alias("availability")).alias("aws_attributes"),
        F.struct(null_str.alias("availability")).alias("azure_attributes"),
        F.struct(null_str.alias("availability")).alias("gcp_attributes"),
    )
    return cur.unionByName(old)


def table_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("table_id"), F.col("l_shipdate").alias("read_at"))


def managed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("table_id"), F.col("p_name").alias("table_name"),
                    F.when(F.col("p_partkey") % 10 == 0, "VIEW").otherwise("MANAGED").alias("table_type"))


def model_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model DAG over all parts: parents are ``key div 10`` and ``key % 9``.

    Every parent key is smaller than its child, so the graph is acyclic and its
    depth grows only with log10 of the number of models.
    """
    p = load(spark, sf_dir, "part").where(F.col("p_partkey") >= 10)
    a = p.select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 10").alias("parent"))
    b = p.select(F.col("p_partkey").alias("child"), (F.col("p_partkey") % 9).alias("parent"))
    return a.union(b).distinct()


def model_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("source_id"))
            .agg(F.max("ts").alias("loaded_at"))
            .select("source_id", (F.col("source_id") % 10).alias("model_id"), "loaded_at"))


def job_run_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        (F.col("o_custkey") % 60).alias("job_id"), F.col("o_orderkey").alias("run_id"),
        (F.col("o_custkey") % 4).cast("string").alias("workspace_id"),
        F.when(st == "F", "SUCCEEDED").when(st == "O", "FAILED").otherwise("CANCELLED").alias("result_state"),
        F.col("o_orderdate").alias("period_start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.floor(F.col("o_totalprice") / 10)))
        .alias("period_end_time"))


def job_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of jobs over time; every third was renamed."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("job_name"))
    at = (lambda x: F.lit(x).cast("timestamp_ntz").alias("change_time"))
    renamed = c.where(F.col("job_id") % 3 == 0).select("job_id", F.concat("job_name", F.lit(" v2")).alias("job_name"), at("2001-06-01"))
    return c.select("*", at("2000-01-01")).unionByName(renamed)


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    u = F.col("user_id")
    return e.select(
        F.col("event_id").alias("access_id"), F.col("ts").alias("event_time"),
        F.array(F.struct(F.concat(F.lit("tbl_"), (u % 40).cast("string")).alias("name")),
                F.struct(F.concat(F.lit("tbl_"), ((u * 7) % 40).cast("string")).alias("name")))
        .alias("objects_accessed"))


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders_dirty": orders_dirty, "orders_dst": orders_dst, "usage": usage, "list_prices": list_prices,
    "task_runs": task_runs, "query_history": query_history, "node_timeline": node_timeline,
    "clusters": clusters, "table_reads": table_reads, "managed_tables": managed_tables,
    "model_edges": model_edges, "model_sources": model_sources, "job_run_timeline": job_run_timeline,
    "access_log": access_log, "job_names": job_names,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in BUILDERS:
        return BUILDERS[name](spark, sf_dir)
    return load(spark, sf_dir, name)
