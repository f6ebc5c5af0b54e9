"""Registered source/sink queries (section 2.1). Each write goes to a fresh folder
under the session's shared checkpoint folder and is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewatch.session import scratch_path
from tablewatch.sources import files as io
from tablewatch.sources.catalog import schema_catalog
from tablewatch.plans.common import query, t

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")


def _fresh(spark, name):
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex}")


@query("scan_csv", "select * from orders")
def _scan_csv(spark, d):
    path = _fresh(spark, "orders_csv")
    t(spark, d, "orders").write.option("header", True).csv(path)
    return io.read_csv(spark, path, ORDERS_SCHEMA)


@query("scan_parquet", "select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '2000-01-01 00:00:00'")
def _scan_parquet(spark, d):
    o = io.read_parquet(spark, f"{d}/orders.parquet")
    return o.where(F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).select(
        "o_orderkey", "o_totalprice")


@query("write_curated", "select count(*) as rows_written from orders where o_totalprice > 100000")
def _write_curated(spark, d):
    n = io.write_curated(t(spark, d, "orders").where(F.col("o_totalprice") > 100000), _fresh(spark, "curated"))
    return spark.createDataFrame([(n,)], "rows_written bigint")


@query("table_replace", "select o_orderstatus, count(*) as n from orders where o_orderstatus = 'F' group by 1")
def _table_replace(spark, d):
    path = _fresh(spark, "replace")
    o = t(spark, d, "orders")
    io.table_replace(o, path)
    io.table_replace(o.where(F.col("o_orderstatus") == "F"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("insert_select", """
select strftime(ts, '%Y-%m-%d') as load_date, count(*) as n from events group by 1""")
def _insert_select(spark, d):
    path = _fresh(spark, "insert")
    e = t(spark, d, "events").withColumn("load_date", F.date_format("ts", "yyyy-MM-dd"))
    io.insert_select(e, path, F.col("load_date") < "2024-01-30")
    io.insert_select(e, path, F.col("load_date") >= "2024-01-30")
    return spark.read.parquet(path).groupBy("load_date").agg(F.count(F.lit(1)).alias("n"))


DAILY_SQL = """select strftime(ts, '%Y-%m-%d') as run_date, event_type, count(*) as n from events group by 1, 2"""


@query("replace_day", f"select * from ({DAILY_SQL})")
def _replace_day(spark, d):
    path = _fresh(spark, "replace_day")
    daily = (t(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_date"), "event_type")
             .agg(F.count(F.lit(1)).alias("n")))
    io.replace_day(daily, path)
    io.replace_day(daily.where(F.col("run_date") == "2024-01-15"), path)  # a re-run of one day
    # Partition values come back type-inferred (date); report them as the ISO text written.
    return spark.read.parquet(path).select(F.col("run_date").cast("string"), "event_type", "n")


@query("rebuild_partition", f"""
select run_date, event_type, case when run_date = '2024-01-15' then n * 10 else n end as n from ({DAILY_SQL})""")
def _rebuild(spark, d):
    path = _fresh(spark, "rebuild")
    daily = (t(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_date"), "event_type")
             .agg(F.count(F.lit(1)).alias("n")))
    io.replace_day(daily, path)
    fixed = daily.withColumn("n", F.col("n") * 10)  # the corrected logic for the backfilled day
    io.rebuild_partition(fixed, path, "run_date", "2024-01-15")
    return spark.read.parquet(path).select(F.col("run_date").cast("string"), "event_type", "n")


@query("schema_catalog", """
select 'orders' as table_name, column_name,
  case lower(column_type) when 'varchar' then 'string' when 'integer' then 'int'
       when 'timestamp' then 'timestamp_ntz' else lower(column_type) end as data_type,
  "null" = 'YES' as is_nullable, cast(row_number() over () as bigint) as ordinal_position
from (describe select * from orders)""")
def _catalog(spark, d):
    return schema_catalog(t(spark, d, "orders"), "orders")


DAY_SQL = "strftime(ts, '%Y-%m-%d')"


@query("file_arrival", f"""
select day, bool_or(landed) as arrived from (select {DAY_SQL} as day, day(ts) % 2 = 0 as landed from events) group by 1""")
def _arrival(spark, d):
    """Events are due every day; only even days have landed."""
    base = _fresh(spark, "days")
    e = t(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    e.where(F.dayofmonth("ts") % 2 == 0).write.partitionBy("day").parquet(base)
    return io.day_arrivals(spark, base, "day", e.select("day").distinct()).select("day", "arrived")


@query("fan_in_files", """
select r_name as region, count(*) as n from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1""")
def _fan_in(spark, d):
    base = _fresh(spark, "regions")
    geo = (t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = t(spark, d, "customer").join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    o = t(spark, d, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name")
    o.write.partitionBy("r_name").parquet(base)  # one extract folder per region
    regions = [r["r_name"] for r in t(spark, d, "region").select("r_name").collect()]  # 5-row dimension
    paths = [f"{base}/r_name={r}" for r in regions]
    combined = io.fan_in_files(spark, paths)
    region = F.regexp_extract("source_file", r"r_name=([^/]+)/", 1)
    return combined.groupBy(F.regexp_replace(region, "%20", " ").alias("region")).agg(F.count(F.lit(1)).alias("n"))
