"""Registered ELT transform queries (section 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.operators import transform as tf
from tablewatch.plans.common import AS_OF_ORDERS, query, t


@query("drop_null_keys", "select * from orders_dirty where o_custkey is not null")
def _drop(spark, d):
    return tf.drop_null_keys(t(spark, d, "orders_dirty"), ["o_custkey"])


DEDUP_SQL = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from (
  select *, row_number() over (partition by o_orderkey order by o_totalprice, o_orderdate, o_custkey nulls first,
                                o_orderstatus, o_orderpriority nulls first) as rn from orders_dirty) where rn = 1"""


@query("dedupe_by_key", DEDUP_SQL)
def _dedupe(spark, d):
    return tf.dedupe_by_key(t(spark, d, "orders_dirty"), ["o_orderkey"], ["o_totalprice", "o_orderdate"])


@query("derive_amount", """
select l_orderkey, l_linenumber, l_extendedprice - l_extendedprice * l_discount as net_amount from lineitem""")
def _derive(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"))
    return tf.derive_amount(li, "net_amount", "l_extendedprice", "discount_amount", "-").select(
        "l_orderkey", "l_linenumber", "net_amount")


@query("filter_measure", "select * from orders_dirty where o_totalprice > 0")
def _filter(spark, d):
    return tf.filter_measure(t(spark, d, "orders_dirty"), "o_totalprice", ">")


@query("clean_pipeline", f"""
select * from (select *, o_totalprice - 0.0 as net_amount from ({DEDUP_SQL.replace('from orders_dirty)',
    'from orders_dirty where o_custkey is not null)')})) where net_amount >= 0""")
def _clean(spark, d):
    x = t(spark, d, "orders_dirty").withColumn("zero", F.lit(0.0))
    out = tf.clean_pipeline(x, ["o_orderkey"], ["o_totalprice", "o_orderdate"], "net_amount", "o_totalprice", "zero",
                            "-", ">=", required=["o_orderkey", "o_custkey"])
    return out.drop("zero")


@query("status_total", "select cast(coalesce(sum(cast(o_totalprice as decimal(18,2))), 0) * 100 as bigint) "
                       "as total_cents from orders where o_orderstatus = 'F'")
def _status_total(spark, d):
    return tf.status_total(t(spark, d, "orders"), "o_totalprice", "o_orderstatus", "F")


@query("status_count", "select count(*) as n from orders where o_orderstatus = 'P'")
def _status_count(spark, d):
    return tf.status_count(t(spark, d, "orders"), "o_orderstatus", "P")


@query("below_threshold_count", "select count(*) as n from lineitem where l_quantity < l_linenumber * 5")
def _below(spark, d):
    return tf.below_threshold_count(t(spark, d, "lineitem"), "l_quantity", F.col("l_linenumber") * 5)


@query("rows_since_watermark", """
select count(*) as new_rows, case when count(*) > 0 then 'load' else 'skip' end as action
from events where ts > timestamp '2024-01-25 00:00:00'""")
def _since(spark, d):
    return tf.rows_since_watermark(t(spark, d, "events"), "ts", "2024-01-25 00:00:00")


@query("lookback_rollup", f"""
select r_name, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) * 100 as bigint) as total_cents
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
where o_orderdate >= timestamp '{AS_OF_ORDERS}' - interval 365 day and o_orderdate < timestamp '{AS_OF_ORDERS}'
group by r_name""")
def _rollup(spark, d):
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: safe to broadcast.
    geo = (t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = t(spark, d, "customer").select("c_custkey", "c_nationkey").join(
        F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    o = t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    facts = o.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return tf.lookback_rollup(facts, "o_orderdate", ["r_name"], "o_totalprice", AS_OF_ORDERS, 365)


@query("scenario_cross", """
with p as (select * from (values (100000), (200000), (300000)) as a(min_price),
                         (values ('F'), ('O'), ('P'), ('X')) as b(status)),
c as (select min_price, status, count(*) as n from orders join p on o_orderstatus = status and o_totalprice > min_price
      group by 1, 2)
select cast(p.min_price as bigint) as min_price, p.status, coalesce(c.n, 0) as n from p left join c using (min_price, status)""")
def _scenario(spark, d):
    return tf.scenario_cross(t(spark, d, "orders"), "min_price", [100000, 200000, 300000], "status",
                             ["F", "O", "P", "X"],
                             lambda df, a, b: (F.col("o_orderstatus") == b) & (F.col("o_totalprice") > a))


def _batch(spark, d):
    """A landed batch of orders: o_custkey arrives as int, priority is missing, a clerk column is new."""
    o = t(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus",
                    "o_totalprice", "o_orderdate",
                    F.concat(F.lit("Clerk#"), (F.col("o_orderkey") % 100).cast("string")).alias("o_clerk"))


@query("evolve_schema", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  cast(null as varchar) as o_clerk from orders
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cast(null as varchar),
  concat('Clerk#', cast(o_orderkey % 100 as varchar)) from orders""")
def _evolve(spark, d):
    # The target already holds o_custkey as bigint; the int batch widens into it.
    return tf.evolve_schema(t(spark, d, "orders"), _batch(spark, d))


@query("schema_compat", """
select * from (values ('o_orderkey', 'bigint', 'bigint', 'same', true),
  ('o_custkey', 'bigint', 'int', 'narrowed', false), ('o_orderstatus', 'string', 'string', 'same', true),
  ('o_totalprice', 'double', 'double', 'same', true), ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same', true),
  ('o_orderpriority', 'string', null, 'removed', false), ('o_clerk', null, 'string', 'added', true))
  as v(column_name, old_type, new_type, state, additive)""")
def _compat(spark, d):
    return tf.schema_compat(t(spark, d, "orders"), _batch(spark, d))


@query("landed_check", """
select count(*) > 0 as has_rows, 'o_comment' as missing_columns, false as ok from (select * from orders limit 1)""")
def _landed(spark, d):
    return tf.landed_check(t(spark, d, "orders"), ["o_orderkey", "o_totalprice", "o_comment"])


@query("coalesce_variants", """
select o_orderkey, case o_orderkey % 6 when 0 then cast(cast(o_totalprice as decimal(18,2)) as varchar)
    when 1 then cast(o_orderkey as varchar) when 2 then 'abc' when 3 then cast(o_orderkey % 4 = 3 as varchar)
    when 4 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as price
from orders""")
def _variants(spark, d):
    o = t(spark, d, "orders")
    k = F.col("o_orderkey") % 6
    v = o.select("o_orderkey",
                 F.when(k == 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
                 F.when(k <= 1, F.col("o_orderkey")).alias("price__v_bigint"),
                 F.when(k == 2, F.lit("abc")).alias("price__v_text"),
                 F.when(k == 3, F.col("o_orderkey") % 4 == 3).alias("price__v_bool"),
                 F.when(k == 4, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")).alias("price__v_timestamp"))
    return tf.coalesce_variants(v, "price", ("text", "bigint"))


