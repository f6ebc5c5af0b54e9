"""Registered reconciliation queries (section 2.6): ``orders`` vs its planted-fault copy."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewatch.functions.windows import with_prev_value
from tablewatch.operators import reconcile as r
from tablewatch.plans.common import query, t
from tablewatch.session import scratch_path
from tablewatch.sources.catalog import schema_catalog

KEY = ["o_orderkey"]
COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ALL_COLS = ["o_orderkey", *COLS]
CURSOR_SEED = "2001-01-01 00:00:00"

def canon(text: str) -> str:
    """DuckDB spelling of a canonical value: its length and text, or a bare ~ (see functions.canonical)."""
    return f"coalesce(length({text}) || ':' || {text}, '~')"


CANON = {
    "o_orderkey": canon("cast(o_orderkey as varchar)"),
    "o_custkey": canon("cast(o_custkey as varchar)"),
    "o_orderstatus": canon("o_orderstatus"),
    "o_totalprice": canon("cast(cast(o_totalprice as decimal(38,6)) as varchar)"),
    "o_orderdate": canon("cast(epoch_us(o_orderdate) as varchar)"),
    "o_orderpriority": canon("o_orderpriority"),
}


def k60(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::bigint"


def _cmp_sql(check: str, expr: str, src: str = "orders", dst: str = "orders_dst", error_gt: int = 0) -> str:
    """Scalar compare of one aggregate expression over both sides (error when |diff| > n)."""
    return (f"select '{check}' as check_name, cast(s.v as bigint) as src_value, cast(d.v as bigint) as dst_value, "
            f"cast(d.v as bigint) - cast(s.v as bigint) as diff, "
            f"case when coalesce(abs(cast(d.v as bigint) - cast(s.v as bigint)), 1) > {error_gt} then 'FAILED' "
            f"else 'SUCCEEDED' end as verdict "
            f"from (select {expr} as v from {src}) s, (select {expr} as v from {dst}) d")


def _sides(spark, d):
    return t(spark, d, "orders"), t(spark, d, "orders_dst")


@query("rec_row_count", _cmp_sql("row_count", "count(*)"))
def _row_count(spark, d):
    return r.rec_row_count(*_sides(spark, d))


CENTS = "cast(sum(cast(o_totalprice as decimal(18,2))) * 100 as bigint)"


@query("rec_column_sum", _cmp_sql("sum_cents:o_totalprice", CENTS))
def _column_sum(spark, d):
    return r.rec_column_sum(*_sides(spark, d), "o_totalprice")


@query("rec_null_count", _cmp_sql("null_count:o_orderpriority", "count(*) - count(o_orderpriority)"))
def _null_count(spark, d):
    return r.rec_null_count(*_sides(spark, d), "o_orderpriority")


@query("rec_distinct_count", _cmp_sql("distinct_count:o_custkey", "count(distinct o_custkey)"))
def _distinct_count(spark, d):
    return r.rec_distinct_count(*_sides(spark, d), "o_custkey")


@query("rec_epoch_minmax", _cmp_sql("min_epoch:o_orderdate", "floor(epoch(min(o_orderdate)))", error_gt=60)
       + "\nunion all " + _cmp_sql("max_epoch:o_orderdate", "floor(epoch(max(o_orderdate)))", error_gt=60))
def _epoch_minmax(spark, d):
    return r.rec_epoch_minmax(*_sides(spark, d), "o_orderdate", "> 60")


@query("rec_true_count", _cmp_sql("true_count:status_f", "coalesce(sum(cast(o_orderstatus = 'F' as integer)), 0)"))
def _true_count(spark, d):
    return r.rec_true_count(*_sides(spark, d), F.col("o_orderstatus") == "F", "status_f")


def k60b(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 16, 15))::bigint"


def _sums(row: str, table: str) -> str:
    """Multiset sums of one side, and the first of them as it is shown."""
    return (f"(select *, cast(sum1 % {r.SHOWN}::hugeint as bigint) as checksum from (select count(*) as rows, "
            f"coalesce(sum(cast({k60(row)} as hugeint)), 0::hugeint) as sum1, coalesce(sum(cast({k60b(row)} as hugeint)), 0::hugeint) as sum2 from {table}))")


def _distinct(row: str, table: str) -> str:
    return f"(select count(distinct substr(md5({row}), 1, 30)) as distinct_rows from {table})"


SAME_SQL = "s.rows = d.rows and s.sum1 = d.sum1 and s.sum2 = d.sum2"


def _checksum_sql(cols):
    row = " || ".join(CANON[c] for c in cols)
    return f"""
select s.rows as src_rows, s.checksum as src_checksum, d.rows as dst_rows, d.checksum as dst_checksum,
  case when {SAME_SQL} then 'SUCCEEDED' else 'FAILED' end as verdict
from {_sums(row, 'orders')} s, {_sums(row, 'orders_dst')} d"""


def _row_checksum_sql(cols):
    """The checksums with the distinct and the duplicate rows of each side."""
    row = " || ".join(CANON[c] for c in cols)
    return f"""
select s.rows as src_rows, sd.distinct_rows as src_distinct_rows, s.checksum as src_checksum,
  d.rows as dst_rows, dd.distinct_rows as dst_distinct_rows, d.checksum as dst_checksum,
  s.rows - sd.distinct_rows as src_dup_rows, d.rows - dd.distinct_rows as dst_dup_rows,
  case when {SAME_SQL} and sd.distinct_rows = dd.distinct_rows then 'SUCCEEDED' else 'FAILED' end as verdict
from {_sums(row, 'orders')} s, {_sums(row, 'orders_dst')} d, {_distinct(row, 'orders')} sd, {_distinct(row, 'orders_dst')} dd"""


CHECKED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]


@query("rec_row_checksum", _row_checksum_sql(CHECKED))
def _row_checksum(spark, d):
    return r.rec_row_checksum(*_sides(spark, d), CHECKED)


@query("rec_table_fingerprint", _checksum_sql(sorted(ALL_COLS)))
def _table_fingerprint(spark, d):
    return r.rec_table_fingerprint(*_sides(spark, d))


LEAF = 500


@query("rec_differing_ranges", f"""
with b as (select least((select min(o_orderkey) from orders), (select min(o_orderkey) from orders_dst)) as low,
                  greatest((select max(o_orderkey) from orders), (select max(o_orderkey) from orders_dst)) as high),
s as (select (o_orderkey - low) // {LEAF} as at, count(*) as n, sum(cast({k60(" || ".join(CANON[c] for c in CHECKED))} as hugeint)) as f from orders, b group by 1),
d as (select (o_orderkey - low) // {LEAF} as at, count(*) as n, sum(cast({k60(" || ".join(CANON[c] for c in CHECKED))} as hugeint)) as f from orders_dst, b group by 1)
select low + coalesce(s.at, d.at) * {LEAF} as low, least(high, low + (coalesce(s.at, d.at) + 1) * {LEAF} - 1) as high,
  coalesce(s.n, 0) as src_rows, coalesce(d.n, 0) as dst_rows
from s full join d on s.at = d.at, b where s.n is distinct from d.n or s.f is distinct from d.f""")
def _differing_ranges(spark, d):
    return r.rec_differing_ranges(*_sides(spark, d), "o_orderkey", CHECKED, fanout=16, leaf=LEAF)


SPARK_TYPE_SQL = ("case lower(column_type) when 'varchar' then 'string' when 'integer' then 'int' "
                  "when 'timestamp' then 'timestamp_ntz' else lower(column_type) end")


def _catalog_sql(select_sql: str) -> str:
    return f"(select column_name, {SPARK_TYPE_SQL} as data_type from (describe {select_sql}))"


SRC_CAT = _catalog_sql("select * from orders")
# The destination schema, spelled as the query that builds orders_dst (describe cannot see a CTE).
DST_CAT = _catalog_sql("select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as "
                       "o_totalprice, o_orderdate, o_orderpriority from orders")


@query("rec_schema_fingerprint", f"""
select s.columns as src_columns, s.fingerprint as src_fingerprint, d.columns as dst_columns,
  d.fingerprint as dst_fingerprint,
  case when s.columns = d.columns and s.fingerprint = d.fingerprint then 'SUCCEEDED' else 'WARNING' end as verdict
from (select count(*) as columns, coalesce(bit_xor({k60("concat_ws(':', column_name, data_type)")}), 0) as fingerprint
      from {SRC_CAT}) s,
     (select count(*) as columns, coalesce(bit_xor({k60("concat_ws(':', column_name, data_type)")}), 0) as fingerprint
      from {DST_CAT}) d""")
def _schema_fingerprint(spark, d):
    s, dd = _sides(spark, d)
    return r.rec_schema_fingerprint(schema_catalog(s, "orders"), schema_catalog(dd, "orders_dst"), ALL_COLS)


@query("rec_schema_diff", f"""
select coalesce(s.column_name, d.column_name) as column_name, s.data_type as src_type, d.data_type as dst_type,
  case when d.data_type is null then 'missing_in_dst' when s.data_type is null then 'missing_in_src'
       when s.data_type <> d.data_type then 'retyped' else 'ok' end as state,
  case when s.data_type = d.data_type then 'SUCCEEDED' else 'WARNING' end as verdict
from {SRC_CAT} s full outer join {DST_CAT} d on s.column_name = d.column_name""")
def _schema_diff(spark, d):
    s, dd = _sides(spark, d)
    return r.rec_schema_diff(schema_catalog(s, "orders"), schema_catalog(dd, "orders_dst"))


def _keyed_sql(tb: str, cols: list[str], prefix: str) -> str:
    fps = ", ".join(f"sum({k60(CANON[c])}::decimal(38,0)) as {prefix}f{i}" for i, c in enumerate(cols))
    return f"(select o_orderkey, count(*) as {prefix}n, {fps} from {tb} group by o_orderkey)"


def _row_diff_sql(src: str, dst: str, cols: list[str], unique_only: bool = False, rows_check: bool = True) -> str:
    s, d = _keyed_sql(src, cols, "s"), _keyed_sql(dst, cols, "d")
    where = " where sn = 1 and dn = 1" if unique_only else ""
    parts = []
    if rows_check:
        parts.append("select o_orderkey, '__rows' as column_name from j where sn is distinct from dn")
    for i, c in enumerate(cols):
        parts.append(f"select o_orderkey, '{c}' as column_name from j where sf{i} is distinct from df{i}")
    return f"with j as (select * from {s} join {d} using (o_orderkey){where})\n" + "\nunion all ".join(parts)


@query("rec_row_diff", _row_diff_sql("orders", "orders_dst", COLS))
def _row_diff(spark, d):
    return r.rec_row_diff(*_sides(spark, d), KEY, COLS)


@query("rec_missing_rows", """
select o_orderkey, 'src_only' as side from (select distinct o_orderkey from orders) s
  where not exists (select 1 from orders_dst d where d.o_orderkey = s.o_orderkey)
union all
select o_orderkey, 'dst_only' from (select distinct o_orderkey from orders_dst) d
  where not exists (select 1 from orders s where s.o_orderkey = d.o_orderkey)""")
def _missing(spark, d):
    return r.rec_missing_rows(*_sides(spark, d), KEY)


@query("rec_duplicate_keys", """
select o_orderkey, count(*) as n, 'src' as side from orders group by 1 having count(*) > 1
union all select o_orderkey, count(*), 'dst' from orders_dst group by 1 having count(*) > 1""")
def _dups(spark, d):
    return r.rec_duplicate_keys(*_sides(spark, d), KEY)


@query("rec_unique_key_diff", _row_diff_sql("orders", "orders_dst", COLS, unique_only=True, rows_check=False))
def _unique_diff(spark, d):
    return r.rec_unique_key_diff(*_sides(spark, d), KEY, COLS)


TRIMMED = "nullif(trim(o_orderpriority), '')"


@query("rec_normalised_diff", f"""
with s as (select o_orderkey, count(*) as sn,
             sum(('0x' || substr(md5({canon(TRIMMED)}), 1, 15))::bigint::decimal(38,0)) as sf0
           from orders group by 1),
d as (select o_orderkey, count(*) as dn,
             sum(('0x' || substr(md5({canon(TRIMMED)}), 1, 15))::bigint::decimal(38,0)) as df0
           from orders_dirty group by 1),
j as (select * from s join d using (o_orderkey))
select o_orderkey, '__rows' as column_name from j where sn is distinct from dn
union all select o_orderkey, 'o_orderpriority' from j where sf0 is distinct from df0""")
def _normalised(spark, d):
    src = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    dst = t(spark, d, "orders_dirty").select("o_orderkey", "o_orderpriority")
    return r.rec_normalised_diff(src, dst, KEY, ["trim", "empty_as_null"], ["o_orderpriority"])


DST_RENAMED = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "total_price",
               "o_orderpriority": "priority"}


@query("rec_mapped", _cmp_sql("row_count", "count(*)") + "\nunion all "
       + _cmp_sql("sum_cents:o_totalprice", CENTS) + "\nunion all "
       + _cmp_sql("null_count:o_orderpriority", "count(*) - count(o_orderpriority)"))
def _mapped(spark, d):
    src, dst = _sides(spark, d)
    renamed = dst.withColumnsRenamed(DST_RENAMED)  # the destination as it lands, with its own names
    back = r.rec_mapped(renamed, {v: k for k, v in DST_RENAMED.items()})
    return (r.rec_row_count(src, back).unionByName(r.rec_column_sum(src, back, "o_totalprice"))
            .unionByName(r.rec_null_count(src, back, "o_orderpriority")))


@query("rec_cursor_drift", f"""
with s as (select count(*) as n, max(o_orderdate) as mx from orders where o_orderdate >= timestamp '{CURSOR_SEED}'),
d as (select count(*) as n, max(o_orderdate) as mx from orders_dst where o_orderdate >= timestamp '{CURSOR_SEED}')
select 'orders' as table_name, timestamp '{CURSOR_SEED}' as cached_cursor, s.n as src_new_rows, d.n as dst_new_rows,
  d.n - s.n as count_drift, cast(floor(epoch(d.mx)) - floor(epoch(s.mx)) as bigint) as max_drift_s,
  case when abs(d.n - s.n) <> 0 then 'FAILED' else 'SUCCEEDED' end as count_verdict,
  case when coalesce(abs(floor(epoch(d.mx)) - floor(epoch(s.mx))), 0) > 60 then 'FAILED' else 'SUCCEEDED' end as max_verdict,
  case when s.mx is null or d.mx is null then timestamp '{CURSOR_SEED}' else greatest(timestamp '{CURSOR_SEED}', least(s.mx, d.mx)) end as new_cursor
from s, d""")
def _cursor_drift(spark, d):
    return r.rec_cursor_drift(*_sides(spark, d), "o_orderdate", CURSOR_SEED, "orders")


# Three runs: each sees the orders before its cut; a part of each side arrives one run late.
CUTS = ["2001-03-01 00:00:00", "2001-05-01 00:00:00", "2001-07-01 00:00:00"]
OVERLAP_S = 20 * 86400
LATE = {"orders": (7, 3), "orders_dst": (5, 2)}


def _visible_sql(table: str, run: int) -> str:
    n, rest = LATE[table]
    before = f"o_orderdate < timestamp '{CUTS[run - 1]}'" if run else "false"
    return f"o_orderdate < timestamp '{CUTS[run]}' and (o_orderkey % {n} <> {rest} or {before})"


def _cursor_runs_sql() -> str:
    parts = [f"c0 as (select timestamp '{CURSOR_SEED}' as c)"]
    for run in range(3):
        for name, table in (("s", "orders"), ("d", "orders_dst")):
            seen = f"({_visible_sql(table, run - 1)}) and o_orderdate <= c" if run else "false"
            parts.append(f"{name}{run} as (select count(*) as n, max(o_orderdate) as mx from {table}, c{run} where ({_visible_sql(table, run)}) "
                         f"and o_orderdate >= c - interval {OVERLAP_S} second and not ({seen}))")
        parts.append(f"c{run + 1} as (select case when s.mx is null or d.mx is null then c else greatest(c, least(s.mx, d.mx)) end as c "
                     f"from s{run} s, d{run} d, c{run})")
    rows = [f"""select 'orders' as table_name, o.c as cached_cursor, s.n as src_new_rows, d.n as dst_new_rows, d.n - s.n as count_drift,
  cast(floor(epoch(d.mx)) - floor(epoch(s.mx)) as bigint) as max_drift_s,
  case when d.n <> s.n then 'FAILED' else 'SUCCEEDED' end as count_verdict,
  case when (s.mx is null) <> (d.mx is null) or coalesce(abs(floor(epoch(d.mx)) - floor(epoch(s.mx))), 0) > 60 then 'FAILED' else 'SUCCEEDED' end as max_verdict,
  n.c as new_cursor, cast({run} as bigint) as run from s{run} s, d{run} d, c{run} o, c{run + 1} n""" for run in range(3)]
    return f"with {', '.join(parts)}\n" + "\nunion all ".join(rows)


@query("rec_cursor_runs", _cursor_runs_sql())
def _cursor_runs(spark, d):
    path = scratch_path(spark, f"cursor/{uuid.uuid4().hex}")
    src, dst = _sides(spark, d)
    rows = [r.reconcile_run(src.where(_visible_spark("orders", run)), dst.where(_visible_spark("orders_dst", run)), "o_orderdate", KEY,
                            "orders", path, run, CURSOR_SEED, OVERLAP_S) for run in range(3)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _visible_spark(table: str, run: int):
    return F.expr(_visible_sql(table, run).replace("timestamp '", "timestamp_ntz '"))


@query("rec_monotonic_check", """
with x as (select o_custkey, o_orderdate,
             lag(o_orderdate) over (partition by o_custkey order by o_orderkey) as prev_value from orders)
select o_custkey, count(*) as decreases from x where o_orderdate < prev_value group by 1""")
def _monotonic(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Arrival order is the load key; buckets of 1000 keys bound the work per task.
    x = with_prev_value(o, ["o_custkey"], "o_orderkey", "o_orderdate", F.expr("o_orderkey div 1000"))
    return (x.where(F.col("o_orderdate") < F.col("prev_value")).groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("decreases")))


def _suite_pairs(spark, d):
    return [r.TablePair("orders", t(spark, d, "orders"), t(spark, d, "orders_dst"), ("o_totalprice",)),
            r.TablePair("customer", t(spark, d, "customer"), t(spark, d, "customer"), ("c_acctbal",),
                        ("c_custkey", "c_name", "c_nationkey")),
            r.TablePair("supplier", t(spark, d, "supplier"), t(spark, d, "supplier"), ("s_acctbal",),
                        ("s_suppkey", "s_name", "s_nationkey"))]


def _suite_checksum_sql(tb, cols):
    row = " || ".join(canon(f"cast({c} as varchar)") for c in cols)
    return (f"select '{tb}' as table_name, 'checksum' as check_name, s.checksum as src_value, d.checksum as dst_value, "
            f"d.rows - s.rows as diff, case when {SAME_SQL} then 'SUCCEEDED' else 'FAILED' end as verdict from {_sums(row, tb)} s, {_sums(row, tb)} d")


def _suite_sql():
    stage1 = [f"select '{tb}' as table_name, * from ({_cmp_sql('row_count', 'count(*)', src, dst)})"
              for tb, src, dst in (("orders", "orders", "orders_dst"), ("customer", "customer", "customer"),
                                   ("supplier", "supplier", "supplier"))]
    # orders fails its row count, so only customer and supplier get content checks.
    stage2 = []
    for tb, col, cols in (("customer", "c_acctbal", ["c_custkey", "c_name", "c_nationkey"]),
                          ("supplier", "s_acctbal", ["s_suppkey", "s_name", "s_nationkey"])):
        cents = f"cast(sum(cast({col} as decimal(18,2))) * 100 as bigint)"
        stage2.append(f"select '{tb}' as table_name, * from ({_cmp_sql('sum_cents:' + col, cents, tb, tb)})")
        stage2.append(_suite_checksum_sql(tb, cols))
    body = "\nunion all ".join(f"select table_name, check_name, src_value, dst_value, diff, verdict from ({p})"
                               for p in stage1 + stage2)
    return body


@query("rec_suite", _suite_sql())
def _suite(spark, d):
    return r.rec_suite(_suite_pairs(spark, d))


@query("rec_discover", f"""
select 'orders' as table_name, coalesce(s.column_name, d.column_name) as column_name, s.data_type as src_type,
  d.data_type as dst_type, s.data_type is not null and d.data_type is not null as comparable
from {SRC_CAT} s full outer join {DST_CAT} d on s.column_name = d.column_name
union all
select 'customer', column_name, data_type, data_type, true from {_catalog_sql('select * from customer')}""")
def _discover(spark, d):
    t(spark, d, "orders").createOrReplaceTempView("twsrc_orders")
    t(spark, d, "orders_dst").createOrReplaceTempView("twdst_orders")
    t(spark, d, "customer").createOrReplaceTempView("twsrc_customer")
    t(spark, d, "customer").createOrReplaceTempView("twdst_customer")
    return r.rec_discover(spark, "twsrc_", "twdst_")


