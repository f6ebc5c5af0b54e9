"""Registered nested/JSON document queries (section 2.12).

Documents: one JSON object per order, built by Spark from ``lineitem`` (items
carry line, part, flag, status, qty, depends_on links, a publish flag and an
optional ship mode). Every 50th document is truncated (invalid JSON).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewatch.operators import nested as n
from tablewatch.plans.common import query, t

DOC_SCHEMA = ("struct<order_key:bigint, status:string, priority:string, "
              "items:array<struct<line:int, part:bigint, flag:string, status:string, qty:double, "
              "depends_on:array<int>, publishes:boolean, ship_mode:string>>, "
              "tags_json:string, params:map<string,string>>")


def docs(spark, d):
    li = t(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    deps = (F.when(ln == 1, F.lit(None).cast("array<int>"))
            .when((ln == 3) & (F.col("l_orderkey") % 7 == 0), F.array(ln - 1, F.lit(9)))
            .otherwise(F.array(ln - 1)))
    item = F.struct(ln.alias("line"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"),
                    F.col("l_linestatus").alias("status"), F.col("l_quantity").alias("qty"), deps.alias("depends_on"),
                    (F.col("l_quantity") > 40).alias("publishes"),
                    F.when(ln % 2 == 0, F.lit("AIR")).alias("ship_mode"))
    g = li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        F.collect_list(item).alias("items"), F.max("l_linestatus").alias("status"),
        F.bool_or(F.col("l_returnflag") == "R").alias("has_r"))
    k = F.col("doc_id")
    body = F.struct(k.alias("order_key"), "status", F.when(F.col("has_r"), F.lit("high")).alias("priority"), "items",
                    F.when(k % 4 == 0, F.lit("[]")).otherwise(F.lit('["a"]')).alias("tags_json"),
                    F.create_map(F.lit("target"), F.when(k % 5 == 0, F.lit("literal_table"))
                                 .otherwise(F.lit("${{ tasks.load.output }}"))).alias("params"))
    js = F.to_json(body)
    # Every 50th document is cut short: not valid JSON any more.
    return g.select("doc_id", F.when(k % 50 == 0, F.substring(js, 1, 10)).otherwise(js).alias("doc"))


def parsed(spark, d):
    return n.parse_docs(docs(spark, d), DOC_SCHEMA)


ITEMS = """items as (select l_orderkey as doc_id, l_linenumber as line, l_partkey as part, l_returnflag as flag,
  l_linestatus as status, l_quantity as qty,
  case when l_linenumber = 1 then null when l_linenumber = 3 and l_orderkey % 7 = 0 then [l_linenumber - 1, 9]
       else [l_linenumber - 1] end as depends_on,
  l_quantity > 40 as publishes, case when l_linenumber % 2 = 0 then 'AIR' end as ship_mode
  from lineitem where l_orderkey % 50 <> 0)"""


def q(sql: str) -> str:
    return f"with {ITEMS}\n{sql}"


def answers(sql: str, invalid: str = "false") -> str:
    """One row per document; documents that are not valid answer ``invalid``."""
    return q(f"{sql}\nunion all select distinct l_orderkey, {invalid} from lineitem where l_orderkey % 50 = 0")


@query("doc_valid", "select l_orderkey as doc_id, l_orderkey % 50 <> 0 as valid from lineitem group by 1")
def _valid(spark, d):
    dd = docs(spark, d)
    return dd.select("doc_id", n.doc_valid(dd).alias("valid"))


@query("path_equals", answers("select doc_id, max(status) = 'F' as result from items group by 1"))
def _path_equals(spark, d):
    return parsed(spark, d).select("doc_id", n.path_equals("doc", "$.status", "F").alias("result"))


@query("path_present", answers("select doc_id, bool_or(flag = 'R') as result from items group by 1"))
def _path_present(spark, d):
    return parsed(spark, d).select("doc_id", n.path_present("doc", "$.priority").alias("result"))


@query("regex_count", "select doc_id, cast(len(regexp_extract_all(text, '[0-9]+')) as integer) as hits from documents "
                      "where len(regexp_extract_all(text, '[0-9]+')) >= 3")
def _regex_count(spark, d):
    docs_ = t(spark, d, "documents").select("doc_id", n.regex_count("text", "[0-9]+").alias("hits"))
    return docs_.where(F.col("hits") >= 3)


@query("min_children", answers("select doc_id, count(*) >= 3 as result from items group by 1"))
def _min_children(spark, d):
    return parsed(spark, d).select("doc_id", n.min_children(F.col("p.items"), 3).alias("result"))


@query("all_children_have", answers("""select doc_id, bool_and(depends_on is not null) as result,
  cast(count_if(depends_on is null) as integer) as missing from items group by 1""", "false, 0"))
def _all_children(spark, d):
    p = parsed(spark, d)
    return p.select("doc_id", n.all_children_have(F.col("p.items"), "depends_on").alias("result"),
                    F.size(n.children_missing(F.col("p.items"), "depends_on")).alias("missing"))


@query("every_item", answers("select doc_id, bool_and(flag = 'N') as result from items group by 1"))
def _every(spark, d):
    return parsed(spark, d).select("doc_id", n.every_item(F.col("p.items"), "flag", "N").alias("result"))


@query("some_item", answers("select doc_id, bool_or(flag = 'R') as result from items group by 1"))
def _some(spark, d):
    return parsed(spark, d).select("doc_id", n.some_item(F.col("p.items"), "flag", "R").alias("result"))


@query("any_child_linked", answers("select doc_id, bool_or(coalesce(len(depends_on), 0) > 0) as result from items group by 1"))
def _linked(spark, d):
    return parsed(spark, d).select("doc_id", n.any_child_linked(F.col("p.items"), "depends_on").alias("result"))


@query("edge_exists", answers("select doc_id, bool_or(line = 2 and list_contains(depends_on, 1)) as result "
                        "from items group by 1"))
def _edge(spark, d):
    return parsed(spark, d).select("doc_id", n.edge_exists(F.col("p.items"), "line", "depends_on", 2, 1).alias("result"))


@query("dangling_edges", q("""select distinct doc_id, line, ref from (select doc_id, line, unnest(depends_on) as ref from items) r
where not exists (select 1 from items i where i.doc_id = r.doc_id and i.line = r.ref)"""))
def _dangling(spark, d):
    return n.dangling_edges(parsed(spark, d), "doc_id", "p.items", "line", "depends_on").distinct()


@query("item_in_enum", answers("select doc_id, bool_and(flag is null or flag in ('A', 'N')) as result from items group by 1"))
def _enum(spark, d):
    return parsed(spark, d).select("doc_id", n.item_in_enum(F.col("p.items"), "flag", ["A", "N"]).alias("result"))


@query("conditional_required", answers("""select doc_id,
  bool_or(flag = 'R') and bool_and(flag <> 'R' or ship_mode is not null) as result from items group by 1"""))
def _conditional(spark, d):
    return parsed(spark, d).select(
        "doc_id", n.conditional_required(F.col("p.items"), "flag", "R", "ship_mode").alias("result"))


@query("status_covered", answers("select doc_id, bool_or(status = 'O') and bool_or(status = 'F') as result from items group by 1"))
def _covered(spark, d):
    return parsed(spark, d).select("doc_id", n.status_covered(F.col("p.items"), "status", ["O", "F"]).alias("result"))


@query("unreferenced_outputs", q("""select distinct doc_id, line from items i where publishes and not exists (
  select 1 from (select doc_id, unnest(depends_on) as ref from items) r where r.doc_id = i.doc_id and r.ref = i.line)"""))
def _unreferenced(spark, d):
    return n.unreferenced_outputs(parsed(spark, d), "doc_id", "p.items", "line", "depends_on", "publishes")


@query("literal_where_reference", "select distinct l_orderkey as doc_id, 'target' as key from lineitem "
                                  "where l_orderkey % 5 = 0 and l_orderkey % 50 <> 0")
def _literal(spark, d):
    return n.literal_where_reference(parsed(spark, d), "doc_id", "p.params")


@query("duplicate_ids", answers("select doc_id, count(*) <> count(distinct line) as result from items group by 1"))
def _dup_ids(spark, d):
    return parsed(spark, d).select("doc_id", n.duplicate_ids(F.col("p.items"), "line").alias("result"))


@query("json_string_fields", answers("select doc_id, doc_id % 4 = 0 as empty_tags from items group by 1", "true"))
def _json_strings(spark, d):
    return parsed(spark, d).select("doc_id", n.json_string_empty("p.tags_json").alias("empty_tags"))
