"""Tests on nested and JSON documents, one row per document.

Documents are JSON text; ``parse_docs`` parses them once with an explicit
schema (``from_json``), validity comes from ``try_parse_json``. Every test is a
column expression over the parsed struct using higher-order functions
(``forall``, ``exists``, ``filter``, ``size``), so it runs inside whole-stage
code generation with no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doc_valid(df: DataFrame, doc_col: str = "doc") -> Column:
    """Parses, and the top level is an object: of text that parses, what starts with a brace."""
    text = F.col(doc_col)
    return F.coalesce(text.rlike(r"^[ \t\r\n]*\{") & F.try_parse_json(text).isNotNull(), F.lit(False))


def parse_docs(df: DataFrame, schema: str, doc_col: str = "doc", out: str = "p") -> DataFrame:
    """Every document with its parsed struct in ``out``: null if it is not valid, on which every
    test answers false."""
    return df.withColumn(out, F.when(doc_valid(df, doc_col), F.from_json(F.col(doc_col), schema)))


def _at(doc_col: str, path: str) -> Column:
    """The JSON value at a path, JSON null included; SQL null if there is none."""
    return F.try_variant_get(F.try_parse_json(F.col(doc_col)), path, "variant")


def path_equals(doc_col: str, path: str, value) -> Column:
    """The value at the path has the kind of ``value`` (text, number or boolean) and equals it."""
    v = _at(doc_col, path)
    kind = F.schema_of_variant(v)
    if isinstance(value, bool):
        same = (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
    elif isinstance(value, (int, float)):
        same = ~kind.isin("STRING", "BOOLEAN", "VOID") & (F.try_variant_get(v, "$", "double") == F.lit(float(value)))
    else:
        same = (kind == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(value))
    return F.coalesce(same, F.lit(False))


def path_present(doc_col: str, path: str) -> Column:
    """There is a value at the path; JSON null is one."""
    return _at(doc_col, path).isNotNull()


def regex_count(text_col: str, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_count(F.col(text_col), F.lit(f"(?i){pattern}" if ignore_case else pattern))


def regex_at_least(text_col: str, pattern: str, minimum: int = 1, ignore_case: bool = False) -> Column:
    """The pattern comes ``minimum`` times or more; false for a null text."""
    return F.coalesce(regex_count(text_col, pattern, ignore_case) >= minimum, F.lit(False))


def field_at(item: Column, path: str) -> Column:
    """A field of a struct by a dotted path."""
    for name in path.split("."):
        item = item[name]
    return item


def min_children(arr: Column, n: int) -> Column:
    return F.coalesce(F.size(arr) >= n, F.lit(False))


def children_missing(arr: Column, field: str) -> Column:
    """Children that lack ``field`` (null or absent)."""
    return F.coalesce(F.filter(arr, lambda x: x[field].isNull()), F.array())


def all_children_have(arr: Column, field: str) -> Column:
    """Every child has the field; false when there are none."""
    return F.coalesce((F.size(arr) > 0) & F.forall(arr, lambda x: x[field].isNotNull()), F.lit(False))


def every_item(arr: Column, field: str, value) -> Column:
    """The field (a dotted path) equals value in all items; false when there are none. An item without the field differs."""
    return F.coalesce((F.size(arr) > 0) & F.forall(arr, lambda x: F.coalesce(field_at(x, field) == F.lit(value), F.lit(False))), F.lit(False))


def some_item(arr: Column, field: str, value) -> Column:
    """The field (a dotted path) equals value in at least one item."""
    return F.coalesce(F.exists(arr, lambda x: F.coalesce(field_at(x, field) == F.lit(value), F.lit(False))), F.lit(False))


def children_without(doc_col: str, path: str, field: str, name: str) -> Column:
    """Names of the children (elements of the array at ``path``) that lack ``field``; a JSON null is a value.

    On the JSON itself: in a parsed struct an absent field and a JSON null look the same. A child without a
    name is listed by its place, from 0."""
    items = F.try_variant_get(F.try_parse_json(F.col(doc_col)), path, "array<variant>")
    lacks = F.filter(F.transform(items, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                     lambda s: F.try_variant_get(s["x"], f"$.{field}", "variant").isNull())
    return F.coalesce(F.transform(lacks, lambda s: F.coalesce(F.try_variant_get(s["x"], f"$.{name}", "string"), s["i"].cast("string"))),
                      F.array().cast("array<string>"))


def any_child_linked(arr: Column, links: str) -> Column:
    return F.coalesce(F.exists(arr, lambda x: F.size(F.coalesce(x[links], F.array())) > 0), F.lit(False))


def edge_exists(arr: Column, id_field: str, links: str, child, parent) -> Column:
    return F.coalesce(F.exists(arr, lambda x: (x[id_field] == F.lit(child))
                               & F.array_contains(F.coalesce(x[links], F.array()), F.lit(parent))), F.lit(False))


def item_in_enum(arr: Column, field: str, allowed: list) -> Column:
    return F.coalesce(F.forall(arr, lambda x: x[field].isNull() | x[field].isin(*allowed)), F.lit(False))


def conditional_required(arr: Column, kind_field: str, kind, required: str) -> Column:
    """Items of ``kind`` must carry ``required``, and at least one such item exists."""
    is_kind = (lambda x: x[kind_field] == F.lit(kind))
    return F.coalesce(F.exists(arr, is_kind) & F.forall(arr, lambda x: ~is_kind(x) | x[required].isNotNull()),
                      F.lit(False))


def status_covered(arr: Column, field: str, statuses) -> Column:
    """Every one of the statuses occurs among the items."""
    wanted = statuses if isinstance(statuses, (list, tuple)) else [statuses]
    found = F.transform(arr, lambda x: x[field])
    return F.coalesce(F.forall(F.array(*[F.lit(s) for s in wanted]), lambda s: F.array_contains(found, s)), F.lit(False))


def duplicate_ids(arr: Column, id_field: str) -> Column:
    ids = F.transform(arr, lambda x: x[id_field])
    return F.coalesce(F.size(ids) != F.size(F.array_distinct(ids)), F.lit(False))


def json_string_empty(col: str, element_type: str = "array<string>") -> Column:
    """A field holding JSON text (``"[]"``, ``"{...}"``) is parsed before the emptiness test."""
    return F.coalesce(F.size(F.from_json(F.col(col), element_type)) == 0, F.lit(True))


def dangling_edges(parsed: DataFrame, id_col: str, arr: str, id_field: str, links: str) -> DataFrame:
    """Links that name no child of the same document, compared inside the document: no join."""
    ids = F.transform(F.col(arr), lambda x: x[id_field])
    items = parsed.select(id_col, ids.alias("__ids"), F.explode(arr).alias("it"))
    lost = F.filter(F.col(f"it.{links}"), lambda r: ~F.array_contains(F.col("__ids"), r))
    return items.select(id_col, F.col(f"it.{id_field}").alias(id_field), F.explode(F.array_distinct(lost)).alias("ref"))


def unreferenced_outputs(parsed: DataFrame, id_col: str, arr: str, id_field: str, links: str, flag: str) -> DataFrame:
    """Items flagged to publish outputs that no item of the document references: no join."""
    used = F.flatten(F.transform(F.col(arr), lambda x: F.coalesce(x[links], F.array())))
    items = parsed.select(id_col, used.alias("__used"), F.explode(arr).alias("it"))
    lost = F.col(f"it.{flag}") & ~F.array_contains("__used", F.col(f"it.{id_field}"))
    return items.where(lost).select(id_col, F.col(f"it.{id_field}").alias(id_field)).distinct()


REFERENCE_PATTERN = r"^\$\{\{.*\}\}$"


def literal_where_reference(parsed: DataFrame, id_col: str, map_col: str) -> DataFrame:
    """Map entries holding a hard-coded literal where a ``${{ ... }}`` reference is expected."""
    kv = parsed.select(id_col, F.explode(map_col).alias("key", "value"))
    return kv.where(~F.col("value").rlike(REFERENCE_PATTERN)).select(id_col, "key")
