"""ELT transforms: clean, dedupe, derive, filter, roll up, evolve schemas.

All are lazy DataFrame functions; a pipeline is a chain of them and one write.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.timeutil import ts_lit


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def dedupe_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keep the first row per key by an explicit order (input order is not defined in Spark).

    Written as ``min(struct(order..., rest...))`` per key: a plain aggregate, so it is
    combined map side and a key holding a third of all rows never lands whole in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.min(F.struct(*[F.col(c) for c in order_by + rest])).alias("__first")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__first.{c}").alias(c) for c in order_by + rest]) \
        .select(*df.columns)


def derive_amount(df: DataFrame, out: str, left: str, right: str, op: str = "-") -> DataFrame:
    """``out = left op right`` for the three derived measures (total, net, available)."""
    a, b = F.col(left), F.col(right)
    expr = {"*": a * b, "-": a - b, "+": a + b}[op]
    return df.withColumn(out, expr)


def filter_measure(df: DataFrame, col: str, op: str = ">") -> DataFrame:
    """Keep ``col > 0`` (strict) or ``col >= 0`` (non-strict), per pipeline."""
    if op not in (">", ">="):
        raise ValueError("op must be '>' or '>='")
    return df.where(F.col(col) > 0 if op == ">" else F.col(col) >= 0)


def clean_pipeline(df: DataFrame, keys: list[str], order_by: list[str], out: str, left: str, right: str,
                   derive_op: str = "-", filter_op: str = ">=", required: list[str] | None = None) -> DataFrame:
    """drop rows with null keys -> dedupe -> derive -> filter, one lazy plan."""
    x = drop_null_keys(df, required or keys)
    x = dedupe_by_key(x, keys, order_by)
    x = derive_amount(x, out, left, right, derive_op)
    return filter_measure(x, out, filter_op)


def status_total(df: DataFrame, amount: str, status_col: str, status: str) -> DataFrame:
    return df.where(F.col(status_col) == status).agg(
        (F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")), F.lit(0)) * 100).cast("bigint").alias("total_cents"))


def status_count(df: DataFrame, status_col: str, status: str) -> DataFrame:
    return df.where(F.col(status_col) == status).agg(F.count(F.lit(1)).alias("n"))


def below_threshold_count(df: DataFrame, col: str, threshold_col: Column | str) -> DataFrame:
    thr = F.col(threshold_col) if isinstance(threshold_col, str) else threshold_col
    return df.where(F.col(col) < thr).agg(F.count(F.lit(1)).alias("n"))


def rows_since_watermark(df: DataFrame, col: str, watermark) -> DataFrame:
    n = df.where(F.col(col) > ts_lit(watermark)).agg(F.count(F.lit(1)).alias("new_rows"))
    return n.withColumn("action", F.when(F.col("new_rows") > 0, "load").otherwise("skip"))


def lookback_rollup(facts: DataFrame, ts_col: str, group_cols: list[str], measure: str, as_of, days: int) -> DataFrame:
    recent = facts.where((F.col(ts_col) >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
                         & (F.col(ts_col) < ts_lit(as_of)))
    return recent.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.col(measure).cast("decimal(18,2)")) * 100).cast("bigint")
        .alias("total_cents"))


PAIR_BLOCK = 10_000


def scenario_cross(df: DataFrame, a_name: str, a_values: list, b_name: str, b_values: list,
                   predicate) -> DataFrame:
    """Every (a, b) parameter pair run on the table.

    The caller's two lists are crossed and broadcast in blocks of at most ``PAIR_BLOCK`` pairs, one scan of
    the table a block: each row is matched to the pairs it satisfies. Pairs with no row still appear with
    count 0.
    """
    spark = df.sparkSession
    a = spark.createDataFrame([(v,) for v in a_values], [a_name])
    step = max(1, PAIR_BLOCK // max(1, len(a_values)))
    blocks = [a.crossJoin(spark.createDataFrame([(v,) for v in b_values[i:i + step]], [b_name])) for i in range(0, len(b_values), step)]
    found = [df.join(F.broadcast(x), predicate(df, F.col(a_name), F.col(b_name)), "inner").groupBy(a_name, b_name).agg(F.count(F.lit(1)).alias("n"))
             for x in blocks]
    pairs, counts = (reduce(lambda x, y: x.unionByName(y), parts) for parts in (blocks, found))
    return pairs.join(counts, [a_name, b_name], "left").select(a_name, b_name,
                                                               F.coalesce("n", F.lit(0)).alias("n"))


# Widening lattice: from type -> types that hold all its values (a double does not hold all bigints).
_WIDEN = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"}, "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"}, "float": {"double"},
    "date": {"timestamp", "timestamp_ntz"},
}


# Digits of the integer types: a decimal with as many before its point holds all their values.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _relation(old: str, new: str) -> str:
    if old == new:
        return "same"
    if new in _WIDEN.get(old, set()):
        return "widened"
    if old.startswith("decimal") and new.startswith("decimal"):
        (p1, s1), (p2, s2) = [tuple(int(x) for x in t[8:-1].split(",")) for t in (old, new)]
        return "widened" if s2 >= s1 and p2 - s2 >= p1 - s1 else "narrowed"
    if old in _DIGITS and new.startswith("decimal"):
        precision, scale = (int(x) for x in new[8:-1].split(","))
        return "widened" if precision - scale >= _DIGITS[old] else "narrowed"
    if new in _WIDEN.get(old, set()) or old in _WIDEN.get(new, set()):
        return "narrowed"
    return "changed"


def schema_compat(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per column: same / added / widened / narrowed / changed / removed, and whether the
    change is additive. Built from the two schemas (no data is read)."""
    spark = old.sparkSession
    o = {f.name: f.dataType.simpleString() for f in old.schema.fields}
    n = {f.name: f.dataType.simpleString() for f in new.schema.fields}
    rows = []
    for name in list(o) + [c for c in n if c not in o]:
        if name not in n:
            state = "removed"
        elif name not in o:
            state = "added"
        else:
            state = _relation(o[name], n[name])
        rows.append((name, o.get(name), n.get(name), state, state in ("same", "added", "widened")))
    return spark.createDataFrame(rows, "column_name string, old_type string, new_type string, state string, "
                                       "additive boolean")


def _common_type(t: str | None, b: str | None) -> str:
    if t is None or b is None:
        return t or b
    if t == b:
        return t
    rel = _relation(t, b)
    if rel == "widened":
        return b
    if _relation(b, t) == "widened":
        return t
    raise ValueError(f"incompatible types {t} and {b}")


def evolve_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union under an additively evolved schema: columns missing on either side are
    filled with nulls, a batch type that is narrower is cast up, a wider one widens
    the target; incompatible types are refused (nothing is dropped or narrowed)."""
    t = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    cols = [(c, _common_type(t.get(c), b.get(c))) for c in list(t) + [c for c in b if c not in t]]

    def conform(df):
        present = set(df.columns)
        return df.select(*[(F.col(c) if c in present else F.lit(None)).cast(ty).alias(c) for c, ty in cols])
    return conform(target).unionByName(conform(batch))


def landed_check(df: DataFrame, expected: list[str]) -> DataFrame:
    """After a load: rows > 0 and every expected column present (schema check, one count)."""
    missing = [c for c in expected if c not in df.columns]
    n = df.limit(1).agg(F.count(F.lit(1)).alias("has_rows"))
    return n.select((F.col("has_rows") > 0).alias("has_rows"), F.lit(",".join(missing)).alias("missing_columns"),
                    ((F.col("has_rows") > 0) & F.lit(not missing)).alias("ok"))


def coalesce_variants(df: DataFrame, base: str, order: tuple = (), out_type: str = "string") -> DataFrame:
    """Rebuild one logical value from a column and its ``<base>__v_<type>`` variants.

    The base column comes first, then the variants in ``order``, then all others as they stand; the
    first that is not null wins. The result is text, which holds every variant; for another
    ``out_type`` the first value that can be read as that type wins, and none raises."""
    prefix = f"{base}__v_"
    variants = [c for c in df.columns if c.startswith(prefix)]
    first = [f"{prefix}{t}" for t in order if f"{prefix}{t}" in variants]
    texts = [F.col(f"`{c}`").cast("string") for c in
             [base] * (base in df.columns) + first + [c for c in variants if c not in first]]
    if out_type != "string":
        texts = [c.try_cast(out_type) for c in texts]
    value = F.coalesce(*texts) if texts else F.lit(None).cast(out_type)
    return df.withColumn(base, value).drop(*variants)
