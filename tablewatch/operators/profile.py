"""Column profiling, semantic typing and test suggestions.

``profile_columns`` computes every column's bounds in one aggregate pass and
its exact distinct values from one histogram of all columns; both are reshaped
to long form (one row per column). ``approx_distinct=True`` switches to
HyperLogLog sketches in the first pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.timeutil import ts_lit
from tablewatch.functions.windows import RANGE, in_ranges

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _half_up_tenths(num: str, den: str) -> Column:
    """round(100 * num / den, 1) computed in integers (half up), as double; null when den = 0."""
    return F.expr(f"case when {den} = 0 then null "
                  f"else cast(({num} * 2000 + {den}) div ({den} * 2) as double) / 10 end")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(i, v, c)``: how often each value, as text, is in the i-th column; null is not a value.

    Rows are listed as (column, value) and counted map-side before the one shuffle, so what moves is the
    distinct values of each task, not the rows, and all columns share it."""
    def text(name: str) -> Column:
        kind, c = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0)  # one zero
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(F.sort_array(F.map_entries(c)) if isinstance(kind, T.MapType) else c, {"ignoreNullFields": "false"})
        return c.cast("string")

    each = F.array(*[F.struct(F.lit(i).alias("i"), text(c).alias("v")) for i, c in enumerate(cols)])
    rows = df.select(F.explode(each).alias("x")).select("x.i", "x.v").where(F.col("v").isNotNull())
    return rows.groupBy("i", "v").agg(F.count(F.lit(1)).alias("c"))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column_name, rows, nulls)`` in one aggregate, without distinct values."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(cols)])
    return one.select("rows", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("rows") - F.col(f"nn{i}")).alias("nulls"))
                                                 for i, c in enumerate(cols)]))).select("column_name", "rows", "nulls")


def profile_columns(df: DataFrame, cols: list[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """rows, non_null, nulls, null_pct, distinct_vals, min_val, max_val per column.

    Two reads: an aggregate of counts and bounds, and the histogram of ``value_counts`` for the exact
    distinct values (``approx_distinct`` takes them from sketches in the first)."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"nn{i}"), F.min(c).cast("string").alias(f"mn{i}"), F.max(c).cast("string").alias(f"mx{i}")]
        aggs += [F.approx_count_distinct(c).alias(f"d{i}")] if approx_distinct else []
    one = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    rows = F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"), F.lit(dtypes[c]).alias("data_type"), F.col(f"nn{i}").alias("non_null"),
                 (F.col(f"d{i}") if approx_distinct else F.lit(0).cast("bigint")).alias("d"),
                 F.col(f"mn{i}").alias("min_val"), F.col(f"mx{i}").alias("max_val"))
        for i, c in enumerate(cols)]))
    long = one.select(F.col("__rows").alias("rows"), rows).withColumn("nulls", F.col("rows") - F.col("non_null"))
    if approx_distinct:
        long = long.withColumnRenamed("d", "distinct_vals")
    else:
        distinct = value_counts(df, cols).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
        long = long.join(distinct, "i", "left").withColumn("distinct_vals", F.coalesce("n", "d"))
    return long.select("column_name", "data_type", "rows", "non_null", "nulls",
                       _half_up_tenths("nulls", "rows").alias("null_pct"),
                       "distinct_vals", "min_val", "max_val")


def profile_timestamps(df: DataFrame, as_of, min_year: int = 2000, cols: list[str] | None = None) -> DataFrame:
    """Per timestamp column: values after ``as_of`` and values before ``min_year``."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, TIMES)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c) > ts_lit(as_of)).alias(f"f{i}"),
                 F.count_if(F.year(c) < min_year).alias(f"a{i}")]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"f{i}").alias("future_vals"),
                 F.col(f"a{i}").alias("ancient_vals")) for i, c in enumerate(cols)])))


def profile_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per string column: min/avg/max length and blank count (null or spaces only)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, c in enumerate(cols):
        ln = F.length(c)
        aggs += [F.min(ln).alias(f"mn{i}"), F.sum(ln).alias(f"sm{i}"), F.count(c).alias(f"n{i}"),
                 F.max(ln).alias(f"mx{i}"),
                 F.count_if(F.coalesce(F.trim(F.col(c)), F.lit("")) == "").alias(f"b{i}")]
    one = df.agg(*aggs)
    out = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"mn{i}").cast("bigint").alias("min_len"),
                 F.col(f"sm{i}").cast("bigint").alias("sum_len"), F.col(f"n{i}").alias("n"),
                 F.col(f"mx{i}").cast("bigint").alias("max_len"), F.col(f"b{i}").alias("blanks"))
        for i, c in enumerate(cols)])))
    # Average length rounded half up to 2 places, in integer arithmetic.
    avg = F.expr("case when n = 0 then null else cast((sum_len * 200 + n) div (n * 2) as double) / 100 end")
    return out.select("column_name", "min_len", avg.alias("avg_len"), "max_len", "blanks")


SHARES = (0.01, 0.5, 0.99)


def exact_quantiles(df: DataFrame, cols: list[str], shares=SHARES) -> DataFrame:
    """``(i, q)``: exact interpolated quantiles of each column, as an array in the order of ``shares``.

    Distributed rank selection: equal values are counted map-side, the histogram of all columns is dealt by
    ranges of (column, value), each range's total shifts the ranks of the ranges behind it, and only values
    that hold a wanted rank leave their range. No task sees more than its range, no buffer all values."""
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)])
    counts = (df.select(F.explode(each).alias("e")).select("e.i", "e.x").where(F.col("x").isNotNull())
              .groupBy("i", "x").agg(F.count(F.lit(1)).alias("c")))
    hist = in_ranges(counts, ["i", "x"])
    totals = hist.groupBy("i", RANGE).agg(F.sum("c").alias("t"))
    upto = Window.partitionBy("i").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("i")
    before = totals.select("i", RANGE, F.coalesce(F.sum("t").over(upto), F.lit(0)).alias("before"), F.sum("t").over(whole).alias("n"))
    inside = Window.partitionBy("i", RANGE).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.withColumn("own", F.sum("c").over(inside)).join(before, ["i", RANGE]).select(
        "i", "x", "n", (F.col("before") + F.col("own")).alias("last"), (F.col("before") + F.col("own") - F.col("c")).alias("first"))
    at = [(F.col("n") - 1) * F.lit(float(s)) for s in shares]
    # Values with the rank below or above a wanted place (ranks first .. last - 1).
    holds = [(F.col("first") <= r) & (r < F.col("last")) for p in at for r in (F.floor(p), F.ceil(p))]
    picked = ranked.where(reduce(lambda a, b: a | b, holds)).groupBy("i").agg(
        F.max("n").alias("n"), *[F.max(F.when(h, F.col("x"))).alias(f"v{k}") for k, h in enumerate(holds)])
    q = [F.when(F.ceil(p) == F.floor(p), F.col(f"v{2 * k}")).otherwise(
        (F.ceil(p) - p) * F.col(f"v{2 * k}") + (p - F.floor(p)) * F.col(f"v{2 * k + 1}")) for k, p in enumerate(at)]
    return picked.select("i", F.array(*q).alias("q"))


def profile_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
                    accuracy: int = 10000) -> DataFrame:
    """avg, sample stddev and p01/p50/p99 per numeric column.

    Quantiles are exact (see ``exact_quantiles``); ``approx=True`` takes them from sketches in the same
    aggregate as the rest."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}")]
        aggs += [F.percentile_approx(x, list(SHARES), accuracy).alias(f"p{i}")] if approx else []
    none = F.lit(None).cast("array<double>")
    long = df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"), F.col(f"a{i}").alias("a"), F.col(f"s{i}").alias("s"),
                 (F.col(f"p{i}") if approx else none).alias("p")) for i, c in enumerate(cols)])))
    if not approx:
        long = long.drop("p").join(exact_quantiles(df, cols).withColumnRenamed("q", "p"), "i", "left")

    def r(col: Column) -> Column:
        return col.cast("decimal(24,4)").cast("double")

    return long.select("column_name", r(F.col("a")).alias("avg_val"), r(F.col("s")).alias("stddev_val"),
                       *[r(F.get("p", F.lit(k))).alias(n) for k, n in enumerate(("p01", "p50", "p99"))])


def sample_distinct(df: DataFrame, col: str, n: int = 50) -> DataFrame:
    """Up to ``n`` distinct values, smallest first (ordered so the sample repeats).

    Distinct runs as a partial aggregate; the ordered limit is a TakeOrdered
    that keeps ``n`` rows per task.
    """
    return (df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull())
            .distinct().orderBy("value").limit(n)
            .select(F.lit(col).alias("column_name"), "value"))


# Name patterns used by the semantic classifier (Java/RE2-safe).
NAME_RULES = {
    "email": r"(?i)e_?mail",
    "percent": r"(?i)(pct|percent|ratio|rate)$",
    "geo": r"(?i)(^|_)(lat|lon|lng|latitude|longitude)$",
    "id": r"(?i)(^id$|_id$|key$)",
}


def classify_columns(profile: DataFrame, rows_per_category: int = 10) -> DataFrame:
    """Semantic type per profiled column (rules over profile rows and names). A text column is a category if
    its values come ``rows_per_category`` times on average: a share, so growing data keeps its type."""
    name, dtype = F.col("column_name"), F.col("data_type")
    numeric = dtype.rlike(r"^(tinyint|smallint|int|bigint|float|double|decimal)")
    unique = (F.col("distinct_vals") == F.col("non_null")) & (F.col("nulls") == 0)
    sem = (F.when(dtype == "boolean", "boolean")
           .when(dtype.rlike("^(timestamp|date)"), "timestamp")
           .when(name.rlike(NAME_RULES["id"]) & unique, "id")
           .when(name.rlike(NAME_RULES["id"]), "foreign_key")
           .when(name.rlike(NAME_RULES["email"]), "email")
           .when(name.rlike(NAME_RULES["geo"]), "geo")
           .when(name.rlike(NAME_RULES["percent"]), "percent")
           .when(numeric & (F.col("distinct_vals") <= 2) & (F.col("min_val") == "0")
                 & (F.col("max_val") == "1"), "boolean")
           .when(numeric, "measure")
           .when(F.col("distinct_vals") * rows_per_category <= F.col("non_null"), "category")
           .otherwise("free_text"))
    return profile.select("column_name", "data_type", sem.alias("semantic_type"))


# Semantic type -> tests to write (the test catalogue).
SUGGESTED_TESTS = [
    ("id", "not_null"), ("id", "unique"),
    ("foreign_key", "referential"), ("foreign_key", "not_null"),
    ("timestamp", "not_null"), ("timestamp", "not_future"), ("timestamp", "not_ancient"),
    ("timestamp", "freshness"),
    ("measure", "non_negative"), ("measure", "range"), ("measure", "outlier_sigma"),
    ("category", "accepted_values"), ("category", "not_null"),
    ("free_text", "not_blank"), ("free_text", "max_length"), ("free_text", "placeholder"),
    ("free_text", "stray_space"),
    ("email", "regex"), ("boolean", "boolean_domain"), ("percent", "percent"), ("geo", "geo"),
]


def suggest_tests(classified: DataFrame) -> DataFrame:
    """Join the classified columns with the rule table (broadcast: it is fixed size)."""
    spark = classified.sparkSession
    rules = spark.createDataFrame(SUGGESTED_TESTS, "semantic_type string, test_kind string")
    return classified.join(F.broadcast(rules), "semantic_type", "inner").select(
        "column_name", "semantic_type", "test_kind")
