"""Data-quality tests.

Row tests are ``(df, ...) -> DataFrame`` of violating rows. Each is also
exposed as a *predicate* (``<name>_predicate``) so a suite can fuse many tests
of one table into a single scan with conditional counts. Tests that need a
join or a group (unique, referential, outlier) are plans of their own.
Nulls pass every test except ``not_null`` and ``not_blank`` (SQL three-valued
logic, the same in every engine).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.timeutil import epoch_seconds, ts_lit

# Placeholder strings treated as junk.
PLACEHOLDERS = ("n/a", "na", "null", "none", "test", "-", "unknown")

# Fixed value: the e-mail format.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- predicates (true = violation) -------------------------------------------------

def not_null_predicate(col) -> Column:
    return _c(col).isNull()


def not_future_predicate(col, as_of) -> Column:
    return _c(col) > ts_lit(as_of)


def not_ancient_predicate(col, min_year: int = 2000) -> Column:
    return F.year(_c(col)) < F.lit(min_year)


def ts_order_predicate(earlier, later) -> Column:
    """Violation when the value that must come first is after the second."""
    return _c(earlier) > _c(later)


def older_than_predicate(col, as_of, days: int) -> Column:
    return _c(col) < ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def non_negative_predicate(col) -> Column:
    return _c(col) < 0


def range_predicate(col, lo, hi) -> Column:
    return ~_c(col).between(F.lit(lo), F.lit(hi))


def accepted_values_predicate(col, values) -> Column:
    return ~_c(col).isin(list(values))


def not_blank_predicate(col) -> Column:
    return F.coalesce(F.trim(_c(col)), F.lit("")) == ""


def max_length_predicate(col, max_len: int) -> Column:
    return F.length(_c(col)) > F.lit(int(max_len))


def placeholder_predicate(col, placeholders=PLACEHOLDERS) -> Column:
    return F.lower(_c(col)).isin(list(placeholders))


def stray_space_predicate(col) -> Column:
    return _c(col) != F.trim(_c(col))


def regex_predicate(col, pattern: str = EMAIL_PATTERN) -> Column:
    return ~_c(col).rlike(pattern)


def boolean_domain_predicate(col, numeric: bool = False) -> Column:
    allowed = [0, 1] if numeric else [True, False]
    return _c(col).isNotNull() & ~_c(col).isin(allowed)


def percent_predicate(col, upper: int = 100) -> Column:
    return ~_c(col).between(F.lit(0), F.lit(upper))


def geo_predicate(lat, lon) -> Column:
    return (~_c(lat).between(F.lit(-90), F.lit(90))) | (~_c(lon).between(F.lit(-180), F.lit(180)))


def row_sum_predicate(total, parts: list, scale: int = 2) -> Column:
    dec = f"decimal(18,{scale})"
    s = None
    for p in parts:
        term = _c(p).cast(dec)
        s = term if s is None else s + term
    return _c(total).cast(dec) != s


# --- row tests (V) -----------------------------------------------------------------

def dq_not_null(df: DataFrame, col) -> DataFrame:
    return df.where(not_null_predicate(col))


def dq_not_future(df: DataFrame, col, as_of) -> DataFrame:
    return df.where(not_future_predicate(col, as_of))


def dq_not_ancient(df: DataFrame, col, min_year: int = 2000) -> DataFrame:
    return df.where(not_ancient_predicate(col, min_year))


def dq_ts_order(df: DataFrame, earlier, later) -> DataFrame:
    return df.where(ts_order_predicate(earlier, later))


def dq_ts_order_across(child: DataFrame, parent: DataFrame, on, child_ts: str, parent_ts: str) -> DataFrame:
    """Ordering test when the two timestamps sit in two tables: join, then compare."""
    joined = child.join(parent.select(*([on] if isinstance(on, str) else on), parent_ts), on, "inner")
    return joined.where(F.col(parent_ts) > F.col(child_ts))


def dq_older_than(df: DataFrame, col, as_of, days: int = 7) -> DataFrame:
    return df.where(older_than_predicate(col, as_of, days))


def dq_non_negative(df: DataFrame, col) -> DataFrame:
    return df.where(non_negative_predicate(col))


def dq_range(df: DataFrame, col, lo, hi) -> DataFrame:
    return df.where(range_predicate(col, lo, hi))


def dq_accepted_values(df: DataFrame, col, values) -> DataFrame:
    return df.where(accepted_values_predicate(col, values))


def dq_not_blank(df: DataFrame, col) -> DataFrame:
    return df.where(not_blank_predicate(col))


def dq_max_length(df: DataFrame, col, max_len: int) -> DataFrame:
    return df.where(max_length_predicate(col, max_len))


def dq_placeholder(df: DataFrame, col, placeholders=PLACEHOLDERS) -> DataFrame:
    return df.where(placeholder_predicate(col, placeholders))


def dq_stray_space(df: DataFrame, col) -> DataFrame:
    return df.where(stray_space_predicate(col))


def dq_regex(df: DataFrame, col, pattern: str = EMAIL_PATTERN) -> DataFrame:
    return df.where(regex_predicate(col, pattern))


def dq_boolean_domain(df: DataFrame, col, numeric: bool = False) -> DataFrame:
    return df.where(boolean_domain_predicate(col, numeric))


def dq_percent(df: DataFrame, col, upper: int = 100) -> DataFrame:
    return df.where(percent_predicate(col, upper))


def dq_geo(df: DataFrame, lat, lon) -> DataFrame:
    return df.where(geo_predicate(lat, lon))


def dq_row_sum(df: DataFrame, total, parts: list, scale: int = 2) -> DataFrame:
    return df.where(row_sum_predicate(total, parts, scale))


def dq_unique(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their count.

    Partial aggregation runs map side, so a hot key costs one row per task
    before the shuffle. Null keys are kept as their own group (``not_null``
    reports them).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dq_unique_composite(df: DataFrame, keys: list) -> DataFrame:
    return dq_unique(df, keys)


def dq_referential(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent.

    Left anti join on the parent key projection. Spark broadcasts the parent
    only when its size estimate is under the broadcast threshold; otherwise a
    shuffled anti join runs (AQE may still switch at runtime on real sizes).
    """
    parent_keys = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    return (child.where(F.col(fk).isNotNull())
            .join(parent_keys, F.col(fk) == F.col("__pk"), "left_anti"))


def dq_outlier_sigma(df: DataFrame, col: str, k: float = 3.0, population: bool = False) -> DataFrame:
    """Rows with ``abs(x - avg) > k * stddev``.

    The statistics are one row (a global aggregate), joined back with a
    broadcast cross join of that single row -- never an unpartitioned window.
    """
    sd = F.stddev_pop(col) if population else F.stddev_samp(col)
    stats = df.agg(F.avg(col).alias("__avg"), sd.alias("__sd"))
    return (df.crossJoin(F.broadcast(stats))
            .where(F.abs(F.col(col) - F.col("__avg")) > F.lit(k) * F.col("__sd"))
            .drop("__avg", "__sd"))


def dq_freshness(df: DataFrame, col: str, as_of, lag_hours: int) -> DataFrame:
    """One row (with ``max_ts``) when the newest value is older than ``as_of - lag``, or there is none."""
    m = df.agg(F.max(col).alias("max_ts"))
    return m.where(F.col("max_ts").isNull() | (F.col("max_ts") < ts_lit(as_of) - F.expr(f"INTERVAL {int(lag_hours)} HOURS")))


def dq_hours_stale(df: DataFrame, col: str, as_of) -> DataFrame:
    """Scalar: whole hours between ``max(col)`` and ``as_of``."""
    m = df.agg(F.max(col).alias("max_ts"))
    return m.select(
        "max_ts",
        F.floor((epoch_seconds(ts_lit(as_of)) - epoch_seconds("max_ts")) / 3600).cast("bigint")
        .alias("hours_stale"))


def dq_not_empty(df: DataFrame) -> DataFrame:
    """One row when the table is empty. ``limit(1)`` keeps the count cheap."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") == 0).select(F.lit(1).alias("empty_table"))


def dq_row_count_bounds(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Scalar: 1 when the row count is outside [lo, hi], else 0."""
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    return n.select("row_count", F.when(F.col("row_count").between(lo, hi), 0).otherwise(1)
                    .alias("out_of_bounds"))


def dq_min_rows(df: DataFrame, min_rows: int) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    return n.select("row_count", (F.col("row_count") < min_rows).cast("int").alias("below_min"))


def dq_null_rate(df: DataFrame, col: str, tolerance_bp: int = 500) -> DataFrame:
    """Scalar null rate in basis points (integer unit), and whether it exceeds the tolerance."""
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.count(col).alias("non_null"))
    bp = F.when(F.col("rows") == 0, F.lit(None)).otherwise(
        F.floor((F.col("rows") - F.col("non_null")) * 10000 / F.col("rows")).cast("bigint"))
    return agg.select("rows", (F.col("rows") - F.col("non_null")).alias("nulls"), bp.alias("null_bp"),
                      ((F.col("rows") - F.col("non_null")) * 10000 > F.col("rows") * tolerance_bp).alias("over_tolerance"))


def dq_cardinality(df: DataFrame, col: str, lo: int, hi: int, approx: bool = False) -> DataFrame:
    """One row when the distinct count falls outside [lo, hi]."""
    d = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    agg = df.agg(d.alias("distinct_vals"))
    return agg.where(~F.col("distinct_vals").between(lo, hi))


def every_day(daily: DataFrame, value_col: str) -> DataFrame:
    """A daily series with a row for every day from the first to the last; days without rows are 0.
    One row per day: small whatever the table."""
    dated = daily.where(F.col("day").isNotNull())
    span = dated.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).where(F.col("lo").isNotNull())
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(dated, "day", "left").withColumn(value_col, F.coalesce(F.col(value_col), F.lit(0)))


def daily_counts(df: DataFrame, ts_col: str) -> DataFrame:
    return every_day(df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n")), "n")


def dq_volume_drop(df: DataFrame, ts_col: str, tolerance_pct: int = 20, history_days: int = 7) -> DataFrame:
    """Days whose row count is below the trailing average by more than the tolerance.

    The series is one row per day (already aggregated), so the window over it
    is tiny regardless of table size.
    """
    d = daily_counts(df, ts_col)
    w = Window.orderBy("day").rowsBetween(-history_days, -1)
    hist = d.withColumn("hist_avg", F.avg("n").over(w)).withColumn("hist_days", F.count("n").over(w))
    return (hist.where((F.col("hist_days") == history_days)
                       & (F.col("n") * 100 < F.col("hist_avg") * (100 - tolerance_pct)))
            .select("day", "n", F.round(F.col("hist_avg").cast("decimal(18,6)"), 2).alias("hist_avg")))


def dq_anomaly(df: DataFrame, ts_col: str, window_days: int = 14, z: float = 3.0,
               value_col: str | None = None) -> DataFrame:
    """Trailing z-score anomaly on a daily metric (row count, or sum of ``value_col``)."""
    metric = F.count(F.lit(1)) if value_col is None else F.sum(value_col)
    d = every_day(df.groupBy(F.to_date(ts_col).alias("day")).agg(metric.cast("double").alias("metric")), "metric")
    w = Window.orderBy("day").rowsBetween(-window_days, -1)
    s = (d.withColumn("mu", F.avg("metric").over(w))
         .withColumn("sd", F.stddev_samp("metric").over(w))
         .withColumn("k", F.count("metric").over(w)))
    zs = (F.col("metric") - F.col("mu")) / F.col("sd")
    return (s.where((F.col("k") >= 2) & (F.col("sd") > 0) & (F.abs(zs) > z))
            .select("day", "metric", F.round(zs.cast("decimal(18,6)"), 3).alias("z_score")))


def dq_schema_column(df: DataFrame, expected: list[dict]) -> DataFrame:
    """Declared column contracts checked in one report.

    ``expected`` items: ``{"name", "type", "nullable", "primary_key", "unique"}``.
    Type checks come from the schema (no scan); null and duplicate counts for
    all declared columns are one aggregate pass plus one group per unique key.
    """
    spark = df.sparkSession
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, rows = [], []
    for spec in expected:
        name = spec["name"]
        present = name in fields
        rows.append((name, spec.get("type"), fields.get(name), present))
        if present and (not spec.get("nullable", True) or spec.get("primary_key")):
            aggs.append(F.count_if(F.col(name).isNull()).alias(f"nulls__{name}"))
    meta = spark.createDataFrame(rows, "column_name string, expected_type string, actual_type string, present boolean")
    null_counts = df.agg(*aggs) if aggs else None
    out = meta.withColumn("type_ok", F.coalesce(F.col("expected_type").isNull()
                                                | (F.col("expected_type") == F.col("actual_type")), F.lit(False)))
    parts = []
    for spec in expected:
        name = spec["name"]
        if name not in fields:
            continue
        if null_counts is not None and (not spec.get("nullable", True) or spec.get("primary_key")):
            parts.append(null_counts.select(F.lit(name).alias("column_name"), F.lit("not_null").alias("rule"),
                                            F.col(f"nulls__{name}").cast("bigint").alias("violations")))
        if spec.get("unique") or spec.get("primary_key"):
            dup = dq_unique(df.where(F.col(name).isNotNull()), name).agg(F.count(F.lit(1)).alias("v"))
            parts.append(dup.select(F.lit(name).alias("column_name"), F.lit("unique").alias("rule"),
                                    F.col("v").cast("bigint").alias("violations")))
    typed = out.select("column_name", F.lit("type").alias("rule"),
                       F.when(F.col("present") & F.col("type_ok"), 0).otherwise(1).cast("bigint").alias("violations"))
    result = typed
    for p in parts:
        result = result.unionByName(p)
    return result
