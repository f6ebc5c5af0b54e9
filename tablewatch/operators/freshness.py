"""Source freshness and state-aware rebuild gating.

Freshness is a grouped ``max`` with the predicate applied *before* the
aggregate, so partition and row-group pruning apply. Propagation over the
model graph is an iterative frontier join: each round joins only the newly
reached models with the edge list, stops at a fixed point, and checkpoints each
round, so lineage stays short and graphs may be of any depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.graph import least_below, reach
from tablewatch.functions.timeutil import epoch_seconds, period_seconds, ts_lit
from tablewatch.sources.files import listed_files

# Load-time column names, strongest first; the last two are weak signals.
LOADED_AT_NAMES = ["loaded_at", "_loaded_at", "_synced_at", "_fivetran_synced", "_airbyte_emitted_at",
                   "ingested_at", "etl_loaded_at", "updated_at", "created_at"]


def freshness_state(max_col: Column, as_of, warn_after: tuple[int, str] | None,
                    error_after: tuple[int, str] | None) -> tuple[Column, Column]:
    age = epoch_seconds(ts_lit(as_of)) - epoch_seconds(max_col)
    state = F.lit("pass")
    if warn_after is not None:
        state = F.when(age > period_seconds(*warn_after), F.lit("warn")).otherwise(state)
    if error_after is not None:
        state = F.when(age > period_seconds(*error_after), F.lit("error")).otherwise(state)
    # An empty source has no max: report it as an error with its own reason.
    state = F.when(max_col.isNull(), F.lit("error")).otherwise(state)
    return age, state


def source_freshness(df: DataFrame, source_cols: list[str], loaded_at: str, as_of,
                     warn_after=(24, "hour"), error_after=(72, "hour"), where: Column | None = None) -> DataFrame:
    """Per source: max_loaded_at, snapshotted_at, age_s, state (pass / warn / error)."""
    x = df.where(where) if where is not None else df
    g = x.groupBy(*source_cols).agg(F.max(loaded_at).alias("max_loaded_at"))
    age, state = freshness_state(F.col("max_loaded_at"), as_of, warn_after, error_after)
    return g.select(*source_cols, "max_loaded_at", ts_lit(as_of).alias("snapshotted_at"),
                    age.alias("age_s"), state.alias("state"))


def freshness_filter(df, source_cols, loaded_at, as_of, predicate: Column, **kw) -> DataFrame:
    return source_freshness(df, source_cols, loaded_at, as_of, where=predicate, **kw)


def freshness_bounded(df: DataFrame, loaded_at: str, as_of, bound_days: int,
                      warn_after=(24, "hour"), error_after=(72, "hour")) -> DataFrame:
    """``max`` over a bounded recent window only (a pushed range filter); no row in
    the window reads as an error with reason ``no_rows``."""
    lo = ts_lit(as_of) - F.expr(f"INTERVAL {int(bound_days)} DAYS")
    m = df.where((F.col(loaded_at) >= lo) & (F.col(loaded_at) <= ts_lit(as_of))).agg(
        F.max(loaded_at).alias("max_loaded_at"))
    age, state = freshness_state(F.col("max_loaded_at"), as_of, warn_after, error_after)
    return m.select("max_loaded_at", age.alias("age_s"), state.alias("state"),
                    F.when(F.col("max_loaded_at").isNull(), F.lit("no_rows")).alias("reason"))


def freshness_metadata(spark, paths: dict[str, str]) -> DataFrame:
    """Last modification time of each table's files when no load column exists (over-reports: any rewrite
    counts as a load). From the listing of the files: a row a file, no file is opened."""
    parts = []
    for name, path in paths.items():
        parts.append(listed_files(spark, path).agg(F.max("modificationTime").alias("last_modified"),
                                                   F.count(F.lit(1)).alias("files")).withColumn("table_name", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "last_modified", "files")


def freshness_inherit(sources: DataFrame, tables: DataFrame, key: str) -> DataFrame:
    """Table-level settings override source-level ones; an explicit ``disabled`` flag turns
    freshness off for a table (a plain null means "inherit")."""
    j = sources.join(tables, key, "left")
    enabled = ~F.coalesce(F.col("t_disabled"), F.lit(False))
    return j.select(key,
                    F.when(enabled, F.coalesce(F.col("t_warn_hours"), F.col("s_warn_hours"))).alias("warn_hours"),
                    F.when(enabled, F.coalesce(F.col("t_error_hours"), F.col("s_error_hours"))).alias("error_hours"),
                    enabled.alias("enabled"))


def pick_loaded_at(catalog: DataFrame) -> DataFrame:
    """Per table, the best load-time column by the ranked name list (null when none)."""
    from pyspark.sql import Window
    spark = catalog.sparkSession
    ranks = spark.createDataFrame([(n, i + 1, i >= 7) for i, n in enumerate(LOADED_AT_NAMES)],
                                  "column_name string, name_rank int, weak boolean")
    tables = catalog.select("table_name").distinct()
    hits = catalog.join(F.broadcast(ranks), F.lower(catalog["column_name"]) == ranks["column_name"], "inner").select(
        "table_name", catalog["column_name"].alias("loaded_at_column"), "name_rank", "weak")
    w = Window.partitionBy("table_name").orderBy("name_rank")
    best = hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn", "name_rank")
    return tables.join(best, "table_name", "left")


def tz_to_utc(df: DataFrame, ts_col: str, tz_col: str, out: str = "ts_utc") -> DataFrame:
    """Local wall-clock timestamps (zone per row) converted to UTC before comparing."""
    return df.withColumn(out, F.to_utc_timestamp(F.col(ts_col).cast("timestamp"), F.col(tz_col))
                         .cast("timestamp_ntz"))


def build_gate(models: DataFrame, upstream: DataFrame, as_of, count: int, period: str, mode: str = "any") -> DataFrame:
    """Rebuild a model when its build period has elapsed **and** its upstream is fresh.

    ``models``: (model_id, last_built_at). ``upstream``: (model_id, upstream_at) with one row
    per upstream node (parent model's build time or source load time). Fresh means the
    upstream changed after the model's last build; ``mode`` is ``any`` (default) or ``all``.
    """
    if mode not in ("any", "all"):
        raise ValueError("mode must be 'any' or 'all'")
    elapsed = (epoch_seconds(ts_lit(as_of)) - epoch_seconds("last_built_at")) >= period_seconds(count, period)
    j = upstream.join(models, "model_id", "inner")
    fresh = F.col("upstream_at") > F.col("last_built_at")
    g = j.groupBy("model_id", "last_built_at").agg(F.bool_or(fresh).alias("any_fresh"),
                                                   F.bool_and(fresh).alias("all_fresh"))
    gate = F.col("any_fresh") if mode == "any" else F.col("all_fresh")
    return g.select("model_id", elapsed.alias("elapsed"), "any_fresh", "all_fresh", (elapsed & gate).alias("rebuild"))


def build_propagate(edges: DataFrame, sources: DataFrame, as_of, stale_hours: int = 24,
                    expectations: DataFrame | None = None) -> DataFrame:
    """What flows along the model graph, both ways: (model_id, depth, expected_s), a row for each model that
    either reaches.

    Down: models below a stale source are skipped; ``depth`` is the distance from the nearest one (0 = fed
    directly, null = not skipped). ``sources``: (source_id, model_id, loaded_at), the model fed by each source.
    Up: a model must be as fresh as the strictest model built from it expects; ``expected_s`` is the
    smallest expectation at or below it. ``expectations``: (model_id, expected_s)."""
    down = stale_below(edges, sources, as_of, stale_hours)
    if expectations is None:
        return down.withColumn("expected_s", F.lit(None).cast("bigint"))
    up = least_below(edges, expectations.select(F.col("model_id").alias("node"), F.col("expected_s").cast("bigint").alias("value")))
    return (down.join(up.select(F.col("node").alias("model_id"), F.col("value").alias("expected_s")), "model_id", "full_outer")
            .select("model_id", "depth", "expected_s"))


def stale_below(edges: DataFrame, sources: DataFrame, as_of, stale_hours: int = 24) -> DataFrame:
    """(model_id, depth) of every model at or below a source that was not loaded in the last ``stale_hours``."""
    stale = sources.where(F.col("loaded_at") < ts_lit(as_of) - F.expr(f"INTERVAL {int(stale_hours)} HOURS"))
    seeds = stale.select(F.col("model_id").alias("node"))
    return reach(edges, seeds).select(F.col("node").alias("model_id"), "depth")


def usage_reads(access_log: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Reads per table in the last ``days`` from an access log whose rows hold an array
    of accessed objects (filter first, then explode, then count)."""
    recent = access_log.where((F.col("event_time") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
                              & (F.col("event_time") < ts_lit(as_of)))
    return (recent.select(F.explode("objects_accessed.name").alias("table_name"))
            .groupBy("table_name").agg(F.count(F.lit(1)).alias("reads")))


def usage_sla(access_log: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Read cadence per table -> proposed SLA, with the evidence.

    Cadence is the mean gap between consecutive reads, ``(last - first) / (n - 1)``:
    exact, and a plain mergeable aggregate, so a table read by a third of all
    queries costs the same as any other.
    """
    recent = access_log.where((F.col("event_time") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
                              & (F.col("event_time") < ts_lit(as_of)))
    x = recent.select(F.explode("objects_accessed.name").alias("table_name"), "event_time")
    g = x.groupBy("table_name").agg(F.count(F.lit(1)).alias("reads"), F.min("event_time").alias("first_read"),
                                    F.max("event_time").alias("last_read"))
    gap = F.when(F.col("reads") > 1, F.floor((epoch_seconds("last_read") - epoch_seconds("first_read"))
                                             / (F.col("reads") - 1)).cast("bigint"))
    sla = (F.when(gap.isNull(), "none").when(gap <= 3600, "hourly").when(gap <= 86400, "daily").otherwise("weekly"))
    return g.select("table_name", "reads", "first_read", "last_read", gap.alias("mean_gap_s"), sla.alias("proposed_sla"))
