"""Streaming operators on a file source.

Each stream reads new files with ``Trigger.AvailableNow`` (the checkpoint is
the load cursor), and writes per-batch results with ``foreachBatch`` into a
parquet table keyed by batch id. A batch that is re-run after a failure
overwrites its own rows (idempotent by batch id), so results survive restarts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewatch.functions.thresholds import verdict
from tablewatch.functions.timeutil import epoch_seconds, ts_lit

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def split_to_files(df: DataFrame, out_dir: str, key: Column, parts: int) -> None:
    """Land a table as ``parts`` file groups (one folder per key value)."""
    df.withColumn("part", key).repartition(parts, "part").write.partitionBy("part").parquet(out_dir)


def land(df: DataFrame, out_dir: str, name: str) -> None:
    """One more arrival in a stream's folder, written by as many tasks as the table has."""
    df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = 1) -> DataFrame:
    """New files under ``path``; without ``files_per_batch`` all that have arrived are one batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(path)


def _append_batch(sink: str):
    """foreachBatch writer: replace this batch id's partition (idempotent on retry)."""
    def write(batch: DataFrame, batch_id: int):
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))
    return write


def run_available_now(stream: DataFrame, fn, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_incremental_count(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str) -> DataFrame:
    """New rows per micro-batch; returns the per-batch table."""
    def per_batch(batch: DataFrame, batch_id: int):
        _append_batch(sink)(batch.agg(F.count(F.lit(1)).alias("new_rows")), batch_id)
    run_available_now(file_stream(spark, source, schema), per_batch, checkpoint)
    return spark.read.parquet(sink)


def stream_dq(spark: SparkSession, source: str, schema: str, tests: dict[str, Column], sink: str,
              checkpoint: str, error: str = "> 0", warn: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Row-level tests on every micro-batch (one fused aggregate per batch): (test_name, violations, verdict,
    batch_id) of all batches so far. A run takes what has arrived since the one before."""
    names = list(tests)

    def per_batch(batch: DataFrame, batch_id: int):
        agg = batch.agg(*[F.count_if(tests[n]).alias(f"c{i}") for i, n in enumerate(names)])
        stack = ", ".join(f"'{n}', c{i}" for i, n in enumerate(names))
        counts = agg.selectExpr(f"stack({len(names)}, {stack}) as (test_name, violations)")
        _append_batch(sink)(counts.withColumn("verdict", verdict(F.col("violations"), warn, error)), batch_id)
    run_available_now(file_stream(spark, source, schema, files_per_batch), per_batch, checkpoint)
    return spark.read.parquet(sink)


def stream_freshness(spark: SparkSession, source: str, schema: str, ts_col: str, sink: str,
                     checkpoint: str) -> DataFrame:
    """Global running max of the event time (stateful aggregate, complete mode); each
    batch overwrites the one-row state table."""
    agg = file_stream(spark, source, schema).agg(F.max(ts_col).alias("max_ts"), F.count(F.lit(1)).alias("rows"))

    def per_batch(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(sink)
    q = (agg.writeStream.outputMode("complete").foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def freshness_of(state: DataFrame, as_of, warn_s: int = 86400, error_s: int = 259200) -> DataFrame:
    age = epoch_seconds(ts_lit(as_of)) - epoch_seconds("max_ts")
    st = F.when(age > error_s, "error").when(age > warn_s, "warn").otherwise("pass")
    return state.select("max_ts", "rows", age.alias("age_s"), st.alias("state"))


def stream_side_totals(spark: SparkSession, source: str, schema: str, cursor: str, sink: str,
                       checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Per batch: rows and max cursor of one side (for cursor drift across two streams)."""
    def per_batch(batch: DataFrame, batch_id: int):
        _append_batch(sink)(batch.agg(F.count(F.lit(1)).alias("rows"), F.max(cursor).alias("max_cursor")), batch_id)
    run_available_now(file_stream(spark, source, schema, files_per_batch), per_batch, checkpoint)
    return spark.read.parquet(sink)


def cursor_drift(src_batches: DataFrame, dst_batches: DataFrame, count_error: str = "!= 0", max_error: str = "> 60") -> DataFrame:
    """Drift of every batch, with the cursor cached before it and the one after it: the smaller of what the two
    sides have reached, so it never passes rows that one of them still owes. One row a batch: the running
    maxima are over batches, not rows."""
    s = src_batches.select("batch_id", F.col("rows").alias("src_rows"), F.col("max_cursor").alias("src_max"))
    d = dst_batches.select("batch_id", F.col("rows").alias("dst_rows"), F.col("max_cursor").alias("dst_max"))
    j = s.join(d, "batch_id", "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("src_rows", "dst_rows")})
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.when(F.max("src_max").over(upto).isNotNull() & F.max("dst_max").over(upto).isNotNull(),
                     F.least(F.max("src_max").over(upto), F.max("dst_max").over(upto)))
    j = j.withColumn("new_cursor", reached)
    j = j.withColumn("cached_cursor", F.lag("new_cursor").over(Window.orderBy("batch_id")))
    drift, lag = F.col("dst_rows") - F.col("src_rows"), epoch_seconds("dst_max") - epoch_seconds("src_max")
    return j.select(F.col("batch_id").cast("int").alias("batch_id"), "cached_cursor", "src_rows", "dst_rows", drift.alias("count_drift"), "src_max", "dst_max",
                    lag.alias("max_drift_s"), verdict(F.abs(drift), None, count_error).alias("count_verdict"),
                    F.when(F.col("src_max").isNull() != F.col("dst_max").isNull(), "FAILED")
                    .otherwise(verdict(F.coalesce(F.abs(lag), F.lit(0)), None, max_error)).alias("max_verdict"), "new_cursor")


def ready_check(checks: dict[str, DataFrame]) -> DataFrame:
    """Each check passes when its query returns at least one row (``limit(1)``, so the
    scan stops early); the overall verdict ANDs all checks."""
    parts = None
    for name, df in checks.items():
        one = df.limit(1).agg((F.count(F.lit(1)) > 0).alias("passed")).select(F.lit(name).alias("check_name"), "passed")
        parts = one if parts is None else parts.unionByName(one)
    overall = parts.agg(F.bool_and("passed").alias("passed")).select(F.lit("ALL").alias("check_name"), "passed")
    return parts.unionByName(overall)


def ready_timeout(arrivals: DataFrame, ts_col: str, open_hour: int, timeout_minutes: int) -> DataFrame:
    """Per day: the first arrival inside [open, open + timeout]; no arrival means timed out."""
    day = F.to_date(ts_col)
    opens = F.to_timestamp_ntz(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {open_hour:02d}:00:00")))
    x = arrivals.select(day.alias("day"), F.col(ts_col).alias("ts"), opens.alias("opens"))
    inside = (F.col("ts") >= F.col("opens")) & (F.col("ts") <= F.col("opens") + F.expr(f"INTERVAL {timeout_minutes} MINUTES"))
    g = x.groupBy("day").agg(F.min(F.when(inside, F.col("ts"))).alias("first_arrival"))
    return g.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "first_arrival",
                    F.col("first_arrival").isNotNull().alias("ready"))
