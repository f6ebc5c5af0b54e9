"""Session settings shared by the library, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tablewatch job relies on. UTC makes timestamp_ntz <-> epoch
# conversions agree with other engines; AQE coalesces small shuffles and splits
# skewed join partitions at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tablewatch") -> SparkSession:
    """Build (or reuse) a session with the tablewatch defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Local mode runs everything in the driver JVM; its 1 GB default is too small for
    # hash joins at test scale. On a cluster the deployment sets executor/driver memory.
    driver_mem = os.environ.get("TABLEWATCH_DRIVER_MEMORY") or ("16g" if (master or "").startswith("local") else None)
    if driver_mem:
        builder = builder.config("spark.driver.memory", driver_mem)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and state tables.

    ``spark.checkpoint.dir`` names it, or a folder already set with ``setCheckpointDir``. Only in
    local mode, as in tests, a fresh scratch folder is made when neither is set; a cluster's
    executors do not share the driver's folders, so there a missing setting is an error.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not current:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tablewatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


CLEANUP = "spark.sql.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, read by column, and any executor can
    read it again. Cheaper than ``checkpoint()``, which serialises rows. Shuffle files of the write are released
    when it is done."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes ``written`` tables that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
