"""File sources and sinks.

Writes go to a caller-given path (on a cluster: a shared folder, for example
under ``spark.checkpoint.dir``). Per-day replacement uses dynamic partition
overwrite, so re-running a day replaces exactly that day's partition and is
idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Landed CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def write_curated(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite ``path`` with ``df``; the row count comes from an observation on the
    same write (no second pass over the data)."""
    obs = Observation("curated")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def table_replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def insert_select(df: DataFrame, path: str, where=None) -> None:
    """``INSERT INTO t SELECT ... [WHERE ...]``: filtered append."""
    (df.where(where) if where is not None else df).write.mode("append").parquet(path)


def replace_day(df: DataFrame, path: str, day_col: str = "run_date") -> None:
    """Idempotent per-day write: only the partitions present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


def rebuild_partition(source: DataFrame, path: str, day_col: str, day) -> None:
    """Backfill one partition: recompute it from the source filtered to the key."""
    replace_day(source.where(F.col(day_col) == F.lit(day)), path, day_col)


def listed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of the files under a path, a row a file. The content column is
    pruned, so nothing is read but the listing; files that writers keep for themselves are not listed."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .load(path).select("path", "modificationTime", "length").where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")))


def day_arrivals(spark: SparkSession, base: str, day_col: str, days: DataFrame) -> DataFrame:
    """``(day, files, bytes, arrived)`` of every expected day (column ``day``, text) under day folders."""
    day = F.regexp_extract("path", rf"/{day_col}=([^/]+)/", 1)
    found = listed_files(spark, base).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return (days.select("day").join(found, "day", "left")
            .select("day", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), F.col("files").isNotNull().alias("arrived")))


def file_arrival(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """Files under a prefix (listing only: the content column is never read)."""
    files = listed_files(spark, prefix, glob)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")) \
        .select(F.lit(prefix).alias("prefix"), "files", "bytes", (F.col("files") > 0).alias("arrived"))


def fan_in_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read many extracts in one scan and keep the file each row came from."""
    return spark.read.parquet(*paths).withColumn("source_file", F.col("_metadata.file_path"))
