"""Skew-safe "previous row" helpers.

A window partitioned only by a business key puts every row of a hot key into
one task. These helpers split each key's rows into ordered buckets (for
example one day of event time), run the window inside (key, bucket), and
carry values across bucket borders through a small per-(key, bucket) summary
that is joined back. The result is exact, and no task holds more than one
bucket of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.session import written

RANGE = "__range"


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``RANGE``, the number of a range in the order of the columns. Ranges hold about as many
    rows each, whatever the keys: a key with a third of all rows is in a third of the ranges."""
    return written(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def with_prev_value(df: DataFrame, keys: list[str], order_col: str, value_col: str, bucket: Column,
                    out: str = "prev_value") -> DataFrame:
    """Adds ``out`` = ``value_col`` of the previous row by ``order_col`` within ``keys``."""
    x = df.withColumn("__b", bucket)
    w = Window.partitionBy(*keys, "__b").orderBy(order_col)
    x = x.withColumn("__lag", F.lag(value_col).over(w)).withColumn("__rn", F.row_number().over(w))
    last = x.groupBy(*keys, "__b").agg(F.max_by(value_col, order_col).alias("__last"))
    wl = Window.partitionBy(*keys).orderBy("__b")
    carry = last.withColumn("__carry", F.lag("__last").over(wl)).drop("__last")
    x = x.join(carry, [*keys, "__b"], "left")
    return (x.withColumn(out, F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.col("__lag")))
            .drop("__b", "__lag", "__rn", "__carry"))


def with_prev_running_max(df: DataFrame, keys: list[str], order_col: str, value_col: str, bucket: Column,
                          out: str = "prev_max") -> DataFrame:
    """Adds ``out`` = max of ``value_col`` over all earlier rows within ``keys``."""
    x = df.withColumn("__b", bucket)
    w = Window.partitionBy(*keys, "__b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("__pm", F.max(value_col).over(w))
    bmax = x.groupBy(*keys, "__b").agg(F.max(value_col).alias("__bm"))
    wl = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = bmax.withColumn("__prior", F.max("__bm").over(wl)).drop("__bm")
    x = x.join(carry, [*keys, "__b"], "left")
    return x.withColumn(out, F.greatest("__pm", "__prior")).drop("__b", "__pm", "__prior")
