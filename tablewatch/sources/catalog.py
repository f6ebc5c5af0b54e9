"""Schema catalogue: one row per column of a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("is_nullable", T.BooleanType()),
    T.StructField("ordinal_position", T.LongType()),
])


def schema_catalog(df: DataFrame, table_name: str = "t", spark: SparkSession | None = None) -> DataFrame:
    """``information_schema.columns`` for one frame. Built from the schema, no scan."""
    spark = spark or df.sparkSession
    rows = [(table_name, f.name, f.dataType.simpleString(), bool(f.nullable), i + 1)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def schema_catalog_many(frames: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    rows = []
    for name, df in frames.items():
        rows += [(name, f.name, f.dataType.simpleString(), bool(f.nullable), i + 1)
                 for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)
