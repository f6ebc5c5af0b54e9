"""Query registry used by ``__spark_entry__`` and ``bench.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewatch.sources.fixtures import table, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# as_of literals per source family (never the clock).
AS_OF_ORDERS = "2002-01-01 00:00:00"
AS_OF_LINEITEM = "2001-12-01 00:00:00"
AS_OF_EVENTS = "2024-01-31 00:00:00"


def bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` returns a 128-bit integer; wrap each call as bigint so the
    oracle's types equal Spark's ``count_if`` (bigint)."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = bigint_counts(sql[j + len(token):k - 1])
        out.append(sql[i:j] + f"cast(count_if({inner}) as bigint)")
        i = k


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle SQL (optional)."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = bigint_counts(with_fixtures(sql.strip()))
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver or fixture table. Also makes sure the session is in UTC (epoch
    conversions of timestamp_ntz depend on it) and has a checkpoint folder
    (iterative operators cut lineage there); an existing folder is kept."""
    from tablewatch.session import checkpoint_dir
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return table(spark, sf_dir, name)


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so results compare across engines without date-type drift."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    cols = [F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)
