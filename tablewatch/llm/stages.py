"""The filtering stages of the corpus pipeline: an operator's decisions put into effect on whole rows.

Each takes a table with ``doc_id``, ``text`` and any other columns and returns the same columns. Every
row is a document of its own: where ids are null or repeated, the operator works on row numbers in the
order of ids (null last), so no row loses its text to another. An empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import stored
from tablewatch.llm.decontaminate import find_benchmark
from tablewatch.llm.line_dedup import remove_repeated_lines
from tablewatch.llm.minhash_dedup import near_duplicates


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name: ``doc_id`` if it does."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    most, nulls = ids.agg(F.max("n"), F.count_if(F.col("doc_id").isNull())).first()
    if (most or 0) <= 1 and not nulls:
        return docs, "doc_id"
    name = "row"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    ordered = docs.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"))
    return stored(ordered.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Texts without the lines that an earlier line matches; ``n_chars``, if there is one, follows.
    A text of which only white space is left goes: all its lines are in earlier documents."""
    rows, key = with_row(docs)
    given = {c: f"given{i}" for i, c in enumerate(docs.columns) if c != "text"}  # the operator's own names stay free
    named = rows.select(F.col(f"`{key}`").alias("key"), "text", F.col("text").isNull().alias("none"), *(F.col(f"`{c}`").alias(g) for c, g in given.items()))
    mended = remove_repeated_lines(named, "key", others=["none", *given.values()]).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    new = {c: F.col(g) for c, g in given.items()} | {"text": F.when(~F.col("none"), F.col("text"))}
    if "n_chars" in given:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return mended.select(*(new[c].alias(c) for c in docs.columns))


def drop_near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest doc_id."""
    rows, key = with_row(docs)
    gone = near_duplicates(rows, key, words=words, percent=percent).filter("not kept").select(F.col("doc_id").alias("of"))
    return rows.join(gone, rows[f"`{key}`"] == gone["of"], "left_anti").select(*(f"`{c}`" for c in docs.columns))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """Rows without a window of a benchmark item."""
    rows, key = with_row(docs)
    hit = find_benchmark(rows, benchmark, key, n=n).filter("n_hit > 0").select(F.col("doc_id").alias("of"))
    return rows.join(hit, rows[f"`{key}`"] == hit["of"], "left_anti").select(*(f"`{c}`" for c in docs.columns))
