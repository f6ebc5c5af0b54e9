"""Shared pieces of the corpus operators: row identity, written tables, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.session import checkpoint_dir

CLEANUP = "spark.sql.shuffleDependency.fileCleanup.enabled"
FOREST = 1 << 20         # links that a task joins by itself


def prepare(spark: SparkSession) -> None:
    """Arrow batches of at most 2 MB, so that a Python worker's memory does not follow the
    length of the texts; a single longer text is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")
    checkpoint_dir(spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage with a table
    every executor can read again. Shuffle files of the write are released when it is done."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int, DataFrame | None]:
    """``(doc_id, text)`` with a doc_id of its own for each document, the number of documents, their
    bytes, and ``(row, id)`` to turn those numbers back into ids (None: they are the ids).

    A document is a distinct pair of id and text; a null text is the empty text. Where all ids are
    there and differ, they number the documents. Where an id is null or repeated, its texts all stay
    documents of their own, numbered in the order of ids, null last. Only the id column and the
    lengths are read to find that out."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    per_id = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    most, ids, size, known = per_id.agg(F.max("n"), F.count(F.lit(1)), F.sum("b"), F.count("doc_id")).first()
    if ids == known and (most or 0) <= 1:
        return docs, ids, int(size or 0), None
    rows = numbered(docs)
    return (rows.select(F.col("row").alias("doc_id"), "text"), rows.count(), int(size or 0),
            rows.select("row", F.col("doc_id").alias("id")))


def numbered(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, text)`` of the distinct rows of ``docs (doc_id, text)``; ``row`` ascends with doc_id, null last."""
    return stored(docs.distinct().orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"))
                  .withColumn("row", F.monotonically_increasing_id()), "rows").select("row", "doc_id", "text")


def named(out: DataFrame, names: DataFrame | None, *columns: str) -> DataFrame:
    """``out`` with the document numbers of ``columns`` turned back into ids."""
    if names is None:
        return out
    order = out.columns
    for c in columns or ("doc_id",):
        out = out.join(names.select(F.col("row").alias(c), F.col("id").alias("__id")), c).drop(c).withColumnRenamed("__id", c)
    return out.select(*order)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, component_id)``: the smallest id reachable over undirected ``links (a, b)``.

    Each task first turns up to ``FOREST`` of its links at a time into stars, without a shuffle; fewer links in all
    are settled by that. For more it alternates large-star and small-star steps, each a hash join on node ids with ``min`` taken
    map-side first, until the edge set is a set of stars; ids without links are their own
    component. The edges are written to the shared folder after each step, so that a hub's
    edges are spread over the join's tasks and a lost executor repeats one step only."""
    star = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"), "star")
    n = star.count()
    star = stored(star.coalesce(max(1, -(-n // FOREST))).mapInArrow(_forests(FOREST), "a long, b long"), "star")
    signature = None
    while n > FOREST:
        star = stored(_small_star(_large_star(star)), "star")
        now = tuple(star.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")),
                             F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == signature:
            break
        signature = now
    roots = star.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return (nodes.select("id").join(roots, "id", "left")
            .select("id", F.coalesce("root", "id").alias("component_id")))


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links ``(a, b)``, each with the smallest that it reaches, without those that are it."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y, low = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while len(x):
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))  # a root goes below the smallest beside it
        while (low[low] != low).any():
            low = low[low]
        x, y = low[x], low[y]
        x, y = x[x != y], y[x != y]
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[moved], nodes[low[moved]]


def _forests(most: int):
    def work(batches):
        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                if size + part.num_rows > most:
                    yield rows(held)
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if held:
            yield rows(held)

    def rows(held):
        a, b = _stars(*(np.concatenate([np.asarray(h.column(c)) for h in held]) for c in ("a", "b")))
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return work


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Node u with its larger neighbours are the edges stored as (larger=a, smaller=b=u).
    return (e.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    joined = e.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .union(low.select("a", F.col("m").alias("b"))).distinct())
