"""Corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept, whatever
further columns they have. The first four return the columns of ``docs``; ``n_chars``, if there is
one, follows a changed text. Rows that share a doc_id are documents of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewatch.llm import quality
from tablewatch.llm.common import prepare, stored
from tablewatch.llm.packing import pack_documents
from tablewatch.llm.queries import vocabulary
from tablewatch.llm.stages import drop_contaminated, drop_near_duplicates, drop_repeated_lines

WORDS, PERCENT, GRAMS, CAPACITY = 5, 80, 10, 1024


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject."""
    return quality.keep_good(docs, quality.learn(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line matches; texts of which nothing is left go."""
    return drop_repeated_lines(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return drop_near_duplicates(docs, WORDS, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), GRAMS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place."""
    return pack_documents(docs, vocabulary(), capacity=CAPACITY, end_id=2)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The stages train a classifier, tokenise and search for a packing, which SQL cannot express; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
