"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer digest, content digest, n_tokens). Texts are joined to it by
the digest of their normalised content and of the tokenizer's file; only distinct missing texts are
encoded, and their counts are appended. A new tokenizer version has a digest of its own, so its
counts never mix with older ones. Counts depend on every byte of a text, so normalisation only turns
null into the empty text.

A task drops the repeats within its own rows before the texts are dealt by digest, so a text that a
third of all documents hold reaches its task once per sending task.

Defined results: rows are counted one by one, so repeated rows each get theirs; a null or empty
text has no bytes and the tokens of the empty text; an empty table gives an empty table; other
columns are ignored."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bpe import encoder
from tablewatch.llm.common import checkpoint_dir, prepare

CACHE = "tokenizer string, digest binary, n_tokens long"


def _distinct(batches):
    """Each text once per task, with its digest. Holds 32 bytes per distinct text of the task."""
    seen = set()
    for batch in batches:
        digests = batch.column("digest").to_pylist()
        keep = [i for i, d in enumerate(digests) if not (d in seen or seen.add(d))]
        yield batch.take(pa.array(keep, pa.int64()))


def _encoded(path: str, version: str):
    def work(batches):
        enc, seen = encoder(path), set()
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            keep = [i for i, d in enumerate(digests) if not (d in seen or seen.add(d))]
            batch = batch.take(pa.array(keep, pa.int64()))
            counts = [np.diff(rows) for _, _, rows in enc.encode(*bt.utf8(batch.column("text")))]
            yield pa.RecordBatch.from_pydict({
                "tokenizer": pa.array([version] * batch.num_rows, pa.string()), "digest": batch.column("digest"),
                "n_tokens": pa.array(np.concatenate(counts) if counts else [], pa.int64())})
    return work


def version_of(path: str) -> str:
    """Digest of a tokenizer's file."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def count_tokens(df: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row. ``tokenizer`` is the path of a
    ``tokenizers`` file that every worker can read; ``cache`` the folder of the stored counts, a new
    one in the shared checkpoint folder if not given."""
    spark = df.sparkSession
    prepare(spark)
    version = version_of(tokenizer)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    cache = cache or f"{checkpoint_dir(spark).rstrip('/')}/token-counts-{uuid.uuid4().hex}"
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)

    def stored_counts():
        return (spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
                .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))

    texts = docs.select("digest", "text").mapInArrow(_distinct, "digest binary, text string")
    misses = texts.repartition("digest").join(stored_counts().select("digest"), "digest", "left_anti")
    misses.mapInArrow(_encoded(tokenizer, version), CACHE).write.mode("append").parquet(cache)
    return (docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
            .join(stored_counts(), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
