"""Substring dedup with fixed-block anchors.

Every document is cut into non-overlapping reference blocks of ``block`` words; these are the
index. Every rolling window of ``block`` words of every document probes it. A repeat of ``window``
words holds a whole reference block of each of its copies when ``2 * block - 1 <= window``, so
the other copies' probes find it: no repeat is missed. Each hit is then extended by
``window - block`` words to either side, the ``window``-word runs there are confirmed by their
64-bit hashes over the corpus, and neighbouring confirmed runs merge into maximal exact repeats.

Defined results: a null or empty text has no words; rows equal in id and text are one
document, rows that share an id only are several (see ``corpus``); an empty table gives an empty table; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm import exchange as ex
from tablewatch.llm.common import corpus, named, prepare, stored


class _Probe:
    """Hash of every rolling block of words; those at multiples of the block length are the index."""

    def __init__(self, block: int):
        self.block = block

    def __call__(self, batch: pa.RecordBatch):
        ids, b = np.asarray(batch.column("doc_id").fill_null(-1 << 62)), self.block
        data, offsets = bt.utf8(batch.column("text"))
        starts, ends, row = bt.words(data, offsets, bt.SPACED)
        key = bt.rolling(bt.word_hashes(data, starts, ends), b)
        at = np.flatnonzero(row[:len(key)] == row[b - 1:])
        pos = (at - bt.first_of(row, len(ids))[row[at]]).astype(np.int32)
        return ids[row[at]], pos, key[at], (pos % b == 0).astype(np.uint8) * ex.INDEX


class _Extend:
    """Hash of every run of ``window`` words that covers a hit."""

    def __init__(self, window: int, block: int):
        self.window, self.block = window, block

    def __call__(self, batch: pa.RecordBatch):
        ids, w = np.asarray(batch.column("doc_id").fill_null(-1 << 62)), self.window
        data, offsets = bt.utf8(batch.column("text"))
        starts, ends, row = bt.words(data, offsets, bt.SPACED)
        first = bt.first_of(row, len(ids))
        hit, of = ex.positions(batch.column("hits"))
        key = bt.rolling(bt.word_hashes(data, starts, ends), w)
        if not len(key):
            none = np.zeros(0, np.int64)
            return none, none.astype(np.int32), none.astype(np.uint64), none.astype(np.uint8)
        at = first[of] + hit
        near = bt.covered(len(starts), np.maximum(first[of], at - (w - self.block)), at + 1)[:len(key)]
        at = np.flatnonzero(near & (row[:len(key)] == row[w - 1:]))
        return (ids[row[at]], (at - first[row[at]]).astype(np.int32), key[at],
                np.full(len(at), ex.INDEX, np.uint8))


def _removed(window: int):
    def work(batches):
        for batch in batches:
            data, offsets = bt.utf8(batch.column("text"))
            starts, ends, row = bt.words(data, offsets, bt.SPACED)
            n = batch.num_rows
            first = bt.first_of(row, n)
            hit, of = ex.positions(batch.column("hits"))
            gone = bt.covered(len(starts), first[of] + hit, np.minimum(first[of] + hit + window, len(starts)))
            keep = np.flatnonzero(~gone)
            raw = data.tobytes()
            texts = [raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())]
            cut = np.searchsorted(row[keep], np.arange(n + 1)).tolist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "text": pa.array([b" ".join(texts[cut[i]:cut[i + 1]]) for i in range(n)], pa.binary()).cast(pa.string()),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array(np.bincount(row[gone], minlength=n), pa.int64())})
    return work


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   keep_first: bool = False) -> DataFrame:
    """``(doc_id, text, n_words, n_removed)``: each document's words, joined by one space, without
    those covered by a run of ``window`` words that also starts elsewhere in the corpus. With
    ``keep_first`` the first occurrence by (doc_id, position) of each run stays."""
    block = (window + 1) // 2
    prepare(df.sparkSession)
    docs, _, size, names = corpus(df, id_col, text_col)
    hits = stored(ex.per_document(ex.repeated(docs, _Probe(block), size // 6, 5)), "block-hits")
    docs = stored(docs.join(hits, docs.doc_id.eqNullSafe(F.when(hits.doc_id != -1 << 62, hits.doc_id)), "left")
                  .select(docs.doc_id, "text", "hits", "n"), "with-hits")
    touched = docs.filter("hits is not null")
    found = touched.agg(F.sum("n")).first()[0] or 0
    runs = ex.per_document(ex.repeated(touched.select("doc_id", "text", "hits"), _Extend(window, block),
                                       int(found), 8, keep_first))
    runs = runs.select(F.when(F.col("doc_id") != -1 << 62, F.col("doc_id")).alias("of"), F.col("hits").alias("runs"))
    mended = touched.join(runs, touched.doc_id.eqNullSafe(runs.of), "left").select("doc_id", "text", F.col("runs").alias("hits"))
    return named(docs.filter("hits is null").select("doc_id", "text", "hits").union(mended)
                 .mapInArrow(_removed(window), "doc_id long, text string, n_words long, n_removed long"), names)
