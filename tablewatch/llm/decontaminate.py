"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Words are ASCII letters and digits and everything beyond ASCII, with A-Z lower-cased. A window is
``n`` neighbouring words of a benchmark item; an item of fewer words is one window. Documents are
scanned once: rolling hashes of their words are looked up in the broadcast set, and every hit is
verified against the window's words. No shuffle takes place.

The broadcast holds the windows of at most about ``BLOCK_WORDS`` benchmark words. A larger benchmark
is dealt into blocks by item, and the scan carries each document through all of them in one stage.

Defined results: a null or empty text has no words and is clean; items without words have no
window; rows that share an item_id are one item with the windows of all of them; a window of an
item with a null id counts as a hit but names no item; an empty benchmark leaves everything clean.
Documents are treated row by row, so repeated rows each get their row; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import prepare

BLOCK_WORDS = 2_000_000
FILTER_BITS = 20


class _Windows:
    """The windows of one block of items, by number of words and hash."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int):
        found: dict[int, dict[int, dict[bytes, set]]] = {}  # words -> hash -> window -> items
        for item, text in items:
            raw = (text or "").encode()
            data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
            starts, ends, _ = bt.words(data, offsets, bt.ALNUM)
            if not len(starts):
                continue
            size = min(n, len(starts))
            hashes = bt.rolling(bt.word_hashes(data, starts, ends, bt.FOLDED), size)
            parts = [raw[s:e].lower() for s, e in zip(starts.tolist(), ends.tolist())]
            for i, h in enumerate(hashes.tolist()):
                named = found.setdefault(size, {}).setdefault(h, {}).setdefault(b" ".join(parts[i:i + size]), set())
                if item is not None:
                    named.add(str(item))
        self.found = found
        self.masks = {}
        for size, by_hash in found.items():
            mask = np.zeros(1 << FILTER_BITS, bool)
            mask[(np.fromiter(by_hash, U, len(by_hash)) >> U(64 - FILTER_BITS)).astype(np.int64)] = True
            self.masks[size] = mask

    def hits(self, data, starts, ends, row, hashes):
        """(first word, number of words, item names) of every verified hit."""
        for size, mask in self.masks.items():
            key = bt.rolling(hashes, size)
            if not len(key):
                continue
            by_hash = self.found[size]
            maybe = np.flatnonzero(mask[(key >> U(64 - FILTER_BITS)).astype(np.int64)] & (row[:len(key)] == row[size - 1:]))
            for at, h in zip(maybe.tolist(), key[maybe].tolist()):
                windows = by_hash.get(h)
                if windows:
                    words = b" ".join(data[s:e].tobytes().lower() for s, e in zip(starts[at:at + size], ends[at:at + size]))
                    if words in windows:
                        yield at, size, windows[words]


def _scan(block):
    def work(batches):
        windows = block.value
        for batch in batches:
            data, offsets = bt.utf8(batch.column("text"))
            starts, ends, row = bt.words(data, offsets, bt.ALNUM)
            hashes = bt.word_hashes(data, starts, ends, bt.FOLDED)
            first = bt.first_of(row, batch.num_rows)
            spans = [list(x or ()) for x in batch.column("spans").to_pylist()]
            items = [set(x or ()) for x in batch.column("items").to_pylist()]
            for at, size, names in windows.hits(data, starts, ends, row, hashes):
                r = int(row[at])
                place = int(at - first[r])
                spans[r] += (place, place + size)
                items[r] |= names
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(spans, pa.list_(pa.int32())),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=["doc_id", "text", "spans", "items"])
    return work


def _report(batches):
    for batch in batches:
        data, offsets = bt.utf8(batch.column("text"))
        starts, ends, row = bt.words(data, offsets, bt.ALNUM)
        first = bt.first_of(row, batch.num_rows)
        n_hit, clean = [], []
        for i, (text, spans) in enumerate(zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())):
            count = int(first[i + 1] - first[i])
            if not spans:
                n_hit.append(0)
                clean.append(text)
                continue
            at = np.array(spans).reshape(-1, 2)
            hit = bt.covered(count, at[:, 0], at[:, 1])
            n_hit.append(int(hit.sum()))
            raw, parts, place = text.encode(), [], 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
            for a, b in zip(edges[0::2], edges[1::2]):  # bytes from the first hit word to the last of each run
                s, e = int(starts[first[i] + a] - offsets[i]), int(ends[first[i] + b - 1] - offsets[i])
                parts.append(raw[place:s])
                place = e
            clean.append(b"".join([*parts, raw[place:]]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(clean, pa.string()), pa.array(np.diff(first), pa.int64()),
             pa.array(n_hit, pa.int64()), batch.column("items")], names=["doc_id", "clean_text", "n_words", "n_hit", "items"])


def find_benchmark(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", n: int = 10) -> DataFrame:
    """``(doc_id, clean_text, n_words, n_hit, items)``, a row for each document: the text without the
    spans of words inside any benchmark window, words, hit words, and the items that occur (sorted)."""
    spark = df.sparkSession
    prepare(spark)
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // (2 * BLOCK_WORDS)))  # a word and its separator have two bytes at least
    out = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                    F.lit(None).cast("array<int>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        block = spark.sparkContext.broadcast(_Windows([(r["item"], r["text"]) for r in part], n))
        out = out.mapInArrow(_scan(block), "doc_id long, text string, spans array<int>, items array<string>")
    return out.mapInArrow(_report, "doc_id long, clean_text string, n_words long, n_hit long, items array<string>")
