"""Ranked lexical search: every document against every item, by NRA over impact-sorted lists.

*Index.* One pass over the texts writes shards of up to ``SHARD`` documents: their lengths and the
postings (term, document, occurrences) of the items' terms. Document frequencies and lengths are summed
over all shards, first within tasks.

*Search.* A task reads its shards one after the other. In each, an item's lists are sorted by impact
and read from the top, a block of each at a time, without looking anything up (no random access). A
document's lower bound is the sum of the impacts read; its upper bound adds, for each list in which it
was not met yet, that list's next impact. An unseen document's upper bound is the sum of all next impacts.
Documents whose upper bound falls below the tenth best lower bound leave; reading goes on until no unseen
document can enter and the bounds of all that stay are equal, so membership, ties and scores are exact.
The ten best of a task's earlier shards count as read, so later shards mostly end at their first look.
Ten rows an item leave a task, and a window picks the ten best of all.

Items come in blocks of bounded size, one after the other; only a block's terms and their frequencies are
broadcast. Equality of terms is equality of 64-bit hashes.

Defined results: a null or empty text has no terms; rows that share an item_id (null is one too) are one
item with the terms of all; an item without terms, or whose terms are in no document, has no rows; rows
equal in id and text are one document, rows that share an id only are several, null is the largest id
(see ``corpus``); an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import corpus, named, prepare, stored

SHARD = 8192             # documents
POSTINGS = 2_000_000     # of a shard, about
BLOCK_BYTES = 4 << 20    # of item texts searched at once
READ = 128               # entries of each list read first; doubled from then on
FILTER_BITS = 18

SHARDS = "docs binary, n binary, term binary, doc binary, tf binary, with_terms long, all_terms long"
NUMBERS = {"docs": np.int64, "n": np.int64, "term": np.int32, "doc": np.int32, "tf": np.int32}


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of a column of texts, and the row of each."""
    data, offsets = bt.utf8(column)
    starts, ends, row = bt.words(data, offsets, bt.ALNUM)
    return bt.word_hashes(data, starts, ends, bt.FOLDED), row


class Block:
    """A block of items as term numbers, with the terms' hashes in order."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        hashes, row = terms_of(pa.array(texts, pa.string()))
        self.terms = np.unique(hashes)
        self.ids: list[int | None] = []
        self.items: list[np.ndarray] = []
        rows: dict[int | None, list[np.ndarray]] = {}
        first = bt.first_of(row, len(texts))
        for i, item in enumerate(ids):
            rows.setdefault(item, []).append(hashes[first[i]:first[i + 1]])
        for item, parts in rows.items():
            own = np.unique(np.concatenate(parts))
            if len(own):
                self.ids.append(item)
                self.items.append(np.searchsorted(self.terms, own))
        self.mask = np.zeros(1 << FILTER_BITS, bool)
        self.mask[(self.terms >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known terms among ``hashes``, and their numbers."""
        at = np.flatnonzero(self.mask[(hashes >> U(64 - FILTER_BITS)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
        same = self.terms[number] == hashes[at]
        return at[same], number[same]


def _index(shared):
    def work(batches):
        block, held, docs, postings = shared.value, [], 0, 0
        for batch in batches:
            hashes, row = terms_of(batch.column("text"))
            at, number = block.numbers(hashes)
            key, tf = np.unique(row[at] * len(block.terms) + number, return_counts=True)
            doc, term = np.divmod(key, max(1, len(block.terms)))
            held.append((np.asarray(batch.column("doc_id")), np.diff(bt.first_of(row, batch.num_rows)), term, doc + docs, tf))
            docs, postings = docs + batch.num_rows, postings + len(tf)
            if docs >= SHARD or postings >= POSTINGS:
                yield _shard(held)
                held, docs, postings = [], 0, 0
        if held:
            yield _shard(held)
    return work


def _shard(held) -> pa.RecordBatch:
    parts = dict(zip(NUMBERS, map(np.concatenate, zip(*held))))
    row = {k: [v.astype(NUMBERS[k]).tobytes()] for k, v in parts.items()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()) for k, v in row.items()} | {
        "with_terms": pa.array([int((parts["n"] > 0).sum())], pa.int64()), "all_terms": pa.array([int(parts["n"].sum())], pa.int64())})


def _frequencies(batches):
    """Documents of each term, summed over the shards of a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column("term").to_pylist():
            own = np.bincount(np.frombuffer(raw, np.int32), minlength=len(total))
            own[:len(total)] += total
            total = own
    term = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"term": pa.array(term, pa.int32()), "df": pa.array(total[term], pa.int64())})


def best(scores: np.ndarray, docs: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` highest scores, ties by ascending document."""
    order = np.lexsort((docs, -scores))[:top]
    return scores[order], docs[order]


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers below ``n_docs``) that may be among the ``top`` best, with their exact scores.

    ``lists`` are (documents, impacts), impacts above 0 and descending. Documents that score less than
    ``floor`` are not wanted. All that score as much as the last of the best are returned."""
    lower = np.zeros(n_docs, np.int64)
    unseen = np.ones((len(lists), n_docs), bool)
    alive = np.ones(n_docs, bool)
    at, step = 0, READ
    heads = np.array([impacts[0] for _, impacts in lists], np.int64)
    while True:
        if heads.sum() < floor:  # whatever was not met yet stays out
            alive &= ~unseen.all(axis=0)
        stay = np.flatnonzero(alive)
        upper = lower[stay] + heads @ unseen[:, stay]
        if len(stay) > top:
            floor = max(floor, int(np.partition(lower[stay], len(stay) - top)[len(stay) - top]))
        alive[stay[upper < floor]] = False
        stay, upper = stay[upper >= floor], upper[upper >= floor]
        if (upper == lower[stay]).all():
            return stay, lower[stay]
        for t, (docs, impacts) in enumerate(lists):
            read = docs[at:at + step]
            lower[read] += impacts[at:at + step]  # a document is once in a list
            unseen[t, read] = False
            heads[t] = impacts[at + step] if at + step < len(docs) else 0
        at, step = at + step, 2 * step


def _search(shared, top: int):
    def work(batches):
        block, weights, n_all, length = shared.value
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(block.items)
        for batch in batches:
            for raw in batch.to_pylist():
                docs, n, term, doc, tf = (np.frombuffer(raw[k], kind) for k, kind in NUMBERS.items())
                tf = tf.astype(np.int64)
                m = 100 - 90 + (90 * n * n_all) // max(1, length)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                order = np.lexsort((-impact, term))
                doc, impact, cuts = doc[order], impact[order], np.searchsorted(term[order], np.arange(len(weights) + 1))
                for i, terms in enumerate(block.items):
                    lists = [(doc[cuts[t]:cuts[t + 1]], impact[cuts[t]:cuts[t + 1]] * weights[t])
                             for t in terms.tolist() if cuts[t] < cuts[t + 1] and weights[t] > 0]
                    if not lists:
                        continue
                    scores, ids = found[i]
                    hit, score = nra(lists, len(docs), int(scores[-1]) if len(scores) == top else 1, top)
                    found[i] = best(np.concatenate((scores, score)), np.concatenate((ids, docs[hit])), top)
        sizes = [len(s) for s, _ in found]
        if sum(sizes):
            items = [x for x, k in zip(block.ids, sizes) for _ in range(k)]
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array(items, pa.int64()), "doc_id": pa.array(np.concatenate([d for _, d in found]), pa.int64()),
                "score": pa.array(np.concatenate([s for s, _ in found]), pa.int64())})
    return work


def _one_block(spark: SparkSession, docs: DataFrame, block: Block, top: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)
    shards = stored(docs.mapInArrow(_index(shared), SHARDS), "shards")
    n_all, length = shards.agg(F.sum("with_terms"), F.sum("all_terms")).first()
    counts = shards.select("term").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    weights = np.zeros(len(block.terms), np.int64)
    weights[counts["term"]] = [math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1))) for df in counts["df"].tolist()]
    known = spark.sparkContext.broadcast((block, weights, int(n_all or 0), int(length or 0)))
    found = stored(shards.mapInArrow(_search(known, top), "item_id long, doc_id long, score long"), "found")
    shared.destroy()
    known.destroy()
    return found


def search(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item with a score above 0."""
    spark = df.sparkSession
    prepare(spark)
    docs, _, _, names = corpus(df, id_col, text_col)
    items = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    found = []
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        block = Block([r["item"] for r in part], [r["text"] for r in part])
        if len(block.terms):
            found.append(_one_block(spark, docs, block, top))
    if not found:
        found = [spark.createDataFrame([], "item_id long, doc_id long, score long")]
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return named(ranked.select("item_id", "rank", "doc_id", "score"), names)
