"""Which keys of which documents occur more than once in the corpus, as one compact shuffle.

A corpus has one key for every word or every few bytes: as plain rows they would outweigh the
texts many times. Here each task packs its keys by key range ("bucket") into column-wise blobs of
about seven bytes a key. Keys that repeat within a task's buffer are settled there and sent once,
so a passage that a third of all documents share reaches a bucket once per buffer, not once per
document. Every bucket holds a bounded number of keys because the number of buckets follows the
corpus."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.bytetext import U, runs_of

BUFFER = 1 << 20         # keys a task gathers before it sends them
BUCKET = 3_000_000       # keys a bucket should hold
LEAST_BUCKETS = 64
INDEX, SETTLED = 1, 2    # flags of a key

Extract = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def planes(a: np.ndarray) -> bytes:
    """Fixed-width values byte plane by byte plane: small numbers become runs of zeros, which the
    shuffle's compression removes."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def unplanes(blob: memoryview, at: int, n: int, dtype) -> tuple[np.ndarray, int]:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(dtype).reshape(n), at + n * width


def pack(doc: np.ndarray, pos: np.ndarray, flag: np.ndarray, key: np.ndarray, width: int) -> bytes:
    """Entries in document order. The ``width`` low bytes of each key are sent."""
    starts, counts = runs_of(doc)
    low = np.ascontiguousarray(key).view(np.uint8).reshape(len(key), 8)[:, :width].T.tobytes() if width else b""
    return b"".join((struct.pack("<III", len(doc), len(starts), width), planes(doc[starts]),
                     planes(counts.astype(np.int32)), planes(np.diff(pos.astype(np.int32), prepend=np.int32(0))),
                     flag.astype(np.uint8).tobytes(), low))


def unpack(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    view = memoryview(blob)
    n, docs, width = struct.unpack_from("<III", view)
    ids, at = unplanes(view, 12, docs, np.int64)
    counts, at = unplanes(view, at, docs, np.int32)
    delta, at = unplanes(view, at, n, np.int32)
    flag = np.frombuffer(view, np.uint8, n, at)
    at += n
    key = np.zeros((n, 8), np.uint8)  # the bytes sent become the high ones, by which keys are sorted
    if width:
        key[:, 8 - width:] = np.frombuffer(view, np.uint8, n * width, at).reshape(width, n).T
    return np.repeat(ids, counts), np.cumsum(delta, dtype=np.int64).astype(np.int32), flag, key.view(U).reshape(n)


def by_key(key: np.ndarray) -> np.ndarray:
    """An order that puts equal keys side by side. Sorts packed values: the key's high bits above
    the index, several times faster than an argsort; equal high bits of different keys only split
    a group, which is settled by comparing whole keys afterwards."""
    bits = max(1, int(len(key) - 1).bit_length())
    if bits > 22:
        return np.argsort(key, kind="stable")
    keep = U((1 << bits) - 1)
    both = np.sort((key & ~keep) | np.arange(len(key), dtype=U))
    order = (both & keep).astype(np.int64)
    high = both >> U(bits)
    # Where high bits agree but keys differ, order these few by the whole key.
    k = key[order]
    clash = np.flatnonzero((high[1:] == high[:-1]) & (k[1:] != k[:-1]))
    for c in np.unique(high[clash]):
        at = np.searchsorted(high, [c, c], side="left")[0], np.searchsorted(high, c, side="right")
        part = order[at[0]:at[1]]
        order[at[0]:at[1]] = part[np.argsort(key[part], kind="stable")]
    return order


def hits_rows(doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row per document: its positions as little-endian 32-bit numbers, ascending."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order].astype("<i4")
    starts, counts = runs_of(doc)
    raw = pos.tobytes()
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(doc[starts], pa.int64()),
        "hits": pa.array([raw[4 * s:4 * (s + c)] for s, c in zip(starts.tolist(), counts.tolist())], pa.binary()),
        "n": pa.array(counts, pa.int64())})


def repeated(df: DataFrame, extract: Extract, n_keys: int, width: int, later: bool = False) -> DataFrame:
    """``(doc_id, hits, n)``: positions of keys that occur more than once, several rows per document.

    ``extract`` turns a batch of ``df`` into arrays (document id, position, 64-bit key, flag). Each
    (document, position) has one key. A key's occurrences are hits if there are two or more, one
    of them flagged ``INDEX``; with ``later``, all but the first by (document, position).
    ``n_keys`` sizes the buckets. ``width`` bytes of each key are compared beside its bucket (8: all)."""
    buckets = max(LEAST_BUCKETS, -(-n_keys // BUCKET))

    def send(doc, pos, key, flag) -> Iterator[tuple[int, bytes]]:
        order = by_key(key)
        k = key[order]
        starts, counts = runs_of(k)
        first, flag = order[starts], flag.astype(np.uint8)
        if len(starts) < len(k):
            if later:  # the first of each group goes on, the others are settled
                sub = np.lexsort((pos[order], doc[order], np.repeat(np.arange(len(starts)), counts)))
                order = order[sub]
                first = order[starts]
                done = np.delete(order, starts)
            else:
                done = order[np.repeat(counts > 1, counts)]
                flag[first] = np.bitwise_or.reduceat(flag[order], starts) | (SETTLED * (counts > 1)).astype(np.uint8)
            done.sort()
            # Settled hits travel as positions only, dealt by their first document.
            yield buckets + int(doc[done[0]]) % buckets, pack(doc[done], pos[done], flag[done], key[done], 0)
        first = np.sort(first)
        part = ((key[first] >> U(32)) * U(buckets) >> U(32)).astype(np.int32)
        split = np.argsort(part.astype(np.uint16) if buckets < 1 << 16 else part, kind="stable")
        first, part = first[split], part[split]
        for s, c in zip(*map(np.ndarray.tolist, runs_of(part))):
            e = first[s:s + c]
            yield int(part[s]), pack(doc[e], pos[e], flag[e], key[e], width)

    def rows(sent) -> Iterator[pa.RecordBatch]:
        for bucket, blob in sent:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "blob": pa.array([blob], pa.binary())})

    def mapper(batches):
        held, size = [], 0
        for batch in batches:
            got = extract(batch)
            if len(got[0]):
                held.append(got)
                size += len(got[0])
            if size >= BUFFER:
                yield from rows(send(*map(np.concatenate, zip(*held))))
                held, size = [], 0
        if held:
            yield from rows(send(*map(np.concatenate, zip(*held))))

    def reducer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        doc, pos, flag, key = map(np.concatenate, zip(*(unpack(b) for b in table.column("blob").to_pylist())))
        if bucket < buckets:
            order = by_key(key)
            starts, counts = runs_of(key[order])
            if later:
                group = np.repeat(np.arange(len(starts)), counts)
                many = np.flatnonzero(counts[group] > 1)
                sub = order[many]
                sub = sub[np.lexsort((pos[sub], doc[sub], group[many]))]
                mine = group[many]
                hit = sub[np.concatenate(([False], mine[1:] == mine[:-1]))] if len(sub) else sub
            else:
                ok = (counts > 1) & ((np.bitwise_or.reduceat(flag[order], starts) & INDEX) > 0)
                hit = order[np.repeat(ok, counts)]
                hit = hit[(flag[hit] & SETTLED) == 0]
            doc, pos = doc[hit], pos[hit]
        return pa.Table.from_batches([hits_rows(doc, pos)])

    sent = df.mapInArrow(mapper, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(reducer, "doc_id long, hits binary, n long")


def per_document(hits: DataFrame) -> DataFrame:
    """``(doc_id, hits, n)`` with one row per document: the list of its blobs, no longer than the document."""
    return hits.groupBy("doc_id").agg(F.collect_list("hits").alias("hits"), F.sum("n").alias("n"))


def positions(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all rows of a ``hits`` list column, and the row of each."""
    rows, parts = [], []
    for i, blobs in enumerate(column.to_pylist()):
        if blobs:
            got = np.frombuffer(b"".join(blobs), "<i4")
            parts.append(got)
            rows.append(np.full(len(got), i, np.int64))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(parts).astype(np.int64), np.concatenate(rows)
