"""Suffix-array dedup over bytes, by longest-previous-factor arrays.

A suffix array of the whole corpus would outweigh it many times, and only repeats of at least
``length`` bytes matter. So the suffixes are dealt to many small arrays such that equal
``length``-byte strings always meet:

1. Of the ``GRAM``-byte strings inside each ``length``-byte window, the one with the smallest hash
   (the leftmost, on a tie) is the window's anchor. Equal windows have equal anchors at the same
   offset. One anchor serves about ``length / 2`` neighbouring windows. Anchors that occur once in
   the corpus are out: their windows are unique.
2. Each stretch of windows with one repeated anchor becomes a segment (its bytes), dealt by the
   anchor's hash. Equal segments in one task's buffer are settled there and sent once, so a huge
   group of copies does not meet in one task.
3. Each bucket's segments are one text; its suffixes are sorted by their first ``length`` bytes by
   prefix doubling. In suffix order, ties by text position, the previous and the next smaller
   position of a suffix give its longest previous factor; it reaches ``length`` exactly if an
   earlier copy exists. The mirrored arrays (previous and next larger position) tell whether a
   later one does.

Defined results: a null or empty text has no bytes; rows equal in id and text are one
document, rows that share an id only are several (see ``corpus``); texts shorter than ``length`` keep all bytes; an empty table gives an empty table;
other columns are ignored."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm import exchange as ex
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import corpus, named, prepare, stored

GRAM = 32
CHUNK = 1 << 18               # bytes hashed at a time
SEGMENT_BUFFER = 12 << 20     # segment bytes a task gathers before it sends them
ARRAY_BYTES = 1_200_000       # bytes of one suffix array, as planned
NULL_ID = -1 << 62


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of window starts with one anchor: first start, last start, anchor place, anchor hash."""
    span = length - GRAM + 1
    parts = []
    for lo in range(0, max(0, len(data) - length + 1), CHUNK):
        hi = min(len(data), lo + CHUNK + length - 1)
        gram = bt.rolling(bt.BYTES[data[lo:hi]], GRAM)
        place = np.arange(len(gram), dtype=U)
        least = (gram & ~U((1 << 20) - 1)) | place  # by hash, then leftmost
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:len(least) - width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        start = np.arange(lo, lo + len(least))
        ok = start + length <= offsets[np.searchsorted(offsets, start, side="right")]  # within its row
        start, at = start[ok], (least[ok] & U((1 << 20) - 1)).astype(np.int64)
        if len(start):
            # A stretch ends where the anchor changes or the next window is of another row.
            cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
            last = np.append(cut[1:], len(start)) - 1
            # Anchors have the smallest hashes, so their keys are mixed anew before they are dealt by range.
            parts.append((start[cut], start[last], at[cut] + lo, bt.mix(gram[at[cut]] + U(1))))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(U)
    return tuple(map(np.concatenate, zip(*parts)))


class _Anchors:
    def __init__(self, length: int):
        self.length = length

    def __call__(self, batch: pa.RecordBatch):
        ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
        data, offsets = bt.utf8(batch.column("text"))
        _, _, at, key = anchors(data, offsets, self.length)
        new = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
        at, key = at[new], key[new]  # a stretch cut at a chunk's end has its anchor twice
        row = np.searchsorted(offsets, at, side="right") - 1
        return ids[row], (at - offsets[row]).astype(np.int32), key, np.full(len(at), ex.INDEX, np.uint8)


def suffix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at every place of ``text`` by its first ``length`` bytes; equal ranks for
    equal strings. Prefix doubling from 5 bytes; suffixes past the end count as padded."""
    n = len(text)
    wide = np.zeros(n + 5, U)
    wide[:n] = text
    head = np.zeros(n, U)
    for i in range(5):
        head = (head << U(8)) | wide[i:n + i]
    rank = _dense(head, 40)
    have = min(5, length)
    while have < length:
        step = min(have, length - have)
        tail = np.zeros(n, U)
        tail[:n - step] = rank[step:] + U(1)
        bits = int(n).bit_length()
        rank = _dense((rank << U(bits)) | tail, 2 * bits)
        have += step
    return rank


def _dense(value: np.ndarray, bits: int) -> np.ndarray:
    n = len(value)
    low = max(1, (n - 1).bit_length())
    if bits + low <= 64:  # value and place in one word: a plain sort does it
        both = np.sort((value << U(low)) | np.arange(n, dtype=U))
        order, ordered = (both & U((1 << low) - 1)).astype(np.int64), both >> U(low)
    else:
        order = np.argsort(value, kind="stable")
        ordered = value[order]
    rank = np.empty(n, U)
    rank[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1]))).astype(U)
    return rank


def longest_factors(rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous and the longest next factor of each suffix reach the compared
    length. ``place`` is the suffix's position in the corpus' order.

    In suffix order with ties by place, a suffix that has an earlier copy has it as direct
    predecessor: that is its previous smaller position, and the common prefix is the compared
    length. The next smaller position lies outside the run of equal suffixes, with a shorter common
    prefix, so it never reaches it. Next factors mirror this."""
    order = np.lexsort((place, rank))
    ranked = rank[order]
    same = ranked[1:] == ranked[:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:][same]] = True
    later[order[:-1][same]] = True
    return earlier, later


def _send_segments(length: int, buckets: int, keep_first: bool):
    def send(ids, first, count, key, content, texts):
        order = np.lexsort((first, ids, content, key))
        same = (key[order[1:]] == key[order[:-1]]) & (content[order[1:]] == content[order[:-1]])
        new = np.concatenate(([True], ~same))
        starts = np.flatnonzero(new)
        many = np.diff(np.append(starts, len(order))) > 1
        sent = order[starts]
        settled = np.zeros(len(ids), np.uint8)
        if keep_first:
            done = order[~new]
        else:
            done = order[np.repeat(many, np.diff(np.append(starts, len(order))))]
            settled[sent[many]] = ex.SETTLED
        if len(done):
            yield buckets + int(ids[done[0]]) % buckets, _pack(ids[done], first[done], count[done], settled[done], None)
        part = ((key[sent] >> U(32)) * U(buckets) >> U(32)).astype(np.int32)
        split = np.argsort(part, kind="stable")
        sent, part = sent[split], part[split]
        for s, c in zip(*map(np.ndarray.tolist, bt.runs_of(part))):
            e = sent[s:s + c]
            yield int(part[s]), _pack(ids[e], first[e], count[e], settled[e], [texts[i] for i in e.tolist()])

    def mapper(batches):
        held, texts, size = [], [], 0
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
            data, offsets = bt.utf8(batch.column("text"))
            lo, hi, at, key = anchors(data, offsets, length)
            place, row = ex.positions(batch.column("hits"))
            keep = np.isin(at, offsets[row] + place)
            lo, hi, key = lo[keep], hi[keep], key[keep]
            if not len(lo):
                continue
            row = np.searchsorted(offsets, lo, side="right") - 1
            raw = data.tobytes()
            texts += [raw[s:e] for s, e in zip(lo.tolist(), (hi + length).tolist())]
            content = bt.word_hashes(data, lo, hi + length)
            held.append((ids[row], lo - offsets[row], hi - lo + 1, key, content))
            size += int((hi + length - lo).sum())
            if size >= SEGMENT_BUFFER:
                yield from _rows(send(*map(np.concatenate, zip(*held)), texts))
                held, texts, size = [], [], 0
        if held:
            yield from _rows(send(*map(np.concatenate, zip(*held)), texts))
    return mapper


def _rows(sent):
    for bucket, blob in sent:
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "blob": pa.array([blob], pa.binary())})


def _pack(ids, first, count, settled, texts) -> bytes:
    return b"".join((struct.pack("<I", len(ids)), ids.astype("<i8").tobytes(), first.astype("<i4").tobytes(),
                     count.astype("<i4").tobytes(), settled.tobytes(), *(texts or ())))


def _unpack(blob: bytes):
    n = struct.unpack_from("<I", blob)[0]
    ids, first = np.frombuffer(blob, "<i8", n, 4), np.frombuffer(blob, "<i4", n, 4 + 8 * n)
    count, settled = np.frombuffer(blob, "<i4", n, 4 + 12 * n), np.frombuffer(blob, np.uint8, n, 4 + 16 * n)
    return ids, first, count, settled, np.frombuffer(blob, np.uint8, -1, 4 + 17 * n)


def _spans(ids, first, count) -> pa.Table:
    order = np.lexsort((first, ids))
    ids, pairs = ids[order], np.stack((first[order], count[order]), axis=1).astype("<i4")
    starts, counts = bt.runs_of(ids)
    raw = pairs.tobytes()
    return pa.table({"doc_id": pa.array(ids[starts], pa.int64()),
                     "spans": pa.array([raw[8 * s:8 * (s + c)] for s, c in zip(starts.tolist(), counts.tolist())], pa.binary())})


def _sort_suffixes(length: int, buckets: int, keep_first: bool):
    def reducer(table: pa.Table) -> pa.Table:
        ids, first, count, settled, text = map(np.concatenate, zip(*(_unpack(b) for b in table.column("blob").to_pylist())))
        if table.column("bucket")[0].as_py() >= buckets:
            return _spans(ids, first, count)
        size = count + length - 1
        begin = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(ids)), count)
        step = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
        rank = suffix_ranks(text, length)[begin[segment] + step]
        # Places in the corpus' order: by document, then position.
        place = np.empty(len(segment), np.int64)
        place[np.lexsort((first[segment] + step, ids[segment]))] = np.arange(len(segment))
        earlier, later = longest_factors(rank, place)
        hit = np.flatnonzero(earlier if keep_first else (earlier | later) & (settled[segment] == 0))
        if not len(hit):
            return _spans(ids[:0], first[:0], count[:0])
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(hit) > 1) | (segment[hit[1:]] != segment[hit[:-1]]))))
        runs = np.diff(np.append(cut, len(hit)))
        at = hit[cut]
        return _spans(ids[segment[at]], first[segment[at]] + step[at], runs)
    return reducer


def _removed(length: int):
    def work(batches):
        for batch in batches:
            data, offsets = bt.utf8(batch.column("text"))
            n = batch.num_rows
            pairs, row = ex.positions(batch.column("spans"))
            start, run, row = pairs[0::2], pairs[1::2], row[0::2]
            gone = bt.covered(len(data), offsets[row] + start, offsets[row] + start + run - 1 + length)
            left = np.concatenate(([0], np.cumsum(~gone, dtype=np.int32)))[offsets]
            kept = data[~gone].tobytes()
            head = np.zeros(len(data), bool)
            head[1:] = gone[:-1]
            head[offsets[:-1][offsets[:-1] < len(data)]] = False
            rises = np.searchsorted(offsets, np.flatnonzero(gone & ~head), side="right") - 1
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "kept": pa.array([kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())], pa.binary()),
                "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_removed": pa.array(np.diff(offsets) - np.diff(left), pa.int64()),
                "n_spans": pa.array(np.bincount(rises, minlength=n), pa.int64())})
    return work


def remove_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                          keep_first: bool = False) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)``: each text's UTF-8 bytes without those covered
    by a ``length``-byte string that also starts elsewhere in the corpus. With ``keep_first`` only
    later copies by (doc_id, position) go. ``length`` is more than ``GRAM``."""
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    prepare(df.sparkSession)
    docs, _, size, names = corpus(df, id_col, text_col)
    hits = stored(ex.per_document(ex.repeated(docs, _Anchors(length), size // 80, 8)), "anchor-hits")
    docs = stored(docs.join(hits, docs.doc_id.eqNullSafe(F.when(hits.doc_id != NULL_ID, hits.doc_id)), "left")
                  .select(docs.doc_id, "text", "hits", "n"), "with-anchors")
    touched = docs.filter("hits is not null")
    found = touched.agg(F.sum("n")).first()[0] or 0
    buckets = max(ex.LEAST_BUCKETS, -(-int(found) * (length + 90) // ARRAY_BYTES))
    spans = (touched.select("doc_id", "text", "hits")
             .mapInArrow(_send_segments(length, buckets, keep_first), "bucket int, blob binary")
             .groupBy("bucket").applyInArrow(_sort_suffixes(length, buckets, keep_first), "doc_id long, spans binary")
             .groupBy(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("of")).agg(F.collect_list("spans").alias("spans")))
    mended = touched.join(spans, touched.doc_id.eqNullSafe(spans.of), "left").select("doc_id", "text", "spans")
    untouched = docs.filter("hits is null").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("spans"))
    return named(untouched.union(mended).mapInArrow(
        _removed(length), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"), names)
