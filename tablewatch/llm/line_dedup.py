"""Line dedup by a deletion-neighbourhood join, over words.

A line (text between newlines) is its words. Two lines of at least ``NEAR_WORDS`` words match if at
most one word was changed, dropped or added; shorter lines match only when their words are equal.
A line goes if an earlier line by (doc_id, line number) matches it; lines without words stay.

1. *Candidates.* With one edit, the first or the last half of the words is untouched. Each line
   sends the hashes of both halves, for itself as the shorter line of a pair and as the longer
   one; lines whose keys all occur once match nothing.
2. *Neighbourhood.* Every candidate line emits the hash of its words and of its words without
   each one of them. Lines that share a variant meet.
3. *Verification.* Two equal variants prove a distance of at most one if one of them is a whole
   line, or if the same place was left out on both sides (then one word was changed there). Two
   variants with different gaps prove nothing and are not used.

For each variant and gap only the earliest line matters, so a task sends the earliest of its buffer
and settles the rest: a line that a third of all documents hold is sent once per buffer.

Texts are shuffled twice, to meet their candidates and to lose their lines; the first shuffle is released
when the numbers of the lines that go are written, and no copy of the texts is stored in between.

Defined results: a null or empty text has no lines with words; rows equal in id and
text are one document, rows that share an id only are several, null the last (see ``corpus``); an empty table gives an empty table; other columns are ignored or, if
asked for, follow as they are. Of the
lines that stay, every byte stays."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm import bytetext as bt
from tablewatch.llm import exchange as ex
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import corpus, named, prepare, stored

NEAR_WORDS = 8
NULL_ID = -1 << 62
WHOLE = 0           # "no word left out"; the gap before word i is i + 1
NEWLINE = 10


class _Lines:
    """The lines with words of a batch: row, line number in the row, and their span of words."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = bt.utf8(batch.column("text"))
        starts, ends, word_row = bt.words(data, offsets, bt.SPACED)
        breaks = np.flatnonzero(data == NEWLINE)
        line = np.searchsorted(breaks, starts)
        new = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (word_row[1:] != word_row[:-1])))) if len(starts) else np.zeros(0, np.int64)
        self.hashes = bt.word_hashes(data, starts, ends)
        self.begin, self.end = new, np.append(new[1:], len(starts)) if len(new) else new
        self.row = word_row[new]
        self.number = (line[new] - np.searchsorted(breaks, offsets[self.row])).astype(np.int32)
        self.ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))[self.row]


def _span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values from start to end; starts ascend."""
    out, i = np.empty(len(starts), U), 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, lo + bt.PIECE)))
        hi = int(ends[i:j].max())
        up, down = bt.powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, U)
        np.cumsum(values[lo:hi] * up[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = bt.mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U))
        i = j
    return out


def _half_keys(batch: pa.RecordBatch):
    """Exact keys of short lines and half keys of the others."""
    lines = _Lines(batch)
    size = lines.end - lines.begin
    short, near = np.flatnonzero(size < NEAR_WORDS), np.flatnonzero(size >= NEAR_WORDS)
    at, keys = [short], [_span_hashes(lines.hashes, lines.begin[short], lines.end[short])]
    b, e, n = lines.begin[near], lines.end[near], size[near]
    for shorter in (n, n - 1):  # words of the shorter line of the pairs looked for
        half = shorter // 2
        for side, (s, t) in enumerate(((b, b + half), (e - half, e))):
            at.append(near)
            keys.append(bt.mix(_span_hashes(lines.hashes, s, t) + U(2 + side) * shorter.astype(U)))
    at, key = np.concatenate(at), np.concatenate(keys)
    order = np.argsort(at, kind="stable")
    at, key = at[order], key[order]
    return lines.ids[at], lines.number[at], key, np.full(len(at), ex.INDEX, np.uint8)


def _variants(batch: pa.RecordBatch):
    """All variants of the candidate lines: (document, line, gap, hash)."""
    lines = _Lines(batch)
    ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
    number, of = ex.positions(batch.column("hits"))
    wanted = np.unique(of << 32 | number)
    pick = np.flatnonzero(np.isin(lines.row << 32 | lines.number, wanted))
    b, e = lines.begin[pick], lines.end[pick]
    whole = _span_hashes(lines.hashes, b, e)
    size = e - b
    whole[size < NEAR_WORDS] ^= U(0x5DEECE66D)  # short lines meet whole short lines only
    doc, num, gap, key = [ids[lines.row[pick]]], [lines.number[pick]], [np.zeros(len(pick), np.int32)], [whole]
    near = np.flatnonzero(size >= NEAR_WORDS)
    i = 0
    while i < len(near):
        j = max(i + 1, i + int(np.searchsorted(np.cumsum(size[near[i:]]), bt.PIECE, side="right")))
        part = near[i:j]
        count = size[part]
        line = np.repeat(np.arange(len(part)), count)
        step = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
        values = lines.hashes[np.repeat(b[part], count) + step]
        up, down = bt.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        start = (np.cumsum(count) - count)[line]
        g = np.arange(len(values))
        left = sums[g] - sums[start]
        right = (sums[start + count[line]] - sums[g + 1]) * down[1]
        key.append(bt.mix((left + right) * down[start] + (count[line] - 1).astype(U)))
        doc.append(ids[lines.row[pick[part]]][line])
        num.append(lines.number[pick[part]][line])
        gap.append((step + 1).astype(np.int32))
        i = j
    return tuple(map(np.concatenate, (doc, num, gap, key)))


def _matched(doc, num, gap, key):
    """Entries with an earlier match in their variant's group, and each (variant, gap)'s earliest."""
    order = np.lexsort((gap, num, doc, key))
    key, gap_of = key[order], gap[order]
    at = np.arange(len(order))
    starts, counts = bt.runs_of(key)
    group = np.repeat(np.arange(len(starts)), counts)
    line = np.stack((doc[order], num[order].astype(np.int64)), axis=1)
    none = len(order)
    # Earliest entry of the group, earliest whole line, earliest with the same gap.
    whole = np.minimum.reduceat(np.where(gap_of == WHOLE, at, none), starts)[group]
    by_gap = np.lexsort((at, gap_of, group))
    same_group = (group[by_gap][1:] == group[by_gap][:-1]) & (gap_of[by_gap][1:] == gap_of[by_gap][:-1])
    lead = np.maximum.accumulate(np.where(np.concatenate(([True], ~same_group)), at, 0))
    peer = np.empty(len(order), np.int64)
    peer[by_gap] = by_gap[lead]
    any_of = starts[group]

    def before(other):  # an earlier line, not another variant of the same one
        other = np.minimum(other, at)
        return (line[other] != line[at]).any(axis=1) & (other < at)

    hit = before(peer) | before(np.where(whole < none, whole, at)) | ((gap_of == WHOLE) & before(any_of))
    return order[hit], order[peer == at]


def _pack(doc, num, gap, key) -> bytes:
    head = ex.pack(doc, num, np.zeros(len(doc), np.uint8), key, 8 if len(gap) else 0)
    return struct.pack("<I", len(head)) + head + ex.planes(gap.astype(np.int32))


def _unpack(blob: bytes):
    size = struct.unpack_from("<I", blob)[0]
    doc, num, _, key = ex.unpack(blob[4:4 + size])
    gap = np.zeros(0, np.int32) if len(blob) == 4 + size else ex.unplanes(memoryview(blob), 4 + size, len(doc), np.int32)[0]
    return doc, num, gap, key


def _send(buckets: int):
    def send(doc, num, gap, key):
        hit, first = _matched(doc, num, gap, key)
        if len(hit):
            lines = np.unique(np.stack((doc[hit], num[hit].astype(np.int64)), axis=1), axis=0)
            empty = np.zeros(0, np.int32)
            yield buckets + int(lines[0, 0]) % buckets, _pack(lines[:, 0], lines[:, 1], empty, np.zeros(len(lines), U))
        first = np.sort(first)
        part = ((key[first] >> U(32)) * U(buckets) >> U(32)).astype(np.int32)
        split = np.argsort(part, kind="stable")
        first, part = first[split], part[split]
        for s, c in zip(*map(np.ndarray.tolist, bt.runs_of(part))):
            e = first[s:s + c]
            yield int(part[s]), _pack(doc[e], num[e], gap[e], key[e])

    def mapper(batches):
        held, size = [], 0
        for batch in batches:
            got = _variants(batch)
            held.append(got)
            size += len(got[0])
            if size >= ex.BUFFER:
                yield from rows(send(*map(np.concatenate, zip(*held))))
                held, size = [], 0
        if size:
            yield from rows(send(*map(np.concatenate, zip(*held))))

    def rows(sent):
        for bucket, blob in sent:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "blob": pa.array([blob], pa.binary())})

    return mapper


def _join(buckets: int):
    def reducer(table: pa.Table) -> pa.Table:
        doc, num, gap, key = map(np.concatenate, zip(*(_unpack(b) for b in table.column("blob").to_pylist())))
        if table.column("bucket")[0].as_py() < buckets:
            hit, _ = _matched(doc, num, gap, key)
            lines = np.unique(np.stack((doc[hit], num[hit].astype(np.int64)), axis=1), axis=0)
            doc, num = lines[:, 0], lines[:, 1]
        return pa.Table.from_batches([ex.hits_rows(doc, num)])
    return reducer


def _kept_lines(batches):
    """Columns doc_id, text, hits and any others: texts without their hits, counts of lines, the others as they are."""
    for batch in batches:
        doc, text, hits, *others = batch.columns
        n_lines = pc.if_else(pc.equal(pc.binary_length(text), 0), 0, pc.add(pc.count_substring(text, "\n"), 1)).cast(pa.int64())
        touched = np.flatnonzero(np.asarray(hits.is_valid()))
        removed, mended = np.zeros(batch.num_rows, np.int64), []
        for i, old, blobs in zip(touched.tolist(), text.take(touched).to_pylist(), hits.take(touched).to_pylist()):
            gone = set(np.frombuffer(b"".join(blobs), "<i4").tolist())
            mended.append("\n".join(x for j, x in enumerate(old.split("\n")) if j not in gone))
            removed[i] = len(gone)
        if mended:
            text = pc.replace_with_mask(text, hits.is_valid(), pa.array(mended, text.type))
        yield pa.RecordBatch.from_arrays([doc, text, n_lines, pa.array(removed), *others], ["doc_id", "text", "n_lines", "n_removed", *batch.schema.names[3:]])


def _gone_lines(docs: DataFrame, size: int) -> DataFrame:
    """``(of, hits)``: the numbers of the lines that an earlier line matches, of each document that has any."""
    hits = stored(ex.per_document(ex.repeated(docs, _half_keys, size // 60, 6)).withColumnRenamed("doc_id", "of"), "half-hits")
    # About one variant for each six bytes of candidate lines: sized by the texts they are in.
    lengths = docs.select("doc_id", F.octet_length("text").alias("bytes"))
    n_variants = int(lengths.join(hits, lengths.doc_id == hits.of, "left_semi").agg(F.sum("bytes")).first()[0] or 0) // 6
    buckets = max(ex.LEAST_BUCKETS, -(-n_variants // (ex.BUCKET // 2)))
    found = (docs.join(hits, docs.doc_id == hits.of).select("doc_id", "text", "hits").mapInArrow(_send(buckets), "bucket int, blob binary")
             .groupBy("bucket").applyInArrow(_join(buckets), "doc_id long, hits binary, n long"))
    return stored(ex.per_document(found).select(F.col("doc_id").alias("of"), "hits"), "gone-lines")


def remove_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", others: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed)``: each text without the lines that an earlier line matches.

    ``others`` names columns of ``df`` that follow as they are, so that whole rows need no second join
    with their texts; the ids must then tell all rows apart."""
    prepare(df.sparkSession)
    docs, _, size, names = corpus(df, id_col, text_col)
    if others and names is not None:
        raise ValueError("other columns need ids that are there and differ")
    gone = _gone_lines(docs, size)
    whole = docs
    if others:
        whole = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                          *(F.col(f"`{c}`") for c in others))
    rows = whole.join(gone, whole.doc_id == gone.of, "left").select(whole["doc_id"], whole["text"], gone["hits"], *(whole[f"`{c}`"] for c in others))
    schema = T.StructType([T.StructField(c, t) for c, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("n_lines", T.LongType()), ("n_removed", T.LongType()))]
                          + [df.schema[c] for c in others])
    return named(rows.mapInArrow(_kept_lines, schema), names)
