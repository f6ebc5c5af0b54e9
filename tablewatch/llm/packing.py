"""Best-fit packing of token sequences by bin completion.

A document is its token ids and an end id. Only documents longer than a sequence are cut: full
pieces, and a first piece with the rest. Pieces of one length are interchangeable, so the packing
problem is the number of pieces of each length: at most ``capacity`` numbers, whatever the corpus.
On these, branch and bound fills one sequence at a time around the largest piece left. It branches
over undominated fillings (none that a larger piece could improve), applies a filling as often as
the numbers allow, and prunes when the waste so far plus the space that the rest needs at least
cannot beat the best packing known. The first incumbent is best fit decreasing.

The solution is a list of patterns. Every piece is ranked within its length, in buckets that split
a length that a third of all pieces share, and its rank gives its sequence and place.

Defined results: a null or empty text is the end id alone; rows equal in id and text are one
document, rows that share an id only are several under that id (see ``corpus``); an empty table gives an empty table; other columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bpe import encoder
from tablewatch.llm.common import corpus, named, prepare, stored

STEPS = 6_000        # fillings applied before the best packing so far is taken
BRANCHES = 4         # fillings tried at a branching
BUCKET_PIECES = 2_000


# -- the packing of a histogram ------------------------------------------------------------

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by volume, and by the pieces that cannot share one with a piece
    larger than ``capacity - k`` (for every k up to half the capacity)."""
    sizes = np.array(sorted(counts), np.int64)
    number = np.array([counts[s] for s in sizes], np.int64)
    best = -(-int((sizes * number).sum()) // capacity)
    for k in range(0, capacity // 2 + 1):
        alone = int(number[sizes > capacity - k].sum())
        half = (sizes > capacity // 2) & (sizes <= capacity - k)
        large = int(number[half].sum())
        small = (sizes >= k) & (sizes <= capacity // 2)
        spare = large * capacity - int((sizes * number)[half].sum())
        best = max(best, alone + large + max(0, -(-(int((sizes * number)[small].sum()) - spare) // capacity)))
    return best


class _Counts:
    """Pieces left of each size, with the largest size that fits found in one step."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for size, number in counts.items():
            self.left[size] = number

    def sizes(self) -> np.ndarray:
        """Sizes left, descending."""
        return np.flatnonzero(self.left)[::-1]


def fillings(left: np.ndarray, largest: int, room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` beside a piece of size ``largest``, least waste first.

    One piece: the largest that fits. More: after each choice of a first piece, the largest that fits
    beside it, and so on. A filling that a larger piece could improve never appears."""
    have = np.flatnonzero(left[:room + 1])
    if not len(have):
        return [()]
    out: dict[tuple[int, ...], int] = {}
    for first in have[::-1][:4 * BRANCHES].tolist() + [int(x) for x in have[::-1][4 * BRANCHES:] if left[room - x] or room == x][:BRANCHES]:
        chosen, space = [], room
        used: dict[int, int] = {largest: 1}
        size = first
        while size:
            chosen.append(size)
            used[size] = used.get(size, 0) + 1
            space -= size
            size = 0
            for fit in have[:np.searchsorted(have, min(space, chosen[-1]), side="right")][::-1].tolist():
                if left[fit] > used.get(fit, 0):
                    size = fit
                    break
        if all(left[s] >= used[s] for s in chosen):
            out[tuple(sorted(chosen, reverse=True))] = space
        if space == 0 and len(out) >= BRANCHES:
            break
    # A filling whose pieces fit one to one into another's is dominated by it.
    ranked = sorted(out, key=lambda c: (out[c], len(c), [-x for x in c]))
    kept: list[tuple[int, ...]] = []
    for c in ranked:
        if not any(len(c) <= len(k) and all(x <= y for x, y in zip(c, k)) for k in kept):
            kept.append(c)
    return kept[:BRANCHES] or [()]


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit decreasing on the numbers: (times, pieces of a sequence)."""
    left = _Counts(counts, capacity).left
    out = []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        out.append(_apply(left, largest, fillings(left, largest, capacity - largest)[0]))
    return out


def _apply(left: np.ndarray, largest: int, filling: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    pattern = (largest, *filling)
    need = {s: pattern.count(s) for s in pattern}
    times = min(int(left[s]) // n for s, n in need.items())
    for s, n in need.items():
        left[s] -= times * n
    return times, pattern


def bin_completion(counts: dict[int, int], capacity: int, steps: int = STEPS) -> tuple[list[tuple[int, tuple[int, ...]]], int, int]:
    """Patterns, the number of sequences, and the lower bound."""
    counts = {s: n for s, n in counts.items() if n > 0}
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError(f"piece sizes must lie between 1 and {capacity}")
    bound = lower_bound(counts, capacity) if counts else 0
    best = _best_fit(counts, capacity)
    best_n = sum(t for t, _ in best)
    sizes = np.arange(capacity + 1)
    start = _Counts(counts, capacity).left
    stack = [(start, (), 0)]  # pieces left, patterns so far (linked list), sequences so far
    while stack and best_n > bound and steps > 0:
        left, taken, used = stack.pop()
        # Dive along the best filling, leaving the others for later.
        while steps > 0:
            steps -= 1
            rest = int((left * sizes).sum())
            if rest == 0:
                if used < best_n:
                    best_n, best = used, _unlinked(taken)
                break
            if used + -(-rest // capacity) >= best_n:
                break
            largest = int(np.flatnonzero(left)[-1])
            options = fillings(left, largest, capacity - largest)
            for other in options[:0:-1]:
                branch = left.copy()
                step = _apply(branch, largest, other)
                if step[0]:
                    stack.append((branch, (step, taken), used + step[0]))
            left = left.copy()
            step = _apply(left, largest, options[0])
            taken, used = (step, taken), used + step[0]
    return best, best_n, bound


def _unlinked(taken):
    out = []
    while taken:
        step, taken = taken
        out.append(step)
    return out[::-1]


# -- pieces and their places ---------------------------------------------------------------

def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def work(batches):
        enc = encoder(path)
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for lo, ids, rows in enc.encode(*bt.utf8(batch.column("text"))):
                cols = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
                for i in range(len(rows) - 1):
                    own = np.append(ids[rows[i]:rows[i + 1]], np.uint32(end_id)).astype("<u4")
                    n = len(own)
                    first = n % capacity or capacity
                    starts = [0, *range(first, n, capacity)]
                    for piece, (s, e) in enumerate(zip(starts, [*starts[1:], n])):
                        raw = own[s:e].tobytes()
                        for name, value in zip(cols, (docs[lo + i], piece, s, e - s, zlib.crc32(raw), raw)):
                            cols[name].append(value)
                if not with_ids:
                    del cols["ids"]
                kinds = {"piece": pa.int32(), "ids": pa.binary()}
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()})
    return work


def _place(patterns: list[tuple[int, tuple[int, ...]]]):
    """Sequence and offset of the r-th piece of each length."""
    slots: dict[int, list[tuple[int, int, int, list[int]]]] = {}
    begin, taken = 0, {}
    for times, pattern in patterns:
        offsets: dict[int, list[int]] = {}
        at = 0
        for size in pattern:
            offsets.setdefault(size, []).append(at)
            at += size
        for size, where in offsets.items():
            slots.setdefault(size, []).append((taken.get(size, 0), begin, len(where), where))
            taken[size] = taken.get(size, 0) + times * len(where)
        begin += times
    return slots


def _located(slots):
    firsts = {size: np.array([s[0] for s in rows]) for size, rows in slots.items()}

    def work(batches):
        for batch in batches:
            sequence, offset = [], []
            for size, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                first, begin, each, where = slots[size][int(np.searchsorted(firsts[size], rank, side="right")) - 1]
                sequence.append(begin + (rank - first) // each)
                offset.append(where[(rank - first) % each])
            keep = [n for n in batch.schema.names if n != "rank"]
            out = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*keep, "sequence_id", "offset"])
    return work


def pack_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                   end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``: a row for each piece.
    With ``with_ids`` the token ids as little-endian unsigned 32-bit numbers."""
    prepare(df.sparkSession)
    docs, _, _, names = corpus(df, id_col, text_col)
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    pieces = stored(docs.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), kind), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns, _, _ = bin_completion(counts, capacity)
    # Rank within a length: within a bucket by id, after the pieces of the buckets before.
    buckets = max(1, -(-max(counts.values(), default=1) // BUCKET_PIECES))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = (pieces.withColumn("own", own).join(before, ["length", "bucket"])
              .withColumn("rank", (F.col("own") + F.col("before")).cast("long")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    placed = ranked.select(*columns, "rank").mapInArrow(_located(_place(patterns)), kind + ", sequence_id long, offset long")
    return named(placed, names)
