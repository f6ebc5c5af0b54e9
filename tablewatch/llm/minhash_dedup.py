"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct ``words``-word shingles, hashed once. Its sketch is the ``k``
smallest hashes. Documents with equal sets form a class, and only class representatives go on.

*Quick pass.* Lists whose keys are runs of three retained values that are neighbours in a sketch (pairs
too, for sets of up to five); keys that occur once are dropped in the compact exchange. Lists of up to
``NEIGHBOURS`` and one are paired in full. In a longer list, ordered by the values that follow the run, each
member is paired with the next ``NEXT`` and with the ``PIVOTS`` members of which most runs occur elsewhere.
Each document's candidate of the most lists is estimated and verified; what holds gives the first
components. This pass only makes few large components early: no link depends on it.

*Exact pass.* Candidates are all pairs of documents of different components whose sketches allow the
similarity (below), none left out. Two such sketches have ``LEAST`` values in common at least (complete
ones four fifths of each), so of their values in one order for all, rarest first, the first
``64 - LEAST + 1`` of both have one in common. These are the keys of a second set of inverted lists; a passage
or word that many share comes last in the order, and has a list of those only that consist of little else.
The order is by a table of fixed size of how often values occur. A list of one component is settled; in any
other, of whatever length, every member outside its largest component is compared with all its members,
block by block, on the retained values, and what passes leaves the task. Where more pairs of a block pass than it
has members, a forest of them leaves instead, by which all their components are put in one region, and a region is
compared in full.

*Union-sketch filter.* The bottom-k of the union of two sketches estimates the similarity; pairs
below 0.55 (five standard deviations under 0.8) are dropped, complete sketches decide exactly.

*Verification* on full sets. Candidates estimated at 0.65 or more (three standard deviations under 0.8) join
components to regions. In each region every document outside its largest component is compared with all
others on full sets, block by block, and only links between components leave a task. Last, candidate pairs
between regions. A large group of near copies is one component but for few outliers; the work grows
with outliers times members.

Defined results: a null or empty text has no shingles and links with nothing; texts of fewer than
``words`` words have their whole sequence as one shingle; rows equal in id and text are one document,
rows that share an id only are several (see ``corpus``), of which one is kept if they are near copies; null
counts as the largest id; an empty table gives an empty table."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm import bytetext as bt
from tablewatch.llm import exchange as ex
from tablewatch.llm.bytetext import U
from tablewatch.llm.common import components, corpus, named, prepare, stored

K = 64
RUN = 3
NEIGHBOURS = 4           # lists of up to one more are paired in full
NEXT = 1                 # neighbours in longer lists
PIVOTS = 2
FOLLOW = 4               # values after a run that order its list
ESTIMATE = 0.55
REGION = 0.65
BLOCK = 128              # documents of one side of a comparison
LEAST = 36               # values that two sketches of 0.55 have in common: 0.55 * K, rounded up
TABLE = 1 << 20          # places of the table of frequencies
CHUNK = 4096             # of them in one row
LISTED = 1024            # entries of one side of a comparison in a list
COLUMNS = 4096           # shingles compared at a time


def shingle_sets(batch: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of ``text``."""
    data, offsets = bt.utf8(batch.column("text"))
    starts, ends, row = bt.words(data, offsets, bt.SPACED)
    hashes = bt.word_hashes(data, starts, ends, bt.FOLDED)
    first = bt.first_of(row, batch.num_rows).tolist()
    long = bt.rolling(hashes, words)
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= words:
            h = np.sort(long[lo:hi - words + 1])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
        else:  # of its own length, so no longer shingle equals it
            out.append(bt.rolling(hashes[lo:hi], hi - lo)[:1] + U(hi - lo) if hi > lo else hashes[:0])
    return out


def _sketches(words: int):
    def work(batches):
        for batch in batches:
            sets = shingle_sets(batch, words)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                                    for s in sets], pa.binary()),
                "sketch": pa.array([s[:K].tobytes() for s in sets], pa.binary())})
    return work


def _run_keys(sketch: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Key hashes of all runs: (run length, hashes by first place)."""
    lengths = [2, RUN] if n <= 5 else [RUN]
    return [(r, bt.rolling(sketch, r) + U(r)) for r in lengths if len(sketch) >= r]


def _extract_runs(batch: pa.RecordBatch):
    ids, ns = np.asarray(batch.column("doc_id")), np.asarray(batch.column("n"))
    doc, pos, key = [], [], []
    for i, (raw, n) in enumerate(zip(batch.column("sketch").to_pylist(), ns.tolist())):
        at = 0
        for _, keys in _run_keys(np.frombuffer(raw, U), n):
            key.append(keys)
            pos.append(np.arange(at, at + len(keys), dtype=np.int32))
            doc.append(np.full(len(keys), ids[i], np.int64))
            at += len(keys)
    if not doc:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.int32), none.astype(U), none.astype(np.uint8)
    key = np.concatenate(key)
    return np.concatenate(doc), np.concatenate(pos), key, np.full(len(key), ex.INDEX, np.uint8)


def _listed(batches):
    """A list entry for every run of a sketch that occurs elsewhere: (key, following values, id, size,
    number of such runs)."""
    for batch in batches:
        keys, rest, ids, ns, shared = [], [], [], [], []
        for doc, n, raw, blobs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "sketch", "hits"))):
            sketch = np.frombuffer(raw, U)
            high = (sketch >> U(32)).astype(">u4").tobytes()
            places = [(int(k), i + r) for r, ks in _run_keys(sketch, n) for i, k in enumerate(ks)]
            places_hit = np.frombuffer(b"".join(blobs), "<i4").tolist()
            for p in places_hit:
                k, follow = places[p]
                keys.append(k - (1 << 64) if k >> 63 else k)
                rest.append(high[4 * follow:4 * (follow + FOLLOW)])
                ids.append(doc)
                ns.append(n)
                shared.append(len(places_hit))
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "rest": pa.array(rest, pa.binary()), "id": pa.array(ids, pa.int64()),
                                          "n": pa.array(ns, pa.int64()), "shared": pa.array(shared, pa.int32())})


def _possible(ids, ns, a, b):
    """Pairs of entries of different documents whose sizes allow a similarity of 0.8."""
    ok = (ids[a] != ids[b]) & (5 * np.minimum(ns[a], ns[b]) >= 4 * np.maximum(ns[a], ns[b]))
    a, b = ids[a][ok], ids[b][ok]
    return np.minimum(a, b), np.maximum(a, b)


def _pairs_of(keys, ids, ns, shared=None):
    """Each entry with its next neighbours in its list and, in long lists, with the pivots. Without
    ``shared``, all pairs up to ``NEIGHBOURS`` apart. ``keys`` are sorted."""
    got = []
    size = bt.runs_of(keys)[1]
    short = np.repeat(size <= NEIGHBOURS + 1, size) if shared is not None else np.ones(len(keys), bool)
    for gap in range(1, NEIGHBOURS + 1):
        a = np.flatnonzero(keys[gap:] == keys[:-gap]) if len(keys) > gap else np.zeros(0, np.int64)
        a = a if gap <= NEXT else a[short[a]]
        got.append(_possible(ids, ns, a, a + gap))
    if shared is not None:
        order = np.lexsort((ids, -shared, keys))
        starts, counts = bt.runs_of(keys[order])
        long = np.repeat(counts > NEIGHBOURS + 1, counts)
        first = np.repeat(starts, counts)
        for p in range(PIVOTS):
            got.append(_possible(ids, ns, order[long], order[first[long] + p]))
    pairs, times = np.unique(np.stack([np.concatenate(x) for x in zip(*got)], axis=1), axis=0, return_counts=True)
    return np.column_stack((pairs, times))


def _adjacent(batches):
    """Pairs of neighbours in a sorted partition, and the rows at its two ends for those across."""
    carry, head, seen = None, None, 0
    for batch in batches:
        cols = [np.asarray(batch.column(c)) for c in ("key", "id", "n", "shared")] + [np.array(batch.column("rest").to_pylist(), object)]
        if head is None or len(head[0]) < NEIGHBOURS:
            head = [np.concatenate((h, c[:NEIGHBOURS - len(h)])) for h, c in zip(head, cols)] if head else [c[:NEIGHBOURS] for c in cols]
        seen += len(cols[0])
        joined = [np.concatenate((c, x)) for c, x in zip(carry, cols)] if carry else cols
        pairs = _pairs_of(*joined[:4])
        yield _pair_batch(pairs)
        carry = [c[-NEIGHBOURS:] for c in joined]
    if carry:
        tail = [c[max(0, len(c) - max(0, seen - len(head[0]))):] for c in carry]  # no row at both ends
        ends = [np.concatenate((h, t)) for h, t in zip(head, tail)]
        yield pa.RecordBatch.from_pydict({
            "a": pa.array(ends[1], pa.int64()), "b": pa.array([None] * len(ends[0]), pa.int64()), "m": pa.array([None] * len(ends[0]), pa.int64()),
            "key": pa.array(ends[0], pa.int64()), "n": pa.array(ends[2], pa.int64()), "rest": pa.array(list(ends[4]), pa.binary())})


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(pairs), pa.int64())
    return pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64()),
                                       "m": pa.array(pairs[:, 2], pa.int64()), "key": none, "n": none, "rest": pa.nulls(len(pairs), pa.binary())})


def _across(table: pa.Table) -> pa.Table:
    """Pairs among the end rows of one list: a few rows for each task that it was split over."""
    t = table.sort_by([("rest", "ascending"), ("a", "ascending")])
    keys, ids, ns = (np.asarray(t.column(c).combine_chunks()) for c in ("key", "a", "n"))
    return pa.Table.from_batches([_pair_batch(_pairs_of(keys, ids, ns)).select(["a", "b", "m"])])


def _estimated(percent: int):
    def work(batches):
        for batch in batches:
            keep, est = [], []
            for i, (x, y, n, m) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("sa", "sb", "na", "nb")))):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = np.sort(np.concatenate((x, y)))
                twice = both[1:] == both[:-1]
                whole = n <= K and m <= K
                if whole:
                    common, union = int(twice.sum()), len(both) - int(twice.sum())
                    ok, e = 100 * common >= percent * union, common / union
                else:
                    distinct = np.concatenate(([True], ~twice))
                    last = np.flatnonzero(distinct)[:K][-1]
                    e = int(twice[:last + 1].sum()) / K
                    ok = e >= ESTIMATE * percent / 80
                if ok:
                    keep.append(i)
                    est.append(e)
            names = [c for c in batch.schema.names if c not in ("sa", "sb", "na", "nb")]
            out = batch.select(names).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(est, pa.float64())], names=[*names, "est"])
    return work


def _similar(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """``pairs`` that their sketches allow, with the estimate."""
    return (pairs.join(sketch.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
            .join(sketch.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
            .select(*pairs.columns, "sa", "sb", "na", "nb")
            .mapInArrow(_estimated(percent), ", ".join(f"{c} long" for c in pairs.columns) + ", est double"))


def _sets(words: int):
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("doc_id"),
                "shingles": pa.array([s.tobytes() for s in shingle_sets(batch, words)], pa.binary())})
    return work


def _verified(percent: int):
    def work(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist())):
                both = np.sort(np.concatenate((np.frombuffer(x, U), np.frombuffer(y, U))))
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
    return work


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(_verified(percent), "a long, b long")


def _region_links(percent: int):
    """Links between components among the blocks of a region: one for each outlier and component."""
    def work(batches):
        for batch in batches:
            found = []
            for members, outliers in zip(batch.column("members").to_pylist(), batch.column("outliers").to_pylist()):
                rows = members + outliers
                sets = [np.frombuffer(r["shingles"], U) for r in rows]
                size = np.array([len(s) for s in sets])
                own = np.repeat(np.arange(len(rows)), size)
                _, column = np.unique(np.concatenate(sets), return_inverse=True)
                cut = len(members)
                both = np.intersect1d(np.unique(column[own < cut]), np.unique(column[own >= cut]))
                common = np.zeros((len(outliers), cut), np.float32)
                for lo in range(0, len(both), COLUMNS):
                    part = both[lo:lo + COLUMNS]
                    at = np.minimum(np.searchsorted(part, column), len(part) - 1)
                    hit = part[at] == column
                    table = np.zeros((len(rows), len(part)), np.float32)
                    table[own[hit], at[hit]] = 1
                    common += table[cut:] @ table[:cut].T
                union = size[cut:, None] + size[None, :cut] - common
                comp = np.array([r["ca"] for r in rows])
                linked = (100 * common >= percent * union) & (comp[cut:, None] != comp[None, :cut])
                i, j = np.nonzero(linked)
                _, one = np.unique(np.stack((i, comp[:cut][j]), axis=1), axis=0, return_index=True)
                found += [(outliers[i[k]]["id"], members[j[k]]["id"]) for k in one.tolist()]
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})
    return work


def _closed(regions: DataFrame, so_far: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of each region (component, region)."""
    placed = so_far.select("id", F.col("component_id").alias("ca")).join(regions.select(F.col("id").alias("ca"), "region"), "ca")
    rows = placed.join(_mains(placed, "region", BLOCK), "region").join(sets, "id").select(
        "region", "main", "bm", "bo", F.struct("id", "ca", "shingles").alias("row"))
    return _blocks(rows, "region").mapInArrow(_region_links(percent), "a long, b long")


def _frequencies(batches):
    """How often the values of each place of the table occur in this task."""
    counts = np.zeros(TABLE, np.int64)
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), U)
        counts += np.bincount((values % U(TABLE)).astype(np.int64), minlength=TABLE)
    rows = [i for i, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(rows, pa.int32()),
                                      "counts": pa.array([ex.planes(counts[i * CHUNK:(i + 1) * CHUNK]) for i in rows], pa.binary())})


def _classes(table: pa.Table) -> pa.Table:
    """A byte for each place of a chunk: its frequency in steps of a fourth of a power of two."""
    total = sum(ex.unplanes(memoryview(b), 0, CHUNK, np.int64)[0] for b in table.column("counts").to_pylist())
    return pa.table({"chunk": table.column("chunk").slice(0, 1),
                     "classes": pa.array([np.floor(4 * np.log2(total + 1)).astype(np.uint8).tobytes()], pa.binary())})


def _order(reps: DataFrame) -> bytes:
    """The table of frequencies: ``TABLE`` bytes, however many documents there are."""
    table = bytearray(TABLE)
    for chunk, classes in reps.select("sketch").mapInArrow(_frequencies, "chunk int, counts binary").groupBy("chunk").applyInArrow(
            _classes, "chunk int, classes binary").collect():
        table[chunk * CHUNK:(chunk + 1) * CHUNK] = classes
    return bytes(table)


def _prefix(ns: np.ndarray) -> np.ndarray:
    """How many of its rarest values a sketch of a set of that size needs to share one with each similar one. A set of up
    to 51 has complete sketches as partners only, of which four fifths are common; others share ``LEAST``."""
    return np.where(5 * ns > 4 * K, np.minimum(ns, K) - LEAST + 1, ns - (4 * ns + 4) // 5 + 1)


def _extract_rarest(order: bytes):
    def extract(batch: pa.RecordBatch):
        ids, ns = np.asarray(batch.column("doc_id")), np.asarray(batch.column("n"))
        values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), U)
        own = np.repeat(np.arange(len(ids)), np.minimum(ns, K))
        first = bt.first_of(own, len(ids))
        rank = np.frombuffer(order, np.uint8)[(values % U(TABLE)).astype(np.int64)]
        by = np.lexsort((values, rank, own))
        keep = np.sort(by[np.arange(len(by)) - first[own] < _prefix(ns)[own]])  # ``own`` is sorted, so it stays as it is
        return (ids[own[keep]].astype(np.int64), (keep - first[own[keep]]).astype(np.int32), values[keep],
                np.full(len(keep), ex.INDEX, np.uint8))
    return extract


def _entries(batches):
    """A list entry for every value of a prefix that occurs in another: (value, id, component)."""
    for batch in batches:
        keys, ids, comps = [], [], []
        for doc, comp, raw, blobs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ca", "sketch", "hits"))):
            got = np.frombuffer(raw, U)[np.frombuffer(b"".join(blobs), "<i4")].view(np.int64)
            keys.append(got)
            ids += [doc] * len(got)
            comps += [comp] * len(got)
        yield pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(keys) if keys else [], pa.int64()),
                                          "id": pa.array(ids, pa.int64()), "ca": pa.array(comps, pa.int64())})


def _similarities(x: np.ndarray, n: int, table: np.ndarray, valid: np.ndarray, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of one sketch with each row of a table, and whether both are complete. The values' high halves
    are compared, which never makes an estimate smaller."""
    at = np.searchsorted(x, table)
    hit = valid & (x[np.minimum(at, len(x) - 1)] == table)
    so_far = np.cumsum(hit, axis=1)
    common = so_far[:, -1]
    among = (hit & (at + np.arange(2, table.shape[1] + 2) - so_far <= K)).sum(axis=1)
    whole = (ns <= K) & (n <= K)
    return np.where(whole, common / (n + ns - common), among / K), whole


def _in_common(x: np.ndarray, values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many values of each of ``n`` rows are in ``x``, of all their ``values``, sorted, with the row of each."""
    x = np.unique(x)
    lo = np.searchsorted(values, x)
    size = np.searchsorted(values, x, "right") - lo
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.bincount(rows[at], minlength=n)


def _list_pairs(percent: int):
    """Candidates of different components among the blocks of a list, or, if they are more than the rows of the
    block, a forest of them that joins the same components (``full``)."""
    def work(batches):
        for batch in batches:
            found = []
            for members, outliers in zip(batch.column("members").to_pylist(), batch.column("outliers").to_pylist()):
                ids, comps, ns = (np.array([r[c] for r in members], np.int64) for c in ("id", "ca", "n"))
                table = np.zeros((len(members), K), "<u4")
                for i, r in enumerate(members):
                    table[i, :len(r["high"]) // 4] = np.frombuffer(r["high"], "<u4")
                valid = np.arange(K) < np.minimum(ns, K)[:, None]
                values, rows = table[valid], np.nonzero(valid)[0]
                by = np.argsort(values, kind="stable")
                values, rows = values[by], rows[by]
                known, part = np.unique(np.concatenate((comps, [r["ca"] for r in outliers])), return_inverse=True)
                joined = np.arange(len(known))  # the tree of each component
                pairs, forest, most = [], [], len(members) + len(outliers)
                for o, r in enumerate(outliers):
                    n = r["n"]
                    x = np.frombuffer(r["high"], "<u4")
                    common = _in_common(x, values, rows, len(members))
                    # No estimate is above what these allow, so what they rule out would not pass below.
                    enough = common >= np.where((ns <= K) & (n <= K), (percent / 100 - 1e-6) * (n + ns - common), (ESTIMATE * percent / 80 - 1e-6) * K)
                    near = np.flatnonzero(enough & (comps != r["ca"]) & (5 * np.minimum(ns, n) >= 4 * np.maximum(ns, n)))
                    est, whole = _similarities(x, n, table[near], valid[near], ns[near])
                    ok = np.where(whole, est >= percent / 100 - 1e-9, est >= ESTIMATE * percent / 80)
                    near, est = near[ok], est[ok]
                    if len(pairs) <= most:
                        pairs += [(o, m, e) for m, e in zip(near.tolist(), est.tolist())]
                    own = joined[part[len(members) + o]]
                    trees, one = np.unique(joined[part[near]], return_index=True)
                    new = trees != own
                    if new.any():
                        forest += [(o, m, e) for m, e in zip(near[one[new]].tolist(), est[one[new]].tolist())]
                        joined[np.isin(joined, trees[new])] = own
                full = len(pairs) > most
                for o, m, e in forest if full else pairs:
                    x, y = (outliers[o]["id"], outliers[o]["ca"]), (members[m]["id"], members[m]["ca"])
                    found.append((*min(x, y), *max(x, y), e, full))
            names = {"a": pa.int64(), "ca": pa.int64(), "b": pa.int64(), "cb": pa.int64(), "est": pa.float64(), "full": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(names.values())], names=list(names))
    return work


def _mains(placed: DataFrame, by: str, block: int) -> DataFrame:
    """The groups of several components: their largest, and the blocks of their members and of those outside it."""
    parts = placed.groupBy(by, "ca").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy(by).agg(F.max(F.struct("n", "ca")).alias("m"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts"))
    return main.filter("parts > 1").select(by, F.col("m.ca").alias("main"), F.ceil(F.col("all") / block).cast("int").alias("bm"),
                                           F.ceil((F.col("all") - F.col("m.n")) / block).cast("int").alias("bo"))


def _blocks(rows: DataFrame, by: str) -> DataFrame:
    """Each block of the ``members`` of a group beside each of its ``outliers``, of ``rows (by, main, bm, bo, row)``."""
    block = F.pmod(F.xxhash64("row.id"), F.col("bm")).cast("int")
    members = rows.select(by, block.alias("i"), F.explode(F.sequence(F.lit(0), F.col("bo") - 1)).alias("j"), "row")
    block = F.pmod(F.xxhash64("row.id"), F.col("bo")).cast("int")
    outliers = rows.filter("row.ca <> main").select(by, F.explode(F.sequence(F.lit(0), F.col("bm") - 1)).alias("i"), block.alias("j"), "row")
    both = (members.withColumn("out", F.lit(False)).unionByName(outliers.withColumn("out", F.lit(True))).groupBy(by, "i", "j")
            .agg(F.collect_list(F.when(~F.col("out"), F.col("row"))).alias("members"), F.collect_list(F.when(F.col("out"), F.col("row"))).alias("outliers")))
    return both.filter("size(members) > 0 and size(outliers) > 0")


def _high(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(
            [(np.frombuffer(s, U) >> U(32)).astype("<u4").tobytes() for s in batch.column("sketch").to_pylist()], pa.binary())], names=["id", "n", "high"])


def _between(reps: DataFrame, so_far: DataFrame, n_keys: int, percent: int) -> DataFrame:
    """All candidates of different components: ``(a, b, ca, cb, est, full)``; ``full`` if they stand for more."""
    hits = ex.per_document(ex.repeated(reps, _extract_rarest(_order(reps)), n_keys, 8)).select("doc_id", "hits")
    placed = so_far.select(F.col("id").alias("doc_id"), F.col("component_id").alias("ca"))
    entries = stored(reps.join(hits, "doc_id").join(placed, "doc_id").select("doc_id", "ca", "sketch", "hits")
                     .mapInArrow(_entries, "key long, id long, ca long"), "entries")
    high = reps.select(F.col("doc_id").alias("id"), "n", "sketch").mapInArrow(_high, "id long, n long, high binary")
    rows = entries.join(_mains(entries, "key", LISTED), "key").join(high, "id").select(
        "key", "main", "bm", "bo", F.struct("id", "ca", "n", "high").alias("row"))
    return (_blocks(rows, "key").mapInArrow(_list_pairs(percent), "a long, ca long, b long, cb long, est double, full boolean")
            .groupBy("a", "b", "ca", "cb").agg(F.max("est").alias("est"), F.max("full").alias("full")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b"))


def _joined(so_far: DataFrame, links: DataFrame) -> DataFrame:
    """``so_far (id, component_id)`` after further links: only the components they join are walked again."""
    side = so_far.select("id", F.col("component_id").alias("c"))
    edges = stored(links.join(side.select(F.col("id").alias("a"), F.col("c").alias("ca")), "a")
                   .join(side.select(F.col("id").alias("b"), F.col("c").alias("cb")), "b")
                   .filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "joins")
    ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    roots = components(ends, edges).select(F.col("id").alias("c"), F.col("component_id").alias("root"))
    return side.join(roots, "c", "left").select("id", F.coalesce("root", "c").alias("component_id"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: the smallest id reachable over pairs of documents whose
    ``words``-word shingle sets have ``100 * |intersection| >= percent * |union|`` (80 or more)."""
    if percent < 80:
        raise ValueError("the lists are complete from a similarity of 0.8")
    prepare(df.sparkSession)
    docs, _, _, names = corpus(df, id_col, text_col)
    sketches = stored(docs.mapInArrow(_sketches(words), "doc_id long, n long, digest binary, sketch binary"), "sketches")
    keyed = sketches.filter("digest is not null and doc_id is not null")
    reps = stored(keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    n_keys = int(reps.agg(F.sum(F.least("n", F.lit(K)))).first()[0] or 0)

    hits = ex.per_document(ex.repeated(reps, _extract_runs, n_keys, 8))
    lists = stored(reps.join(hits.select("doc_id", "hits"), "doc_id").select("doc_id", "n", "sketch", "hits")
                   .mapInArrow(_listed, "key long, rest binary, id long, n long, shared int"), "lists")
    near = stored(lists.repartitionByRange("key", "rest", "id").sortWithinPartitions("key", "rest", "id")
                  .mapInArrow(_adjacent, "a long, b long, m long, key long, n long, rest binary"), "neighbours")
    across = near.filter("b is null").groupBy("key").applyInArrow(_across, "a long, b long, m long")
    pairs = stored(near.filter("b is not null").select("a", "b", "m").union(across).groupBy("a", "b").agg(F.sum("m").alias("m")), "pairs")

    # First each document's candidate of the most lists: one pair a document, and components of those that hold.
    sketch = reps.select(F.col("doc_id").alias("id"), "n", "sketch")
    either = pairs.union(pairs.select(F.col("b"), F.col("a"), "m"))
    best = either.groupBy("a").agg(F.max(F.struct("m", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = stored(_similar(best, sketch, percent), "first")
    ends = _ends(first)
    # Merged at every size: these ids grow with the corpus, so they are never broadcast.
    sets = stored(docs.join(ends.hint("merge"), docs.doc_id == ends.id, "left_semi").mapInArrow(_sets(words), "id long, shingles binary"), "sets")
    links = stored(_confirm(first, sets, percent), "links")
    so_far = stored(components(sketch, links), "joined")

    # Candidates within a component are settled. All others come from the exact pass, and contract to one edge for each
    # pair of components, so a large group of near copies, whose members have many candidates each, is one node from here on.
    between = stored(_between(reps, so_far, n_keys, percent), "between")
    late = stored(_ends(between).distinct().join(ends, "id", "left_anti"), "late")  # their first candidate was none
    sets = sets.union(stored(docs.join(late, docs.doc_id == late.id, "left_semi").mapInArrow(_sets(words), "id long, shingles binary"), "sets"))
    near = between.filter(F.col("full") | (F.col("est") >= REGION * percent / 80)).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    regions = stored(components(between.select(F.col("ca").alias("id")).union(between.select("cb")).distinct(), near).select("id", F.col("component_id").alias("region")), "regions")
    closed = stored(_closed(regions, so_far, sets, percent), "links")
    open_pairs = (between.join(regions.select(F.col("id").alias("ca"), F.col("region").alias("ra")), "ca")
                  .join(regions.select(F.col("id").alias("cb"), F.col("region").alias("rb")), "cb").filter("ra <> rb"))
    more = stored(_confirm(open_pairs, sets, percent), "links")
    final = _joined(so_far, closed.union(more))

    classes = keyed.select("doc_id", "digest").join(
        reps.select("digest", F.col("doc_id").alias("rep")), "digest").select("doc_id", "rep")
    placed = (reps.select(F.col("doc_id").alias("id")).join(final, "id", "left")
              .select(F.col("id").alias("rep"), F.coalesce("component_id", "id").alias("component_id")))
    linked = classes.join(placed, "rep").select("doc_id", "component_id")
    out = sketches.select("doc_id", F.col("n").alias("n_shingles")).join(linked, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return named(out, names, "doc_id", "component_id").select("doc_id", "n_shingles", "component_id", "kept")
