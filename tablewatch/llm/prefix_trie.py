"""Prefix tree of conversations, built as double-array tries over shards of sorted turn sequences.

*Sequences.* A turn is the 16-byte digest of its role and text; a conversation is the digests of its
turns in order, one after the other in a binary value. Texts stay behind, only their lengths go on.

*Shards.* Conversations are dealt by ranges of their sequences (ties by conv_id), so a shard holds
neighbours in prefix order and a common start, or a whole conversation that a third of all share, is
split over as many shards as it fills. Sequences that are a prefix come before those they begin.

*Trie.* In a shard the distinct turns get dense numbers, breadth first, so siblings are close. Level by
level each node's children are placed: BASE of the node plus the turn's number is the child's cell, CHECK
of the cell is the node. Families of one fill the holes left between larger ones. All conversations walk
a level at once, and the nodes' counts and sums are gathered from the deepest level upwards.

*Merging.* Only nodes on the border paths, which the neighbouring shard continues (known from the
longest common prefix of the border sequences), are in several shards. Their sums add up: a node counts as
its parent's child, and its own bytes are taken off once, in the first shard that has it; it is a
leaf if it has no children in the last shard that has it. The conversations that end at such a node come
in ascending order shard by shard and are hashed as a stream, in bounded memory.

Defined results: a null role or text is empty, a null turn comes first, turns that tie follow by digest,
repeated rows are turns of their own; rows without a conv_id belong to no conversation; an empty table
gives an empty table; other columns are ignored. A conversation's digests (16 bytes a turn) must fit a task."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.windows import with_prev_value
from tablewatch.llm.bytetext import runs_of
from tablewatch.llm.common import prepare, stored

TURNS = 100_000    # of a shard, about
DIGEST = 16
BORDERS = 1000     # shards whose borders are compared in one task
NONE = hashlib.sha256(b"").hexdigest()

PART = ("shard int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, ends string, slot int, parent_slot int, key binary, parent_key binary")
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
COLUMNS = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as structs (turn, digest, bytes)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
                     F.octet_length(text).cast("long").alias("bytes")).filter("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "bytes"))).alias("turns"))


def rebuilt(convs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by the first h of conversation ``c - c % family``
    (all if that has fewer, none if there is none), ``h = crc32(c) % most``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    of = F.col("conv_id") - F.col("conv_id") % family
    heads = convs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, most - 1).alias("head"))
    both = convs.withColumn("of", of).join(heads, "of", "left")
    shared = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return both.select("conv_id", F.concat(shared, own).alias("turns"))


class DoubleArray:
    """BASE and CHECK over dense labels; the root is cell 0."""

    def __init__(self):
        self.base, self.check = np.zeros(16, np.int64), np.full(16, -1, np.int64)
        self.check[0] = 0
        self.end, self.holes = 1, np.zeros(0, np.int64)

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def add(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Cells of new children; those of one parent are neighbours, their labels differ."""
        cells = np.empty(len(parents), np.int64)
        starts, counts = runs_of(parents)
        many = counts > 1
        for s, c in zip(starts[many].tolist(), counts[many].tolist()):
            own = labels[s:s + c]
            low, width = int(own.min()), int(own.max() - own.min()) + 1
            self._reach(self.end + width)
            cells[s:s + c] = own - low + self.end
            free = np.ones(width, bool)
            free[own - low] = False
            self.holes = np.concatenate((self.holes, np.flatnonzero(free) + self.end))
            self.base[parents[s]] = self.end - low
            self.end += width
        alone = starts[~many]
        taken, self.holes = self.holes[:len(alone)], self.holes[len(alone):]
        fresh = len(alone) - len(taken)
        self._reach(self.end + fresh)
        cells[alone] = np.concatenate((taken, np.arange(self.end, self.end + fresh)))
        self.end += fresh
        self.base[parents[alone]] = cells[alone] - labels[alone]
        self.check[cells] = parents
        return cells

    def walk(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of ``states`` by ``labels``."""
        cells = self.base[states] + labels
        if not (self.check[cells] == states).all():
            raise ValueError("a turn leads nowhere")
        return cells


def dense(digests: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Numbers of 16-byte values (rows of two longs) in the order in which levels meet them."""
    order = np.lexsort((depth, digests[:, 1], digests[:, 0]))
    same = digests[order]
    new = np.concatenate(([True], (same[1:] != same[:-1]).any(axis=1))) if len(same) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    heads = order[new]  # the least deep occurrence of each
    rank = np.empty(len(heads), np.int64)
    rank[np.lexsort((heads, depth[heads]))] = np.arange(len(heads))
    return rank[group]


def build(conv: np.ndarray, paths: list[bytes], sizes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The nodes of each level of the trie of sorted ``paths``: first member, members, parent (its place in
    the level above), smallest conv_id, members that end there, bytes of the last turn."""
    lens = np.array([len(p) // DIGEST for p in paths], np.int64)
    first = np.concatenate(([0], np.cumsum(lens)))
    depth = np.arange(first[-1]) - np.repeat(first[:-1], lens)
    label = dense(np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2), depth)
    trie, state = DoubleArray(), np.zeros(len(conv), np.int64)
    levels = [{"at": np.array([0]), "n": np.array([len(conv)]), "parent": np.array([-1]), "conv": np.array([conv.min()]),
               "ends": np.array([(lens == 0).sum()]), "bytes": np.array([0])}]
    place = np.zeros(len(conv), np.int64)  # of each conversation's node in the last level
    for d in range(int(lens.max(initial=0))):
        on = np.flatnonzero(lens > d)
        s, c = state[on], label[first[on] + d]
        starts = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (c[1:] != c[:-1]))))
        trie.add(s[starts], c[starts])
        state[on] = trie.walk(s, c)
        n = np.diff(np.append(starts, len(on)))
        levels.append({"at": on[starts], "n": n, "parent": place[on[starts]], "conv": np.minimum.reduceat(conv[on], starts),
                       "ends": np.add.reduceat((lens[on] == d + 1).astype(np.int64), starts), "bytes": sizes[first[on[starts]] + d]})
        place[on] = np.repeat(np.arange(len(starts)), n)
    return levels


def _nodes(table: pa.Table) -> pa.Table:
    """Rows of a shard's nodes; those that a neighbouring shard continues have a key and parts only."""
    paths, conv = table.column("path").to_pylist(), np.asarray(table.column("conv_id").combine_chunks())
    order = sorted(range(len(paths)), key=lambda i: (paths[i], conv[i]))
    sizes = [table.column("bytes")[i].as_py() for i in order]
    paths, conv = [paths[i] for i in order], conv[order]
    left, right = (table.column(c)[0].as_py() for c in ("left", "right"))
    levels = build(conv, paths, np.array([x for s in sizes for x in s], np.int64))
    total = len(conv)
    below = None
    for d in range(len(levels) - 1, -1, -1):
        x = levels[d]
        begun = (x["at"] == 0) & (d <= left)  # in the shard before, too
        goes_on = (x["at"] + x["n"] == total) & (d <= right)
        x["open"], x["new"] = begun | goes_on, ~begun
        x["saved"] = (x["n"] - x["new"]) * x["bytes"]
        x["children"] = np.zeros(len(x["n"]), np.int64)
        x["leaves"] = np.zeros(len(x["n"]), np.int64)
        local = np.zeros(len(x["n"]), np.int64)
        if below is not None:
            for name, value in (("children", below["new"]), ("leaves", below["leaves"]), ("saved", below["saved"])):
                np.add.at(x[name], below["parent"], value.astype(np.int64))
            np.add.at(local, below["parent"], 1)
        x["leaves"] += (local == 0) & ~goes_on
        below = x
    keys = {end: _keys(paths[end]) for end in (0, total - 1)}
    cols: dict[str, list] = {name.split()[0]: [] for name in PART.split(", ")}
    shard = table.column("shard")[0].as_py()
    for d, x in enumerate(levels):
        up = levels[d - 1] if d else None
        for i, at, n, parent, is_open, ends in zip(range(len(x["n"])), *(x[c].tolist() for c in ("at", "n", "parent", "open", "ends"))):
            names = ",".join(map(str, conv[at:at + ends].tolist()))  # those that end come first, by conv_id
            path = keys[0 if at == 0 else total - 1] if is_open else None
            row = (shard, d, int(x["conv"][i]), int(up["conv"][parent]) if d else None, n, int(x["children"][i]), int(x["leaves"][i]), int(x["saved"][i]),
                   None if is_open else hashlib.sha256(names.encode()).hexdigest() if ends else NONE, names if is_open and ends else None,
                   (2 * d + (at > 0)) if is_open else None, 2 * (d - 1) + (int(up["at"][parent]) > 0) if d and up["open"][parent] else None,
                   path[d] if is_open else None, path[d - 1] if is_open and d else None)
            for col, value in zip(cols.values(), row):
                col.append(value)
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.table({k: pa.array(v, kinds[t]) for (k, v), t in zip(cols.items(), (x.split()[1] for x in PART.split(", ")))})


def _keys(path: bytes) -> list[bytes]:
    """A digest of every prefix of a sequence, by depth."""
    h, out = hashlib.blake2b(digest_size=16), []
    for at in range(0, len(path) + 1, DIGEST):
        out.append(h.digest())
        h.update(path[at:at + DIGEST])
    return out


def _common(batches):
    """Turns that the border sequences of a shard share with those beside them; -1: there is none beside."""
    def shared(a, b):
        if a is None or b is None:
            return -1
        n = min(len(a), len(b)) // DIGEST
        x, y = (np.frombuffer(p, np.uint64, 2 * n).reshape(-1, 2) for p in (a, b))
        differ = np.flatnonzero((x != y).any(axis=1))
        return int(differ[0]) if len(differ) else n

    for batch in batches:
        low, high, before, after = (batch.column(c).to_pylist() for c in ("low", "high", "before", "after"))
        yield pa.RecordBatch.from_pydict({
            "shard": batch.column("shard"), "left": pa.array(map(shared, low, before), pa.int32()),
            "right": pa.array(map(shared, high, after), pa.int32())})


def _hashed(batches):
    """SHA-256 of each key's ends, comma-joined, over rows in the order of keys and shards."""
    key, h = None, None
    done: list[tuple[bytes, str]] = []

    def rows():
        return pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in done], pa.binary()), "ends_sha256": pa.array([s for _, s in done], pa.string())})

    for batch in batches:
        done.clear()
        for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if h is not None:
                    done.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256(ends.encode())
            else:
                h.update(b"," + ends.encode())
        yield rows()
    if h is not None:
        done[:] = [(key, h.hexdigest())]
        yield rows()


def prefix_tree(convs: DataFrame, turns: int = TURNS) -> DataFrame:
    """A row for each distinct start of the conversations ``(conv_id, turns)``, the root included: smallest
    member, depth, smallest member of the parent, members, children, leaves below, bytes saved by storing
    each start once, SHA-256 of the members that end there."""
    spark = convs.sparkSession
    prepare(spark)
    rows = stored(convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
                               F.transform("turns", lambda t: t["bytes"]).alias("bytes")), "sequences")
    total = rows.agg(F.sum(F.size("bytes") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if total > turns else 1, -(-int(total) // turns))
    rows = stored(rows.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id()), "ranges")

    borders = rows.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")).withColumn("back", -F.col("shard"))
    block = F.floor(F.col("shard") / BORDERS)
    borders = with_prev_value(borders, [], "shard", "high", block, "before")
    borders = with_prev_value(borders, [], "back", "low", -block, "after")
    edges = borders.select("shard", "low", "high", "before", "after").mapInArrow(_common, "shard int, left int, right int")
    parts = stored(rows.join(edges, "shard").groupBy("shard").applyInArrow(_nodes, PART), "nodes")

    border, whole = parts.filter("key is not null"), parts.filter("key is null")
    merged = border.groupBy("key").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_key").alias("parent_key"),
                                       *(F.sum(c).alias(c) for c in SUMS))
    ends = (border.filter("ends is not null").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
            .mapInArrow(_hashed, "key binary, ends_sha256 string"))
    merged = stored(merged.join(ends, "key", "left").fillna({"ends_sha256": NONE}), "merged")
    top = merged.join(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key", "left")
    slots = border.join(merged.select("key", F.col("conv_id").alias("of")), "key").select("shard", F.col("slot").alias("parent_slot"), "of")
    rest = whole.join(slots, ["shard", "parent_slot"], "left").withColumn("parent_conv_id", F.coalesce("of", "parent_conv_id"))
    return top.select(*COLUMNS).union(rest.select(*COLUMNS))
