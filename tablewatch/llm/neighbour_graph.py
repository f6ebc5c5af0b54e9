"""Embedding near-dedup by NN-descent.

The search works on directions rounded to one byte per component; every link is confirmed in double
precision on the given values.

0. *Copies.* Vectors of one direction become one representative with a weight.
1. *Start.* Vectors are sorted several times by the signs of random projections; neighbours in a
   sorted order are the first neighbour lists. Signs and orders grow with the number of vectors.
2. *Descent.* Each vector gathers its neighbours and some of the vectors that list it, compares all
   of these with one another and sends every one its best new neighbours: a
   neighbours-of-neighbours join. Lists keep the ``k`` most similar.
3. *Threshold edges* are confirmed, and components formed. A list that is full of such edges is
   saturated: it cannot hold all links of its vector, and no descent over full lists finds the others.
   So vectors with saturated lists are compared with all vectors outside their component, in blocks of
   close vectors whose centre and radius rule most others out; components that link are joined.
4. *Audit.* A bounded set of vectors, by a hash of their ids, is compared with all vectors. While the
   mean share found of a linked vector's links is below ``TARGET``, ``k`` doubles and the descent goes
   on; when that does not reach it, all vectors are compared as the saturated ones are.
5. *Counts.* Every component is compared block by block; a component that a third of all vectors
   belong to is spread over many block pairs, and only link counts leave a task.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are their own component; vectors of different lengths never link; rows that share a
vec_id (null is an id too) are one vector, the greatest of theirs in array order; a null id is never
linked; vectors whose unit vectors are equal link with each other; an empty table gives an empty table; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.bytetext import runs_of
from tablewatch.llm.common import components, prepare, stored

K = 10
ROUNDS = 3
ORDERS = 6             # sorted orders of the start, at SIGNS signs
SIGNS = 10             # least number of projections whose signs lead an order
PER_CODE = 16          # vectors that share all signs, on average, from which a sign is added
AGREE = 0.85           # chance that a sign is equal at a cosine of 0.9
BESIDE = 3             # neighbours taken to either side
OFFER = 5              # best neighbours sent to each vector by one join
AUDIT = 512            # vectors compared with all others
TARGET = 0.995
MORE_ROUNDS = 4
SLACK = 0.02           # what rounding may hide of a similarity
BLOCK = 512            # vectors of one block of a component
CLOSE = 64             # vectors of one block of saturated ones
SLICE = 16 << 20       # bytes of saturated vectors that are held against all others at once
SALTS = 256            # parts in which the copies of one vector are gathered
ENTRY = np.dtype([("id", "<i8"), ("sim", "<f4")])


def _valid(batches):
    """(id, dims, x, q): doubles and rounded direction of usable vectors; others have null dims."""
    for batch in batches:
        dims, xs, qs = [], [], []
        for v in batch.column("embedding").to_pylist():
            x = np.array(v, float) if v and None not in v else np.zeros(0)
            norm = np.sqrt(np.dot(x, x)) if len(x) and np.isfinite(x).all() else 0.0
            if not np.isfinite(norm) or norm == 0:  # also values whose squares leave the range
                scale = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                x = x / scale if scale else x
                norm = np.sqrt(np.dot(x, x)) if scale else 0.0
            if norm == 0:
                dims.append(None), xs.append(None), qs.append(None)
                continue
            unit = x / norm
            dims.append(len(x)), xs.append(unit.tobytes())
            qs.append(np.rint(unit * (127 / np.abs(unit).max())).astype(np.int8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(dims, pa.int32()), pa.array(xs, pa.binary()), pa.array(qs, pa.binary())],
                                         names=["id", "dims", "x", "q"])


def _directions(blobs: list[bytes], dims: int) -> np.ndarray:
    q = np.frombuffer(b"".join(blobs), np.int8).reshape(-1, dims).astype(np.float32)
    return q / np.sqrt((q * q).sum(axis=1, keepdims=True))


def _start(n: int) -> tuple[int, int]:
    """Signs and orders for ``n`` vectors: codes stay small, and close vectors meet as often at any size."""
    signs = min(max(SIGNS, int(np.ceil(np.log2(max(n, 1) / PER_CODE)))), 60)
    return signs, int(np.ceil(ORDERS * AGREE ** (SIGNS - signs)))


def _ordered(signs: int, orders: int):
    """Each vector's place in every sorted order."""
    def work(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dims"))
            ids, blobs = batch.column("id").to_pylist(), batch.column("q").to_pylist()
            for d in np.unique(dims):
                pick = np.flatnonzero(dims == d)
                x = _directions([blobs[i] for i in pick], int(d))
                for t in range(orders):
                    planes = np.random.default_rng([int(d), t]).normal(size=(int(d), signs + 1)).astype(np.float32)
                    along = x @ planes
                    code = (along[:, :signs] > 0) @ (1 << np.arange(signs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(pick), int(d) * orders + t), pa.int64()), pa.array(code, pa.int64()), pa.array(along[:, signs].astype(float)),
                         pa.array([ids[i] for i in pick], pa.int64()), pa.array([blobs[i] for i in pick], pa.binary()), pa.array(np.full(len(pick), d), pa.int32())],
                        names=["part", "code", "along", "id", "q", "dims"])
    return work


def _beside(batches):
    """Neighbours in a sorted order, as offers. Across a task's end none are made: the descent finds them."""
    for batch in batches:
        part, ids, dims = (np.asarray(batch.column(c)) for c in ("part", "id", "dims"))
        blobs = batch.column("q").to_pylist()
        for s, c in zip(*map(np.ndarray.tolist, runs_of(part))):
            x, own = _directions(blobs[s:s + c], int(dims[s])), ids[s:s + c]
            rows: dict[int, list] = {}
            for gap in range(1, min(BESIDE, c - 1) + 1):
                sim = (x[:-gap] * x[gap:]).sum(axis=1)
                for a, b, v in zip(own[:-gap].tolist(), own[gap:].tolist(), sim.tolist()):
                    rows.setdefault(a, []).append((b, v))
                    rows.setdefault(b, []).append((a, v))
            yield _offers(rows)


def _offers(rows: dict[int, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"id": pa.array(list(rows), pa.int64()),
                                       "list": pa.array([np.array(v, ENTRY).tobytes() for v in rows.values()], pa.binary())})


def _best(k: int):
    """The k most similar of all offers to a vector."""
    def work(batches):
        for batch in batches:
            out = []
            for own, lists in zip(batch.column("id").to_pylist(), batch.column("lists").to_pylist()):
                e = np.frombuffer(b"".join(lists), ENTRY)
                e = e[np.lexsort((-e["sim"], e["id"]))]
                e = e[np.concatenate(([True], e["id"][1:] != e["id"][:-1])) & (e["id"] != own)] if len(e) else e
                out.append(e[np.lexsort((e["id"], -e["sim"]))[:k]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "list"])
    return work


def _edges(least: float | None = None):
    def work(batches):
        for batch in batches:
            lists = [np.frombuffer(b, ENTRY) for b in batch.column("list").to_pylist()]
            a = np.repeat(np.asarray(batch.column("id")), [len(e) for e in lists])
            e = np.concatenate(lists) if lists else np.zeros(0, ENTRY)
            keep = e["sim"] >= least if least is not None else np.ones(len(e), bool)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a[keep], pa.int64()), "b": pa.array(e["id"][keep], pa.int64())})
    return work


def _compare(batches):
    """All vectors around one centre with one another; each is sent its best neighbours there."""
    for batch in batches:
        dims = np.asarray(batch.column("dims"))
        rows: dict[int, list] = {}
        for d, members in zip(dims.tolist(), batch.column("around").to_pylist()):
            if len(members) < 2:
                continue
            ids = np.array([m["b"] for m in members])
            x = _directions([m["q"] for m in members], d)
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            top = np.argsort(-sim, axis=1, kind="stable")[:, :OFFER]
            for i, own in enumerate(ids.tolist()):
                rows.setdefault(own, []).extend((int(ids[j]), float(sim[i, j])) for j in top[i].tolist() if ids[j] != own)
        yield _offers(rows)


def _descend(lists: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    edges = lists.mapInArrow(_edges(), "a long, b long")
    # A centre gathers its list, up to 2k of the vectors that list it (by hash), and itself.
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    turned = turned.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b")))).filter(F.col("r") <= 2 * k).drop("r")
    around = edges.union(turned).union(vectors.select(F.col("id").alias("a"), F.col("id").alias("b"))).distinct()
    met = (around.join(vectors.select(F.col("id").alias("b"), "dims", "q"), "b")
           .groupBy("a").agg(F.max("dims").alias("dims"), F.collect_list(F.struct("b", "q")).alias("around")))
    offers = met.mapInArrow(_compare, "id long, list binary").union(lists)
    return _merged(offers, k)


def _merged(offers: DataFrame, k: int) -> DataFrame:
    return stored(offers.groupBy("id").agg(F.collect_list("list").alias("lists")).mapInArrow(_best(k), "id long, list binary"), "lists")


def _exact_links(threshold: float):
    def work(batches):
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist()))
                    if len(x) == len(y) and float(np.dot(np.frombuffer(x), np.frombuffer(y))) >= threshold]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
    return work


def _links(lists: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    near = lists.mapInArrow(_edges(threshold - SLACK), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stored(near.join(vectors.select(F.col("id").alias("a"), F.col("x").alias("xa")), "a")
                  .join(vectors.select(F.col("id").alias("b"), F.col("x").alias("xb")), "b").mapInArrow(_exact_links(threshold), "a long, b long"), "edges")


def _saturated(k: int, least: float):
    """Ids of vectors whose lists are full of entries from ``least`` on."""
    def work(batches):
        for batch in batches:
            full = [len(e) >= k and e["sim"].min() >= least for e in (np.frombuffer(b, ENTRY) for b in batch.column("list").to_pylist())]
            yield batch.select(["id"]).filter(pa.array(full, pa.bool_()))
    return work


def _closed(batches):
    """Runs of at most CLOSE vectors of one component and order code, with their centre and radius."""
    for batch in batches:
        dims, comp = np.asarray(batch.column("dims")), np.asarray(batch.column("component_id"))
        blobs = batch.column("x").to_pylist()
        rows = []
        for s, c in zip(*map(np.ndarray.tolist, runs_of(comp))):
            for d in np.unique(dims[s:s + c]).tolist():
                pick = s + np.flatnonzero(dims[s:s + c] == d)
                for at in range(0, len(pick), CLOSE):
                    own = [blobs[i] for i in pick[at:at + CLOSE]]
                    x = np.frombuffer(b"".join(own)).reshape(-1, d)
                    centre = x.sum(axis=0)
                    norm = np.sqrt(np.dot(centre, centre))
                    centre = centre / norm if norm > 1e-6 else x[0]
                    radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
                    rows.append((d, int(comp[s]), centre.tobytes(), radius, b"".join(own)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5,
                                          (pa.int32(), pa.int64(), pa.binary(), pa.float64(), pa.binary()))],
                                         names=["dims", "component_id", "centre", "radius", "members"])


def _against(threshold: float, blocks):
    """(a, b): components of which a vector of one block and an outer vector link."""
    reach = float(np.arccos(min(max(threshold, -1.0), 1.0)))

    def work(batches):
        for batch in batches:
            dims, comp = np.asarray(batch.column("dims")), np.asarray(batch.column("component_id"))
            blobs = batch.column("x").to_pylist()
            found = set()
            for d in np.unique(dims).tolist():
                if d not in blocks.value:
                    continue
                owners, centres, radii, members = blocks.value[d]
                pick = np.flatnonzero(dims == d)
                x, own = np.frombuffer(b"".join(blobs[i] for i in pick)).reshape(-1, d), comp[pick]
                least = np.where(radii + reach < np.pi, np.cos(np.minimum(radii + reach, np.pi)) - 1e-6, -2.0)
                near = (x @ centres.T >= least) & (own[:, None] != owners[None, :])
                for j in np.flatnonzero(near.any(axis=0)).tolist():
                    rows = np.flatnonzero(near[:, j])
                    linked = (x[rows] @ members[j].T >= threshold).any(axis=1)
                    found.update((int(owners[j]), c) for c in np.unique(own[rows[linked]]).tolist())
            yield pa.RecordBatch.from_pydict({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return work


def _joined_across(joined: DataFrame, chosen: DataFrame | None, vectors: DataFrame, threshold: float) -> DataFrame:
    """``joined`` after the ``chosen`` vectors (all, if None) were compared with all vectors of other components."""
    spark = joined.sparkSession
    placed = stored(vectors.select("id", "dims", "x", "q").join(joined, "id"), "placed")
    some = placed if chosen is None else placed.join(chosen, "id", "left_semi")
    order = some.mapInArrow(_coded, "dims int, component_id long, x binary, code long")
    blocks = stored(order.repartitionByRange("component_id", "dims", "code", F.xxhash64("x")).sortWithinPartitions("component_id", "dims", "code")
                    .mapInArrow(_closed, "dims int, component_id long, centre binary, radius double, members binary"), "blocks")
    blocks = blocks.withColumn("at", F.monotonically_increasing_id())
    total = blocks.agg(F.sum(F.length("members") + F.length("centre"))).first()[0] or 0
    n = -(-int(total) // SLICE)
    if not n:
        return joined
    blocks = stored(blocks.withColumn("slice", F.pmod(F.xxhash64("at"), F.lit(n)).cast("int")).drop("at"), "slices")
    links = None
    for i in range(n):
        by_dims: dict[int, list] = {}
        for r in blocks.filter(F.col("slice") == i).toLocalIterator():
            by_dims.setdefault(r["dims"], []).append(r)
        held = spark.sparkContext.broadcast({
            d: (np.array([r["component_id"] for r in rows]), np.frombuffer(b"".join(bytes(r["centre"]) for r in rows)).reshape(-1, d),
                np.array([r["radius"] for r in rows]), [np.frombuffer(bytes(r["members"])).reshape(-1, d) for r in rows])
            for d, rows in by_dims.items()})
        part = stored(placed.select("dims", "x", "component_id").mapInArrow(_against(threshold, held), "a long, b long").distinct(), "across")
        links = part if links is None else links.union(part)
        held.destroy()
    if links.isEmpty():
        return joined
    groups = components(joined.select(F.col("component_id").alias("id")).distinct(), links)
    return stored(joined.join(groups.select(F.col("id").alias("component_id"), F.col("component_id").alias("root")), "component_id")
                  .select("id", F.col("root").alias("component_id")), "components")


def _coded(batches):
    """The signs of projections, most telling last, so that close vectors sort together."""
    for batch in batches:
        dims = np.asarray(batch.column("dims"))
        blobs, code = batch.column("q").to_pylist(), np.zeros(len(dims), np.int64)
        for d in np.unique(dims).tolist():
            pick = np.flatnonzero(dims == d)
            planes = np.random.default_rng([d, 0]).normal(size=(d, SIGNS)).astype(np.float32)
            code[pick] = (_directions([blobs[i] for i in pick], d) @ planes > 0) @ (1 << np.arange(SIGNS))
        yield pa.RecordBatch.from_arrays([batch.column("dims"), batch.column("component_id"), batch.column("x"), pa.array(code)],
                                         names=["dims", "component_id", "x", "code"])


def _brute(threshold: float, sample):
    def work(batches):
        by_dims = sample.value
        for batch in batches:
            dims = np.asarray(batch.column("dims"))
            ids, blobs = np.asarray(batch.column("id")), batch.column("x").to_pylist()
            for d in np.unique(dims).tolist():
                if d in by_dims:
                    pick = np.flatnonzero(dims == d)
                    own, x = by_dims[d]
                    i, j = np.nonzero(np.frombuffer(b"".join(blobs[p] for p in pick)).reshape(-1, d) @ x.T >= threshold)
                    other = ids[pick[i]]
                    keep = own[j] != other
                    yield pa.RecordBatch.from_pydict({"a": pa.array(own[j][keep], pa.int64()), "b": pa.array(other[keep], pa.int64())})
    return work


def _counted(threshold: float):
    """Links of the vectors of one pair of blocks, each counted as often as its other end has copies."""
    def work(batches):
        for batch in batches:
            ids, counts = [], []
            for i, j, members in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("members").to_pylist()):
                own = np.array([m["id"] for m in members])
                block, n = np.array([m["block"] for m in members]), np.array([m["n"] for m in members])
                size = np.array([len(m["x"]) for m in members])
                for d in np.unique(size).tolist():
                    pick = np.flatnonzero(size == d)
                    x = np.frombuffer(b"".join(members[p]["x"] for p in pick)).reshape(len(pick), -1)
                    left, right = block[pick] == i, block[pick] == j
                    linked = x[left] @ x[right].T >= threshold
                    if i == j:
                        np.fill_diagonal(linked, False)
                        ids.append(own[pick]), counts.append(linked @ n[pick])
                    else:
                        ids += [own[pick][left], own[pick][right]]
                        counts += [linked @ n[pick][right], n[pick][left] @ linked]
            yield pa.RecordBatch.from_pydict({"id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
                                              "n": pa.array(np.concatenate(counts) if counts else [], pa.int64())})
    return work


def _neighbourhoods(placed: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``(id, n_links)`` over whole components."""
    size = placed.groupBy("component_id").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (placed.join(size, "component_id").join(vectors.select("id", "x", "n"), "id").withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pairs = dealt.groupBy("component_id", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(
        F.collect_list(F.struct("id", "block", "x", "n")).alias("members"))
    return pairs.mapInArrow(_counted(threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n_links"))


def _recall(truth: DataFrame, joined: DataFrame) -> float:
    """Mean over the audited vectors that have links of the share found of their links. A link counts
    as found if both ends are in one component: its neighbourhood is compared whole."""
    ends = (truth.join(joined.select(F.col("id").alias("a"), F.col("component_id").alias("ca")), "a")
            .join(joined.select(F.col("id").alias("b"), F.col("component_id").alias("cb")), "b"))
    share = ends.groupBy("a").agg(F.avg((F.col("ca") == F.col("cb")).cast("double")).alias("share")).agg(F.avg("share")).first()[0]
    return 1.0 if share is None else float(share)


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                           k: int = K) -> DataFrame:
    """``(vec_id, n_links, component_id, kept, audited_recall)`` for each vector: others at a cosine of
    ``threshold`` or more, the smallest id reachable over such links, and whether it is its own."""
    spark = df.sparkSession
    prepare(spark)
    given = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    twice = given.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if twice is not None and twice > 1:
        given = given.groupBy("id").agg(F.max("embedding").alias("embedding"))
    everything = stored(given.mapInArrow(_valid, "id long, dims int, x binary, q binary"), "vectors")
    usable = F.col("dims").isNotNull() & F.col("id").isNotNull()
    # One representative, the smallest id, for each group of copies; a large group is gathered in parts.
    marked = everything.filter(usable).withColumn("digest", F.sha2(F.concat(F.col("dims").cast("string").cast("binary"), F.col("x")), 256))
    parts = stored(marked.groupBy("digest", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(F.collect_list("id").alias("ids")), "copies")
    groups = stored(parts.groupBy("digest").agg(F.min(F.array_min("ids")).alias("rep"), F.sum(F.size("ids")).cast("long").alias("n")), "groups")
    copies = parts.join(groups, "digest").select("rep", "ids")
    vectors = stored(everything.filter(usable).join(groups.select(F.col("rep").alias("id"), "n"), "id"), "representatives")

    signs, orders = _start(vectors.count())
    placed = vectors.mapInArrow(_ordered(signs, orders), "part long, code long, along double, id long, q binary, dims int")
    first = placed.repartitionByRange("part", "code", "along").sortWithinPartitions("part", "code", "along").mapInArrow(_beside, "id long, list binary")
    lists = _merged(first, k)
    for _ in range(ROUNDS):
        lists = _descend(lists, vectors, k)

    asked = vectors.orderBy(F.xxhash64("id"), "id").limit(AUDIT).select("id", "dims", "x").collect()
    by_dims = {}
    for d in {r["dims"] for r in asked}:
        own = [r for r in asked if r["dims"] == d]
        by_dims[d] = (np.array([r["id"] for r in own]), np.frombuffer(b"".join(bytes(r["x"]) for r in own)).reshape(len(own), d))
    truth = stored(vectors.mapInArrow(_brute(threshold, spark.sparkContext.broadcast(by_dims)), "a long, b long"), "audit")
    for more in range(MORE_ROUNDS + 1):
        links = _links(lists, vectors, threshold)
        joined = stored(components(vectors.select("id"), links), "components")
        full = stored(lists.mapInArrow(_saturated(k, threshold - SLACK), "id long"), "saturated")
        joined = _joined_across(joined, full, vectors, threshold)
        recall = _recall(truth, joined)
        if recall >= TARGET:
            break
        if more == MORE_ROUNDS:
            joined = _joined_across(joined, None, vectors, threshold)
            recall = _recall(truth, joined)
            break
        k *= 2
        lists = _descend(lists, vectors, k)

    counts = _neighbourhoods(joined, vectors, threshold)
    linked = (joined.join(vectors.select("id", "n"), "id").join(counts, "id", "left")
              .select(F.col("id").alias("rep"), "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    out = (copies.join(linked, "rep").select(F.explode("ids").alias("id"), "n_links", "component_id")
           .union(everything.filter(~usable).select("id", F.lit(0).cast("long"), "id"))
           .select(F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), "component_id"))
    return out.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(float(recall)).alias("audited_recall"))
