"""The prefix trie, Order MinHash and ranked search against their plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import lexical_search, order_minhash, prefix_trie
from tablewatch.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute

# -- conversations ---------------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, role string, text string, path string, shard int"


def talks():
    """Common starts, one conversation that many share, ties, nulls, empty and repeated turns."""
    rng = random.Random(4)
    rows = []
    for c in range(400):
        n = rng.randint(1, 12)
        turns = [("user" if t % 2 else None, f"say {rng.choice('abc')}{'é' * rng.randint(0, 2)}") for t in range(n)]
        if c % 3 == 0:
            turns = [("user", "hello"), ("assistant", "yes"), ("user", None)] + turns * (c % 2)
        rows += [(c * 2 - 50, t if t else None, role, text, "x", 1) for t, (role, text) in enumerate(turns)]
    rows += [(None, 1, "user", "nobody", "x", 1), (10_001, 3, "", "", None, None), (10_002, -1, "user", "x" * 5000, None, None)]
    return rows


def tree_of(df):
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("turns", [100_000, 60])
def test_prefix_tree(spark, turns):
    """As one shard, and split into many of which a node can fill several."""
    rows = talks()
    convs = prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = brute.tree(brute.rebuilt([r[:4] for r in rows]))
    assert tree_of(prefix_trie.prefix_tree(prefix_trie.rebuilt(convs), turns)) == want


def test_prefix_tree_of_copies(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(500) for t in range(3 + (c == 77))]
    convs = prefix_trie.conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    want = brute.tree({c: [("u", f"turn {t}") for t in range(3 + (c == 77))] for c in range(500)})
    assert tree_of(prefix_trie.prefix_tree(convs, 100)) == want


def test_prefix_tree_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert prefix_trie.prefix_tree(prefix_trie.rebuilt(prefix_trie.conversations(none))).collect() == []


def test_double_array():
    """Every path leads to a cell of its own, and nothing else is accepted."""
    rng = np.random.default_rng(1)
    paths = sorted({b"".join(bytes([rng.integers(0, 5)]) * 16 for _ in range(rng.integers(0, 6))) for _ in range(300)})
    levels = prefix_trie.build(np.arange(len(paths)), paths, np.ones(sum(len(p) // 16 for p in paths), np.int64))
    starts = {p[:16 * d] for p in paths for d in range(len(p) // 16 + 1)}
    assert sum(len(x["n"]) for x in levels) == len(starts)
    trie = prefix_trie.DoubleArray()
    cells = trie.add(np.array([0, 0, 0]), np.array([2, 5, 9]))
    more = trie.add(np.array([cells[0], cells[2]]), np.array([5, 5]))
    assert len({0, *cells.tolist(), *more.tolist()}) == 6
    assert (trie.walk(np.array([0, cells[2]]), np.array([5, 5])) == [cells[1], more[1]]).all()
    with pytest.raises(ValueError):
        trie.walk(np.array([0]), np.array([3]))


# -- fingerprints ----------------------------------------------------------------------------

def texts():
    rng = random.Random(6)
    words = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(200)]
    out = {i: " ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for i in range(0, 300, 3)}
    return out | {1: None, 2: "", 4: " \n\t ", 5: "a", 7: "x" * 3000, 8: "one two", 10: "😀 é 漢字" * 40, 11: out[3], 13: "again " * 500, -20: "low"}


def test_fingerprints(spark):
    rows = list(texts().items())
    df = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id long, text string, bucket int, next string").repartition(7)
    out = order_minhash.fingerprints(df).withColumn("sha", F.sha2(F.encode("edited", "UTF-8"), 256)).collect()
    got = {r["doc_id"]: tuple(r[c] for c in ("n_chars", "sha", "fingerprint", "edited_fingerprint", "near_edited", "near_next")) for r in out}
    assert len(out) == len(rows)
    assert got == brute.fingerprints(rows)
    assert got[3][2] == got[11][2] and got[1][2] == got[4][2] == ""


@pytest.mark.parametrize("k, size, points", [(1, 1, 16), (3, 4, 32)])
def test_signature_parameters(spark, k, size, points):
    rows = [t for t in texts().values()]
    df = spark.createDataFrame([(t,) for t in rows], "text string").select("text", order_minhash.signature(F.col("text"), k, size, points).alias("s"))
    for r in df.collect():
        assert r["s"] == (None if r["text"] is None else brute.signature(r["text"], k, size, points))


def test_order_counts(spark):
    """A text whose halves are exchanged many times over has the same words but is not alike; an edited one is."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    few = list(words)
    for _ in range(8):
        few[rng.randrange(400)] = "new"
    blocks = [words[i:i + 4] for i in range(0, 400, 4)]
    rng.shuffle(blocks)
    moved = [w for b in blocks for w in b]
    pairs = [(" ".join(words), " ".join(x)) for x in (words, few, moved)]
    sig = order_minhash.signature
    df = spark.createDataFrame(pairs, "a string, b string")
    whole, edited, shuffled = (r[0] for r in df.select(order_minhash.likeness(sig(F.col("a"), 1, 3, 256), sig(F.col("b"), 1, 3, 256))).collect())
    assert whole == 1.0 and edited > 0.7 and shuffled < 0.4
    plain = [r[0] for r in df.select(order_minhash.likeness(sig(F.col("a"), 1, 1, 256), sig(F.col("b"), 1, 1, 256))).collect()]
    assert plain[2] == 1.0  # one k-mer a tuple has no order


def test_fingerprints_of_few_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert order_minhash.fingerprints(empty).collect() == []
    one = order_minhash.fingerprints(spark.createDataFrame([(1, "some words here")], "doc_id long, text string")).collect()
    assert one[0]["near_next"] == 1.0 and one[0]["edited"] == "some words" + "some "
    rows = [(5, "first text"), (5, "second text"), (5, "second text"), (None, "no id"), (None, None)]
    out = order_minhash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out) == [(0, ""), (0, "no id"), (5, "first text"), (5, "second text")]


# -- ranked search ---------------------------------------------------------------------------

def found(df):
    rows = df.collect()
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}
    assert len(got) == len(rows)
    return got


def search_tables(spark, n=400):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = {i: " ".join(rng.choices(words, weights, k=rng.randint(1, 120))) for i in range(n)}
    docs |= {n: None, n + 1: "", n + 2: "W1, w1-W2; é", n + 3: docs[5], n + 4: docs[5], n + 5: "rare " * 4000, n + 6: "!!"}
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(60)]
    items += [(100, None), (101, ""), (102, "nowhere to be seen"), (103, docs[5]), (104, "RARE"), (None, "w3 w3"), (105, "w1"), (105, "É é"), (106, "...")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x") for i, t in docs.items()], "doc_id long, text string, score int, term string").repartition(6),
            spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int"))


def test_search(spark):
    docs, items = search_tables(spark)
    assert found(lexical_search.search(*frames(spark, docs, items))) == brute.ranked(docs, items)


def test_search_in_blocks_and_shards(spark, monkeypatch):
    docs, items = search_tables(spark)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 200)
    monkeypatch.setattr(lexical_search, "READ", 2)
    items = items[:12] + items[60:]
    assert found(lexical_search.search(*frames(spark, docs, items), top=3)) == brute.ranked(docs, items, 3)


def test_search_of_nothing(spark):
    docs, items = search_tables(spark, 10)
    d, i = frames(spark, docs, items)
    assert lexical_search.search(d.limit(0), i).collect() == [] and lexical_search.search(d, i.limit(0)).collect() == []


def test_nra_stops_early_and_is_exact():
    """Against sums over whole lists; most of the entries are never read."""
    rng = np.random.default_rng(5)
    for trial in range(40):
        n, lists, total = 5000, [], np.zeros(5000, np.int64)
        for _ in range(int(rng.integers(1, 6))):
            docs = rng.choice(n, int(rng.integers(1, n)), replace=False)
            impact = np.sort((1000 * rng.pareto(1.0, len(docs))).astype(np.int64) + 1)[::-1] if trial % 2 else np.full(len(docs), 7)
            lists.append((docs, impact))
            total[docs] += impact
        hit, score = lexical_search.nra(lists, n, 1, 10)
        assert (total[hit] == score).all()
        want = sorted(((-s, i) for i, s in enumerate(total.tolist()) if s > 0))[:10]
        s, d = lexical_search.best(score, hit, 10)
        assert list(zip((-s).tolist(), d.tolist())) == want


# -- the registered queries on the given tables ------------------------------------------------

def test_registered(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op12_document_fingerprints"](spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in out} == brute.fingerprints(docs) and len(out) == len(docs)
    turns = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert tree_of(QUERIES["op11_conversation_prefix_trie"](spark, SMALL)) == brute.tree(brute.rebuilt(turns))
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(QUERIES["op13_ranked_lexical_search"](spark, SMALL)) == brute.ranked(dict(docs), items)
