"""Each corpus operator against its plain version, on the given tables and on awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import bpe, common, minhash_dedup, neighbour_graph, packing, quality
from tablewatch.llm.decontaminate import find_benchmark
from tablewatch.llm.line_dedup import remove_repeated_lines
from tablewatch.llm.minhash_dedup import near_duplicates
from tablewatch.llm.neighbour_graph import near_duplicate_vectors
from tablewatch.llm.packing import pack_documents
from tablewatch.llm.queries import QUERIES, vocabulary
from tablewatch.llm.substring_dedup import remove_repeats
from tablewatch.llm.suffix_dedup import remove_repeated_bytes
from tablewatch.llm.token_counts import CACHE, count_tokens
from tablewatch.llm.toxicity import toxicity
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "doc_id long, text string, hits int, n string, bucket int, score string, `a b` int"


def awkward():
    """Nulls, empty and very long texts, copies, ties, repeated rows, shared passages, short texts."""
    rng = random.Random(5)
    words = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(400)]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ".\n", "\t", "  "]) for _ in range(n))

    passage, common = prose(60), prose(45)
    base = prose(150)
    texts = {1: prose(120), 2: None, 3: "", 4: "  \n\t ", 5: prose(30) + passage + prose(40), 6: passage + prose(20),
             7: prose(25) + passage, 8: base, 9: base, 10: base.replace("Word3 ", "Word4 ", 1) + " tail", 11: "one two three",
             12: "one two three", 13: "ONE two THREE", 14: "a", 15: "x" * 1500, 16: "ab " * 700, 17: prose(6000) + passage + "y" * 3000,
             18: "\n".join(["same line of some ten words that comes again and again"] * 5), 19: "same line of some ten words that comes again and agai",
             20: "same line of some ten words that was again and again\nshort one\nshort two\n\nshort one"}
    for i in range(21, 40):
        texts[i] = prose(20) + common + prose(rng.randint(0, 30))
    for i in range(40, 60):  # near copies of one text
        w = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts[i] = " ".join(w)
    for i in range(60, 75):  # small sets around the threshold
        texts[i] = " ".join(["p", "q", "r", "s", "t", "u", "v", "w", "z"][: rng.randint(3, 9)])
    return texts


def table(spark, texts, parts=4):
    rows = [(i, t, 1, "x", 2, "s", 3) for i, t in texts.items()]
    rows += [rows[4], rows[4], rows[1]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def docs(spark):
    return awkward()


@pytest.fixture(scope="module")
def small(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def result(df, *cols, key="doc_id"):
    rows = df.select(key, *cols).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


# -- every pair of operator and plain version ------------------------------------------------

def suffix(df, keep_first=False):
    return result(remove_repeated_bytes(df, length=200, keep_first=keep_first).withColumn("sha", F.sha2("kept", 256)),
                  "n_bytes", "n_removed", "n_spans", "sha")


def substring(df, keep_first=False):
    return result(remove_repeats(df, keep_first=keep_first).withColumn("sha", F.sha2(F.encode("text", "UTF-8"), 256)), "n_words", "n_removed", "sha")


def lines(df):
    return result(remove_repeated_lines(df).withColumn("sha", F.sha2(F.encode("text", "UTF-8"), 256)), "n_lines", "n_removed", "sha")


@pytest.mark.parametrize("keep_first", [False, True])
def test_suffix_dedup(spark, docs, keep_first):
    assert suffix(table(spark, docs), keep_first) == brute.repeated_bytes(docs, keep_first=keep_first)


@pytest.mark.parametrize("keep_first", [False, True])
def test_substring_dedup(spark, docs, keep_first):
    assert substring(table(spark, docs), keep_first) == brute.repeated_words(docs, keep_first=keep_first)


def test_line_dedup(spark, docs):
    assert lines(table(spark, docs)) == brute.repeated_lines(docs)


@pytest.mark.parametrize("words", [4, 5])
def test_minhash(spark, docs, words):
    got = result(near_duplicates(table(spark, docs), words=words), "n_shingles", "component_id")
    assert got == brute.near_duplicates(docs, words=words)


def test_minhash_many_small_sets(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 14))) for i in range(600)}
    got = result(near_duplicates(table(spark, texts), words=1), "n_shingles", "component_id")
    assert got == brute.near_duplicates(texts, words=1)


def test_minhash_large_groups(spark):
    """Many near copies and one passage shared by many: components as by brute force, no pair explosion."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(3000)]
    base, passage = [rng.choice(vocabulary) for _ in range(300)], [rng.choice(vocabulary) for _ in range(60)]
    texts = {}
    for i in range(250):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts[i] = " ".join(w)
    for i in range(250, 500):
        texts[i] = " ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randint(5, 90))])
    got = result(near_duplicates(table(spark, texts, 8), words=4), "n_shingles", "component_id")
    assert got == brute.near_duplicates(texts)


def test_minhash_exact_in_long_lists(spark):
    """Pairs that meet in long lists only, far from each other: no neighbour, pivot or third document joins them."""
    rng = random.Random(11)
    core = [f"core{i}" for i in range(8)]
    ids = rng.sample(range(10_000), 600)
    texts = {}
    for p in range(300):
        for i in ids[2 * p:2 * p + 2]:  # 9 of 11 words in common, 8 of 12 with all others
            texts[i] = " ".join([*core, f"pair{p}", f"own{i}"])
    got = result(near_duplicates(table(spark, texts, 8), words=1), "n_shingles", "component_id")
    assert got == {i: (10, min(ids[2 * p:2 * p + 2])) for p in range(300) for i in ids[2 * p:2 * p + 2]}
    core, texts = [f"core{i}" for i in range(70)], {}
    for p in range(100):  # the same with sets larger than a sketch: 90 of 110, and 70 of 130 with all others
        for i in ids[2 * p:2 * p + 2]:
            words = [*core, *(f"pair{p}x{j}" for j in range(20)), *(f"own{i}x{j}" for j in range(10))]
            texts[i] = " ".join(words)
    got = result(near_duplicates(table(spark, texts, 8), words=1), "n_shingles", "component_id")
    assert got == {i: (100, min(ids[2 * p:2 * p + 2])) for p in range(100) for i in ids[2 * p:2 * p + 2]}


def test_minhash_outliers_of_a_large_component(spark):
    """Copies that link with few of many members, and members that are candidates of hundreds: as by brute force."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(200)]
    texts = {}
    for i in range(300):
        words = list(base)
        for place in rng.sample(range(200), rng.choice([2, 2, 4, 11, 22, 24, 26])):
            words[place] = f"e{i}x{place}"
        texts[i] = " ".join(words)
    got = result(near_duplicates(table(spark, texts, 8), words=1), "n_shingles", "component_id")
    assert got == brute.near_duplicates(texts, words=1)


@pytest.mark.parametrize("forest", [7, common.FOREST])
def test_components(spark, monkeypatch, forest):
    """Paths, hubs and chance links, nulls and links to itself; few links take one step, whatever their shape."""
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(-300 + rng.randrange(60), -300 + rng.randrange(60)) for _ in range(45)]
    rng.shuffle(links)
    smallest = {i: i for i in range(-310, 140)}
    for _ in smallest:
        for a, b in links:
            smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    steps = []
    monkeypatch.setattr(common, "FOREST", forest)
    monkeypatch.setattr(common, "stored", lambda df, label, f=common.stored: steps.append(label) or f(df, label))
    found = common.components(spark.createDataFrame([(i,) for i in smallest], "id long"),
                              spark.createDataFrame(links + [(None, 5), (6, None)], "a long, b long").repartition(3))
    assert {r.id: r.component_id for r in found.collect()} == smallest
    assert forest < len(links) or len(steps) == 2
    assert common.components(spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([], "a long, b long")).collect() == [(1, 1)]


def test_minhash_common_values():
    rng = np.random.default_rng(2)
    table = [np.sort(rng.integers(0, 40, rng.integers(0, 20))) for _ in range(30)]
    values, rows = np.concatenate(table), np.repeat(np.arange(30), [len(t) for t in table])
    by = np.argsort(values)
    for x in table:
        assert minhash_dedup._in_common(x, values[by], rows[by], 30).tolist() == [int(np.isin(t, x).sum()) for t in table]


def test_minhash_prefixes():
    """Any two sketches with the least overlap share a value of their prefixes, in whatever order."""
    rng = np.random.default_rng(3)
    for n in range(2, 90):
        for m in range(n, min(90, 5 * n // 4) + 1):
            sizes = [min(n, minhash_dedup.K), min(m, minhash_dedup.K)]
            common = minhash_dedup.LEAST if m > minhash_dedup.K else (4 * m + 4) // 5
            if common > sizes[0]:
                continue
            both = np.arange(common)
            ranks = rng.permutation(1000)  # one order for both
            x = np.concatenate((both, np.arange(100, 100 + sizes[0] - common)))
            z = np.concatenate((both, np.arange(300, 300 + sizes[1] - common)))
            px, pz = (set(sorted(v.tolist(), key=lambda k: ranks[k])[:int(minhash_dedup._prefix(np.array([size]))[0])]) for v, size in ((x, n), (z, m)))
            assert px & pz, (n, m)


def test_benchmark(spark, docs):
    some = docs[6].split()
    items = [(1, " ".join(some[3:30])), (2, "one TWO three"), (10, "A"), (3, None), (4, ""), (5, "never seen in any text at all, this long item is"),
             (6, " ".join(some[10:20]).upper()), (6, "x" * 1500), (None, "short one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = find_benchmark(table(spark, docs), benchmark)
    out = out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("sha"),
                     (F.col("n_hit") > 0).alias("bad"), "clean_text").distinct()
    assert result(out, "n_words", "n_hit", "k", "sha", "bad") == brute.benchmark_hits(docs, items)
    clean = {r["doc_id"]: r["clean_text"] for r in out.collect()}
    assert clean[1] == docs[1] and clean[2] == "" and "Word" in clean[5]
    assert brute.benchmark_hits({6: clean[6]}, items[:1])[6][1] == 0


def test_benchmark_in_blocks(spark, docs, monkeypatch):
    from tablewatch.llm import decontaminate
    items = [(i, " ".join(docs[6].split()[i:i + 12])) for i in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)
    out = find_benchmark(table(spark, docs), benchmark).withColumn("k", F.size("items").cast("long")).select("doc_id", "n_words", "n_hit", "k").distinct()
    assert result(out, "n_words", "n_hit", "k") == {i: v[:3] for i, v in brute.benchmark_hits(docs, items).items()}


def vectors():
    rng = random.Random(2)
    rows = {}
    for c in range(12):
        centre = [rng.gauss(0, 1) for _ in range(16)]
        for k in range(rng.choice([1, 2, 3, 60])):
            rows[len(rows) * 3] = [x + rng.gauss(0, 0.08) for x in centre]
    for _ in range(200):
        rows[len(rows) * 3] = [rng.gauss(0, 1) for _ in range(16)]
    rows |= {1001: None, 1002: [], 1003: [0.0] * 16, 1004: [float("nan")] * 16, 1005: [1.0, None], 1006: [float("inf")] + [0.0] * 15,
             1007: [1e-200] * 16, 1008: [1.0] * 16, 1009: [3.0, 3.0], 1010: [1.0, 1.0]}
    return rows


def test_vectors(spark):
    rows = vectors()
    want = brute.vectors({i: v for i, v in rows.items() if i != 1007})
    want[1007], want[1008] = (1, 1007), (1, 1007)  # tiny values: brute force's norms vanish
    data = [(i, v, 1, "x") for i, v in rows.items()]
    df = spark.createDataFrame([*data, data[0], data[0]], "vec_id long, embedding array<double>, n_links int, id string").repartition(5)
    out = near_duplicate_vectors(df)
    assert result(out, "n_links", "component_id", key="vec_id") == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) and r["audited_recall"] >= 0.99 for r in out.collect())


def linked_groups(size=300):
    """Two groups of near copies at a cosine of about 0.92, exact copies, and one vector between two groups."""
    rng = random.Random(8)

    def near(centre, n):
        return [[x + rng.gauss(0, 0.002) for x in centre] for _ in range(n)]

    def turned(a, b, cosine):
        return [cosine * x + (1 - cosine ** 2) ** 0.5 * y for x, y in zip(a, b)]

    unit = [[float(i == j) for j in range(16)] for i in range(16)]
    rows = near(unit[0], size) + near(turned(unit[0], unit[1], 0.92), size)
    rows += near(unit[2], size) + near(turned(unit[2], unit[3], 0.8), size) + [turned(unit[2], unit[3], 0.95)]
    rows += [unit[5]] * size + [turned(unit[5], unit[6], 0.92)] * size
    rng.shuffle(rows)
    return dict(enumerate(rows))


def test_vectors_of_full_lists(spark):
    rows = linked_groups()
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(5)
    got, want = result(near_duplicate_vectors(df), "n_links", "component_id", key="vec_id"), brute.vectors(rows)
    print("links", sum(r[0] for r in got.values()), "of", sum(r[0] for r in want.values()))
    assert got == want


def test_vectors_when_the_descent_finds_nothing(spark, monkeypatch):
    """A large group does not hide that small pairs are missing, and an incomplete search is completed."""
    monkeypatch.setattr(neighbour_graph, "MORE_ROUNDS", 0)
    monkeypatch.setattr(neighbour_graph, "_descend", lambda lists, vectors, k: lists.filter("id < 300"))
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(51)]
    rows = dict(enumerate([x + rng.gauss(0, 0.05) for x in centres[min(i // 300, 1) and 1 + (i - 300) % 50]] for i in range(400)))
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(5)
    got, want = result(near_duplicate_vectors(df), "n_links", "component_id", key="vec_id"), brute.vectors(rows)
    print("vectors right", sum(got[i] == want[i] for i in want), "of", len(want))
    assert got == want


def test_packing_is_gapless_and_exact(spark, docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    rows = pack_documents(table(spark, docs), vocabulary(), with_ids=True).collect()
    want = brute.pieces_of(docs, lambda t: library.encode(t, add_special_tokens=False).ids)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    places = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 1024


@pytest.mark.parametrize("seed", range(25))
def test_bin_completion_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 16, 23])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]

    def best(rest, bins, limit):  # exhaustive
        if len(bins) >= limit:
            return limit
        if not rest:
            return len(bins)
        out, seen = limit, set()
        for i, room in enumerate(bins):
            if room >= rest[0] and room not in seen:
                seen.add(room)
                out = best(rest[1:], bins[:i] + [room - rest[0]] + bins[i + 1:], out)
        return best(rest[1:], bins + [capacity - rest[0]], out)

    counts = {s: sizes.count(s) for s in sizes}
    patterns, n, bound = packing.bin_completion(counts, capacity)
    assert all(sum(p) <= capacity for _, p in patterns)
    assert {s: sum(t * p.count(s) for t, p in patterns) for s in counts} == counts
    assert n == best(sorted(sizes, reverse=True), [], len(sizes) + 1) and bound <= n


def test_pieces_equal_the_library():
    import numpy as np
    import pyarrow as pa

    from tablewatch.llm import bytetext as bt
    enc = bpe.Encoder(vocabulary())
    assert enc.by_piece
    rng = random.Random(1)
    signs = list("ab'strevlmd  \n\n\t.!,19éñ") + ["'s", "'re", "'ll", "<|endoftext|>", " ", " ", "\x85", "\x1c", "​", "　", "中", "🙂", "²", "́"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rng.choice(signs + [chr(rng.randrange(0x20, 0xD7FF)), chr(rng.randrange(0xE000, 0x1FFFF))]) for _ in range(12)) for _ in range(3000)]
    texts += [None, "", "a<|endoftext|> b", "<|endoftext|>", "<|endoftext", "supercalifragilisticexpialidociousness" * 9]
    got = [ids[a:b].tolist() for _, ids, rows in enc.encode(*bt.utf8(pa.array(texts, pa.string()))) for a, b in zip(rows[:-1], rows[1:])]
    assert got == enc.whole([t or "" for t in texts])
    assert np.count_nonzero(enc.keys)


def test_token_counts_and_cache(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    cache = str(tmp_path / "cache")
    out = count_tokens(table(spark, docs), vocabulary(), cache=cache)
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in docs.items()}
    rows = out.collect()
    assert len(rows) == len(docs) + 3
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    stored = spark.read.schema(CACHE).parquet(cache)
    distinct = len({t or "" for t in docs.values()})
    assert stored.count() == distinct
    more = spark.createDataFrame([(1, docs[1]), (2, "a new text"), (3, "a new text")], "doc_id long, text string")  # one miss
    assert count_tokens(more, vocabulary(), cache=cache).count() == 3
    assert spark.read.schema(CACHE).parquet(cache).count() == distinct + 1


def test_toxicity_learns_pairs_and_generalises(spark):
    """Neither the insult nor the group decides alone; both together are toxic."""
    rng = random.Random(4)
    plain = [f"plain{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(900):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(plain) for _ in range(rng.randint(5, 40))] + ["vermin"] * insult + ["strangers"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(insult and group)))
    df = spark.createDataFrame(rows + [(5000, None), (5001, "")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (7, 1, None), (99999, 1, 1), labels[0]], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity(df, known).collect()}
    held = [(out[i]["predicted"], t) for i, _, t in labels if out[i]["held_out"]]
    assert len(held) > 200 and sum(p == t for p, t in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_toxicity_learns_what_only_pairs_tell(spark):
    """Two words, each as frequent in either label, toxic if both or neither occur: additive weights over the same
    words stay at chance on held-out rows, the machine does not."""
    import zlib
    rng = random.Random(12)
    filler = [f"word{i}" for i in range(40)]
    texts, labels = {}, {}
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = rng.choices(filler, k=12) + ["apple"] * a + ["river"] * b
        rng.shuffle(w)
        texts[i], labels[i] = " ".join(w), int(a == b)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    known = spark.createDataFrame([(i, t) for i, t in labels.items()], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity(df, known, threshold=0.5).collect()}
    held = [i for i in texts if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == labels[i] for i in held]) >= 0.95
    # A logistic regression on the same words, by gradient descent.
    words = sorted({w for t in texts.values() for w in t.split()})
    x = np.array([[w in t.split() for w in words] for t in texts.values()], float)
    y = np.array(list(labels.values()))
    learn = np.array([zlib.crc32(str(i).encode()) % 3 != 1 for i in texts])
    weight, bias = np.zeros(len(words)), 0.0
    for _ in range(300):
        g = 1 / (1 + np.exp(-(x[learn] @ weight + bias))) - y[learn]
        weight -= 0.5 * x[learn].T @ g / learn.sum()
        bias -= 0.5 * g.mean()
    assert abs(np.mean((x[~learn] @ weight + bias > 0) == y[~learn]) - 0.5) < 0.08


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = toxicity(df, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert [r["predicted"] for r in out] == [0, 0] and all(r["score"] < 0.01 for r in out)


def test_quality_against_the_labels(spark):
    """The labels are never used in learning; the classifier agrees with them."""
    sf = SMALL.replace("0.001", "0.01")
    out = QUERIES["op2_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in out if r["quality"] == 1], [r for r in out if r["quality"] == 0]
    assert sum(r["kept"] for r in good) / len(good) > 0.98 and sum(not r["kept"] for r in bad) / len(bad) > 0.9


def test_quality_on_awkward_rows(spark, docs):
    df = table(spark, docs)
    scorer = quality.learn(df)
    out = quality.classify(df, scorer).collect()
    assert len(out) == len(docs) + 3 and all(r["kept"] for r in out if not (docs[r["doc_id"]] or "").strip())
    kept = quality.keep_good(df, scorer)
    assert kept.schema == df.schema and kept.count() == sum(r["kept"] for r in out)

def test_quality_beyond_the_start(spark):
    """A varied start does not excuse a sentence repeated for the rest; few words are no excuse either."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def prose(n, stops=True):
        return " ".join(rng.choice(words) + "." * (stops and rng.random() < 0.125) for _ in range(n))

    rows = [(i, prose(rng.randint(60, 900))) for i in range(400)]
    rows += [(1000 + i, prose(256, False) + " " + " ".join([prose(12, False)] * 200)) for i in range(60)]
    rows += [(2000 + i, " ".join(rng.choice(["$$$", "###", "@@@", "%%%"]) for _ in range(40))) for i in range(60)]
    rows += [(3000, "$$$ $$$ ### ### $$$ ### $$$"), (3001, prose(5)), (3002, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = quality.classify(df, quality.learn(df)).collect()
    assert all(r["kept"] == (r["score"] >= 0.25) for r in out if r["doc_id"] != 3002)
    kept = {r["doc_id"] for r in out if r["kept"]}
    print("good kept", sum(i in kept for i in range(400)), "repeated kept", sum(1000 + i in kept for i in range(60)), "short junk kept", 3000 in kept)
    assert all(i in kept for i in (*range(400), 3001, 3002))
    assert not any(i in kept for i in (*range(1000, 1060), *range(2000, 2060), 3000))



# -- empty tables ----------------------------------------------------------------------------

def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    frames = [remove_repeated_bytes(empty), remove_repeats(empty), remove_repeated_lines(empty), near_duplicates(empty),
              find_benchmark(empty, none), pack_documents(empty, vocabulary()), count_tokens(empty, vocabulary()),
              toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int")), quality.classify(empty, quality.learn(empty)),
              near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(80))
    both = spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeats(both).collect()} == {None: 80, 1: 80}
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeated_bytes(both).collect()} == {None: len(text), 1: len(text)}
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeated_lines(both).collect()} == {None: 1, 1: 0}  # null counts as the last id
    assert {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_duplicates(both).collect()} == {None: (1, False), 1: (1, True)}
    assert pack_documents(both, vocabulary()).count() == 2


def test_repeated_ids(spark):
    """Rows that share an id, null included, but not a text are documents of their own."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(80)) for _ in range(4)]
    given = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[2]), (None, texts[3]), (None, texts[3])]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    want = sorted([(1, 80), (1, 0), (2, 80), (-1, 0), (-1, 0)])
    cut = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_removed"]) for r in remove_repeats(df).collect()]
    assert sorted(cut) == want
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_removed"] // len(texts[0])) for r in remove_repeated_bytes(df).collect()) \
        == sorted([(1, 1), (1, 0), (2, 1), (-1, 0), (-1, 0)])
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in remove_repeated_lines(df).collect()) == sorted([(1, 0), (1, 0), (2, 1), (-1, 0), (-1, 0)])
    near = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_duplicates(df).collect())
    assert near == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (-1, -1, True), (-1, -1, True)])
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    tokens = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in set(given))
    pieces = pack_documents(df, vocabulary()).collect()
    assert sum(r["length"] for r in pieces) == tokens and len(pieces) == 5


# -- the registered queries on the given tables ------------------------------------------------

def test_registered_queries(spark, small):
    q = {k: f for k, f in QUERIES.items()}
    assert [k.split("_")[0] for k in q] == [f"op{i}" for i in range(1, 14)]
    assert result(q["op3_suffix_array_dedup"](spark, SMALL), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated_bytes(small)
    assert result(q["op7_minhash_near_dedup"](spark, SMALL), "n_shingles", "component_id") == brute.near_duplicates(small)
    assert result(q["op8_line_dedup"](spark, SMALL), "n_lines", "n_removed", "kept_sha256") == brute.repeated_lines(small)
    given = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()}
    assert result(q["op1_embedding_near_dedup"](spark, SMALL), "n_links", "component_id", key="vec_id") == brute.vectors(given)
