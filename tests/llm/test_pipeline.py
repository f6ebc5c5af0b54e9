"""Every stage of the pipeline against a plain version of what it should do to its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import quality
from tablewatch.llm.common import stored
from tablewatch.llm.queries import vocabulary
from tests.conftest import SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def tables(spark):
    """The input of each stage, and the result of the last. A row is repeated, null or clashes in name."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(900001, None, None, None, None), (900002, "", "en", "src1", 0)], given.schema)
    docs = given.union(odd).withColumn("hits", F.lit(1)).withColumn("__id", F.col("doc_id"))
    out = [stored(docs, "test")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), "test"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(tables):
    for df in tables[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "hits", "__id"]


def test_quality(tables):
    before, after = texts(tables[0]), texts(tables[1])
    scored = quality.classify(tables[0], quality.learn(tables[0])).collect()
    assert set(after) == {r["doc_id"] for r in scored if r["kept"]} and {900001, 900002} <= set(after)
    assert all(after[i] == before[i] for i in after) and 0 < len(after) < len(before)


def test_lines(tables):
    before, after = texts(tables[1]), texts(tables[2])
    want = brute.repeated_lines(before)
    emptied = {i for i in before if i not in after}
    assert all(want[i][1] and want[i][2] == brute.sha("") for i in emptied) and emptied  # only what other documents have
    assert {i: brute.sha(t or "") for i, t in after.items()} == {i: w[2] for i, w in want.items() if i not in emptied}
    assert not any(w[1] and w[2] == brute.sha("") for i, w in want.items() if i in after)
    assert any(w[1] for w in want.values())
    changed = {i for i, w in want.items() if w[1]}
    for r in tables[2].collect():
        if r["doc_id"] in changed and r["text"]:
            assert r["n_chars"] == len(r["text"])


def test_near_duplicates(tables):
    before, after = texts(tables[2]), texts(tables[3])
    assert set(after) == {i for i, (_, c) in brute.near_duplicates(before, words=5).items() if i == c}


def test_benchmark(spark, tables):
    before, after = texts(tables[3]), texts(tables[4])
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.benchmark_hits(before, items)
    assert set(after) == {i for i, h in hits.items() if not h[4]} and len(after) < len(before)


def test_packing(tables):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary())
    rows = tables[5].collect()
    want = brute.pieces_of(texts(tables[4]), lambda t: library.encode(t, add_special_tokens=False).ids)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want


def test_run(spark, tables):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_lines_of_repeated_ids(spark):
    """Rows that share an id, null included, keep their own texts and lose their own lines."""
    line = "some line of more than ten words that comes again and again here"
    given = [(None, "first text of its own\n" + line), (None, "second text of its own\n" + line), (7, "third\n" + line), (7, "fourth"), (8, line)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    out = sorted((r["text"] for r in corpus_pipeline.line_dedup(spark, df, SMALL).collect()))
    # The document that is nothing but the line is emptied and goes.
    assert out == ["first text of its own", "fourth", "second text of its own", "third\n" + line]


def test_near_copies_of_repeated_ids(spark):
    """A row stays if its text is its own, whatever other rows of its id are; of repeated rows one stays."""
    text = " ".join(f"w{i}" for i in range(60))
    given = [(3, text), (1, text + " tail"), (3, "quite another text of more than five words"), (None, text), (4, text), (4, text)]
    df = spark.createDataFrame(given, "doc_id long, text string").withColumn("row", F.lit("x"))
    out = corpus_pipeline.minhash_near_dedup(spark, df, SMALL)
    assert out.columns == ["doc_id", "text", "row"]
    assert sorted((r["doc_id"], r["text"][:5]) for r in out.collect()) == [(1, "w0 w1"), (3, "quite")]


def test_line_texts_move_once(spark):
    """F1 of round 3: the last plan shuffled whole rows, their texts and the mended texts, all on disk at once."""
    line = "some line of more than ten words that comes again and again here"
    given = spark.createDataFrame([(i, f"text {i} of its own\n{line}", i) for i in range(20)], "doc_id long, text string, n_chars int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.line_dedup(spark, stored(given, "test"), SMALL)
        plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [b for b in plan.split("\n\n") if ") Exchange" in b.partition("\n")[0] and ("text#" in b or "left#" in b)]
    assert len(moved) == 1


def test_line_columns_as_they_are(spark):
    """Other columns, whatever their names and types, stay with their rows; only a changed text changes n_chars."""
    line = "some line of more than ten words that comes again and again here"
    given = [(1, [1, None], "a", f"first\n{line}", 5), (2, None, None, f"{line}\nsecond\n\n", 6), (3, [], "c", None, 7), (4, [4], "d", f"\n{line}\n ", 8), (5, [5], "e", "", None)]
    df = spark.createDataFrame(given, "doc_id int, hits array<int>, of string, text string, n_chars int").withColumns({"n_removed": F.lit(9), "given0": F.struct("of"), "none": F.lit("x")})
    out = corpus_pipeline.line_dedup(spark, df, SMALL)
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    want = [(1, [1, None], "a", f"first\n{line}", 5), (2, None, None, "second\n\n", 8), (3, [], "c", None, 7), (5, [5], "e", "", None)]
    assert sorted((*r[:5],) for r in out.collect()) == want
    assert all((r["n_removed"], r["given0"][0], r["none"]) == (9, r["of"], "x") for r in out.collect())
