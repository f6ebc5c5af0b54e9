from pyspark.sql import functions as F

from tablewatch.operators import reconcile as r
from tests.conftest import SMALL


def test_checksum_invariant_under_repartition(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    a = r.checksum_agg(o).first()
    b = r.checksum_agg(o.repartition(7, "o_custkey").orderBy(F.rand(1))).first()
    assert a == b


def test_equal_rows_do_not_cancel(spark):
    """Rows a, a, b, b against c, c, d, d: every count is equal and XOR would be zero on both sides."""
    def rows(*v):
        return spark.createDataFrame([(x,) for x in v], "v string")

    a, b = rows("a", "a", "b", "b"), rows("c", "c", "d", "d")
    assert r.rec_row_checksum(a, b).first()["verdict"] == "FAILED"
    assert r.rec_table_fingerprint(a, b).first()["verdict"] == "FAILED"
    assert r.rec_row_checksum(a, rows("b", "a", "b", "a")).first()["verdict"] == "SUCCEEDED"
    suite = {x["check_name"]: x["verdict"] for x in r.rec_suite([r.TablePair("t", a, b)]).collect()}
    assert suite == {"row_count": "SUCCEEDED", "checksum": "FAILED"}
    assert r.rec_row_checksum(rows("a"), rows("a", "a")).first()["verdict"] == "FAILED"


def test_row_checksum_counts_distinct_and_duplicate_rows(spark):
    def rows(*v):
        return spark.createDataFrame([(x,) for x in v], "v string")

    got = r.rec_row_checksum(rows("a", "a", None, None, None, "b"), rows("a", "b")).first()
    assert (got["src_rows"], got["src_distinct_rows"], got["src_dup_rows"]) == (6, 3, 3)
    assert (got["dst_rows"], got["dst_distinct_rows"], got["dst_dup_rows"], got["verdict"]) == (2, 2, 0, "FAILED")
    none = r.rec_row_checksum(rows(), rows()).first()
    assert (none["src_rows"], none["src_distinct_rows"], none["src_dup_rows"], none["src_checksum"], none["verdict"]) == (0, 0, 0, 0, "SUCCEEDED")
    same = r.rec_row_checksum(rows("a", "a", "b"), rows("b", "a", "a")).first()
    assert same["verdict"] == "SUCCEEDED" and same["src_checksum"] == r.rec_table_fingerprint(rows("a", "a", "b"), rows("a")).first()["src_checksum"]


def test_sums_merge(spark):
    """The sums of two halves add up to those of the whole."""
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    whole, one, two = (r.checksum_agg(x).first() for x in (o, o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 3 <> 0")))
    assert all(whole[c] == one[c] + two[c] for c in ("rows", "sum1", "sum2"))


def test_suite_reads_each_side_once(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = r.rec_suite([r.TablePair("o", o, o.where("o_orderkey > 5"), ("o_totalprice",))])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Expand" not in plan


def test_differing_ranges(spark, tmp_path):
    """Only ranges that differ are found, and each level reads no other rows."""
    src = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    changed = {5, 4_321, 4_322, 19_999}
    dst = (src.withColumn("v", F.when(F.col("k").isin(*changed), -1).otherwise(F.col("v"))).where("k <> 12345")
           .union(spark.createDataFrame([(None, 1), (777, 1)], "k long, v long")))
    for name, df in (("src", src), ("dst", dst)):
        df.repartitionByRange(8, "k").write.parquet(f"{tmp_path}/{name}")
    src, dst = spark.read.parquet(f"{tmp_path}/src"), spark.read.parquet(f"{tmp_path}/dst")
    found = r.rec_differing_ranges(src, dst, "k", fanout=8, leaf=100).collect()
    want = {(k // 100) * 100 for k in changed | {12_345, 777}}
    assert {x["low"] for x in found} == want | {None}
    assert all(x["high"] - x["low"] == 99 and x["src_rows"] == 100 for x in found if x["low"] is not None)
    assert sorted(x["dst_rows"] for x in found) == [1, 99, 100, 100, 100, 101]
    part = r.in_ranges(dst, "k", [(x["low"], x["high"]) for x in found if x["low"] is not None])
    assert part.count() == 99 + 100 * 3 + 101 and "GreaterThanOrEqual(k,0)" in part._jdf.queryExecution().executedPlan().toString()
    diff = {(x["k"], x["column_name"]) for x in r.rec_located_diff(src, dst, "k", ["v"], 8, 100).collect()}
    assert diff == {(k, "v") for k in changed} | {(777, "v"), (777, "__rows")}
    assert r.rec_differing_ranges(src, src, "k", leaf=100).count() == 0
    assert r.rec_differing_ranges(src.limit(0), src.limit(0), "k").count() == 0
    assert [(x["low"], x["high"], x["dst_rows"]) for x in r.rec_differing_ranges(src.limit(0), spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("v")), "k").collect()] == [(0, 2, 3)]


def test_more_ranges_than_fit(spark, monkeypatch):
    """With more differing ranges than may be held, the last level that fits is the answer."""
    monkeypatch.setattr(r, "MOST_RANGES", 10)
    src = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    found = r.rec_differing_ranges(src, src.withColumn("v", F.lit(2)), "k", fanout=8, leaf=2).collect()
    assert 1 <= len(found) <= 10 and min(x["low"] for x in found) == 0 and max(x["high"] for x in found) == 999


def test_cursor_ties(spark, tmp_path):
    """A row that arrives late with the cached time is counted once, on the side that has it."""
    def at(*rows):
        return spark.createDataFrame([(k, f"2024-01-0{d}") for k, d in rows], "k long, day string").select("k", F.col("day").cast("timestamp_ntz").alias("at"))

    seed, path = "2024-01-01 00:00:00", f"{tmp_path}/state"

    def run(n, src, dst, overlap=0):
        x = r.reconcile_run(at(*src), at(*dst), "at", ["k"], "t", path, n, seed, overlap).first()
        return x["src_new_rows"], x["dst_new_rows"], x["count_verdict"], str(x["new_cursor"])[:10]

    first = [(1, 1), (2, 2), (3, 2)]
    assert run(0, first, first) == (3, 3, "SUCCEEDED", "2024-01-02")
    assert run(1, [*first, (4, 2)], first) == (1, 0, "FAILED", "2024-01-02")        # late, at the cursor
    assert run(1, [*first, (4, 2)], first) == (1, 0, "FAILED", "2024-01-02")        # the run again: the same
    assert run(2, [*first, (4, 2)], first) == (0, 0, "SUCCEEDED", "2024-01-02")     # not counted twice
    both = [*first, (4, 2), (5, 3), (5, 3)]
    assert run(3, both, [*both, (5, 3)]) == (2, 4, "FAILED", "2024-01-03")          # rows of one key count
    assert run(4, [*both, (6, 2)], [*both, (5, 3)]) == (0, 0, "SUCCEEDED", "2024-01-03")  # before the cursor: not read
    assert run(5, [*both, (6, 2), (7, 2)], [*both, (5, 3)], 86400)[0] >= 1           # an overlap reads it
    lost = r.rec_cursor_drift(at((1, 2), (2, 2)), at((1, 2)), "at", "2024-01-02 00:00:00", "t").first()
    assert (lost["src_new_rows"], lost["dst_new_rows"], lost["count_verdict"]) == (2, 1, "FAILED")


def test_diff_of_table_with_itself_is_empty(spark):
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    assert r.rec_row_diff(o, o, ["o_orderkey"]).count() == 0
    assert r.rec_missing_rows(o, o, ["o_orderkey"]).count() == 0


def test_row_diff_names_column_and_handles_duplicates(spark):
    src = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, s string, x double")
    dst = spark.createDataFrame([(1, "a", 1.0), (2, "B", 2.0), (3, "c", 3.0), (3, "c", 3.0)],
                                "k int, s string, x double")
    out = sorted((row["k"], row["column_name"]) for row in r.rec_row_diff(src, dst, ["k"]).collect())
    assert out == [(2, "s"), (3, "__rows"), (3, "s"), (3, "x")]


def test_missing_threshold_is_an_error(spark):
    o = spark.createDataFrame([(1,)], "k int")
    try:
        r.rec_row_count(o, o, error=None)
    except ValueError:
        return
    raise AssertionError("expected ValueError")
