"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then $BENCH_REPS times (default 3); the
median is reported. Results are forced with the ``noop`` sink, so the whole
plan executes without collecting rows to the driver. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewatch.plans import load_all  # noqa: E402
from tablewatch.session import get_spark  # noqa: E402

HEADLINE = [
    "suite_run", "profile_columns", "dq_referential", "dq_unique_composite", "dq_outlier_sigma",
    "rec_row_diff", "rec_row_checksum", "rec_missing_rows", "rec_suite",
    "c01_all_purpose_jobs", "c05_repeat_queries", "c09_job_failures", "findings_summary",
    "build_propagate", "overlapping_runs", "classify_failures", "dedupe_by_key", "lookback_rollup",
    "name_pairs", "jaccard_pairs", "doc_valid", "dangling_edges", "health_score",
    "profile_numeric", "pair_delta", "dup_sets", "chain_depth", "upstream_walk", "stream_incremental_count",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = get_spark(f"local[{cpus}]", int(cpus))
    queries, _ = load_all()
    names = only or HEADLINE
    timings = {}
    for name in names:
        print(f"bench: {name}", file=sys.stderr, flush=True)
        fn = queries[name]
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "reps": reps, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
