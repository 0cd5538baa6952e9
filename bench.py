"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once as warm-up, then BENCH_RUNS times (median reported); results
are forced with the no-op sink (full execution, no driver collection) except
for small aggregates, which are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorewright.session import build_session  # noqa: E402
from scorewright.plans import catalog as Q  # noqa: E402

HEADLINE = ["feature_scan", "score_keys", "score_append", "band_summary", "score_join_compat",
            "duplicate_keys", "publish_weekly", "publish_current", "csv_roundtrip", "consult_age_auto"]
LONG = ["backfill_slim", "retention"]         # several hundred partitions each: one warm-up, one timed run


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf_dir)
    if name in ("band_summary", "band"):          # at most 16 rows
        df.collect()
    else:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE + LONG) if n in Q.QUERIES]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    rows = Q.QUERIES["feature_scan"](spark, sf_dir).count()
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(1 if name in LONG else runs)), 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "applications": rows, "cpus": int(cpus), "spark": spark.version,
                      "score_rows_per_sec": round(rows / timings["score_keys"], 1)
                      if "score_keys" in timings else None}))


if __name__ == "__main__":
    main()
