"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Protocol: one warm-up run, then the median of three timed runs per query;
each run forces the full result with the ``noop`` sink (no collect).
Prints ONE JSON line; the headline metric is the sum of the medians of the
headline queries, every query's median is under ``queries``.

    BENCH_SF_DIR=/root/testdata/sf0.01 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("q_page_publications", "q_type_topn", "q_chunk_decode", "q_lookup_enrich")


def _run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from gazette.plans.registry import all_queries
    from gazette.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    queries = all_queries()
    names = [n for n in queries if not argv or n in argv]
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        try:
            _run(queries[name](spark, sf_dir))  # warm-up
            runs = [_run(queries[name](spark, sf_dir)) for _ in range(repeats)]
            timings[name] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - reported, not hidden
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    headline = [timings[n] for n in HEADLINE if n in timings]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "headline_queries_total_median",
        "value": round(sum(headline), 4),
        "unit": "sec",
        "queries": timings,
        "all_queries_total": round(sum(timings.values()), 4),
        "headline": list(HEADLINE),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "protocol": f"1 warm-up + median of {repeats}, noop sink",
    }
    if failed:
        out["failed"] = failed
    spark.stop()
    print(json.dumps(out))
    return 0  # failures are reported inside the JSON line


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
