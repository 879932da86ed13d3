"""Run a namespace job over landed captures.

    python -m gazette ecb-news --captures /shared/captures --out /shared/publications \\
        [--db /shared/db/publications.en] [--feeds /shared/feeds] [--as-of 2025-01-22T00:00:00]
    python -m gazette --job-file press.json --fetches /shared/fetch-log --out /shared/publications

``--captures`` is a parquet table ``(url, html, ...)``; ``--fetches`` a fetch
log ``(url, attempt, status, body)`` instead.  ``--job-file`` is a job as JSON.
On a cluster the session comes from spark-submit, which must also ship this
package to the workers (``--py-files gazette.zip``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from dataclasses import replace


def main(argv: list[str] | None = None) -> int:
    from gazette.plans.jobs import JOBS, job_from_dict, run_job

    p = argparse.ArgumentParser(prog="gazette")
    p.add_argument("job", nargs="?", choices=sorted(JOBS))
    p.add_argument("--job-file")
    p.add_argument("--captures")
    p.add_argument("--fetches")
    p.add_argument("--feeds")
    p.add_argument("--base-url")
    p.add_argument("--out", required=True)
    p.add_argument("--db")
    p.add_argument("--as-of", type=dt.datetime.fromisoformat)
    p.add_argument("--page-atomic", action="store_true")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--dedupe-on")
    args = p.parse_args(argv)
    if (args.job is None) == (args.job_file is None):
        p.error("name a job or give --job-file")
    if args.captures and args.fetches:
        p.error("give --captures or --fetches, not both")
    if args.job_file:
        with open(args.job_file, encoding="utf-8") as f:
            job = job_from_dict(json.load(f))
    else:
        job = JOBS[args.job]
    job = replace(
        job,
        base_url=args.base_url or job.base_url,
        page_atomic=args.page_atomic or job.page_atomic,
        strict=args.strict or job.strict,
        dedupe_on=args.dedupe_on or job.dedupe_on,
    )

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"gazette-{job.namespace}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    table = lambda path: spark.read.parquet(path) if path else None
    run_job(spark, job, table(args.captures), args.out, args.as_of, args.db, args.feeds, table(args.fetches))
    return 0


if __name__ == "__main__":
    sys.exit(main())
