"""Captures kept in buckets of their URL.

At a hundred terabytes the captures are what a run must not move: they are
written once as a table bucketed and sorted by URL.  Then the restriction to wanted links,
the newest capture of each page and the lookup of detail pages all
find a URL's captures in one bucket, and only the other, small side is
shuffled to it.  ``jobs.run_job`` takes such a table like any other captures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of HTML of a bucket, about.
BUCKET_BYTES = 256 << 20


def bucket_count(captures: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` of HTML each, as a power of two, so that
    tables of different ages still line up."""
    size = captures.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()[0]
    buckets = 1
    while buckets * BUCKET_BYTES < size:
        buckets *= 2
    return buckets


def write_captures(captures: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """``captures(url, html, ...)`` as the table ``table`` under ``path``; each
    task holds whole buckets, so a bucket is one sorted file."""
    n = buckets or bucket_count(captures)
    dealt = captures.repartition(n, "url")
    dealt.write.bucketBy(n, "url").sortBy("url").option("path", path).mode("errorifexists").saveAsTable(table)
    return captures.sparkSession.table(table)


def wanted_captures(captures: DataFrame, links: DataFrame) -> DataFrame:
    """Captures of the URLs in ``links(url)``.  The links move, the captures stay."""
    return captures.join(links.select("url").distinct(), "url", "left_semi")


def lookup_captures(captures: DataFrame, items: DataFrame, url: str) -> DataFrame:
    """``items`` with the body of the page at their ``url`` column (null where
    none was captured); several items may share a page."""
    pages = captures.select(F.col("url").alias("_url"), F.col("html").alias("detail_html"))
    return items.join(pages, F.col(url) == F.col("_url"), "left").drop("_url")
