"""Captures in buckets of their URL: nothing but the small side is shuffled."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from gazette.plans.publications import latest_captures
from gazette.sources import captures as CP

T0 = dt.datetime(2025, 1, 1)


@pytest.fixture()
def table(spark, scratch):
    name = f"captures_{uuid.uuid4().hex}"
    rows = spark.range(400).select(
        F.concat(F.lit("https://e.com/"), F.col("id") % 50).alias("url"),
        F.concat(F.lit("<title>v"), "id", F.lit("</title>")).alias("html"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(T0)).alias("fetched_at"),
    )
    yield CP.write_captures(rows, name, os.path.join(scratch, "t"), buckets=4)
    spark.sql(f"DROP TABLE {name}")


def exchanges_over_captures(df):
    """Exchanges whose input is the capture scan, from the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, open_exchanges = [], []
    for line in lines:
        open_exchanges = [(d, t) for d, t in open_exchanges if d < depth(line)]
        if "Exchange" in line:
            open_exchanges.append((depth(line), line))
        if "html" in line and "FileScan" in line:
            out += [t for _, t in open_exchanges]
    return out


def test_captures_stay_in_their_buckets(spark, table):
    links = spark.range(30).select(F.concat(F.lit("https://e.com/"), F.col("id")).alias("url"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the links were too many to broadcast
    try:
        wanted = CP.wanted_captures(table, links)
        newest = latest_captures(wanted)
        found = CP.lookup_captures(newest, links.withColumnRenamed("url", "link"), "link")
        for df in (wanted, newest, found):
            assert exchanges_over_captures(df) == []
        # the same on captures that are not bucketed does shuffle them
        plain = spark.createDataFrame(table.limit(5).collect(), table.schema)
        assert "Exchange" in latest_captures(plain)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert wanted.count() == 30 * 8
    assert {(r.link, r.detail_html) for r in found.collect()} == {
        (f"https://e.com/{i}", f"<title>v{350 + i}</title>") for i in range(30)
    }


def test_bucket_counts_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(CP, "BUCKET_BYTES", 1000)
    html = lambda n: spark.range(n).select(F.lit("u").alias("url"), F.repeat(F.lit("x"), 100).alias("html"))
    assert [CP.bucket_count(html(n)) for n in (0, 1, 10, 11, 45)] == [1, 1, 1, 2, 8]
