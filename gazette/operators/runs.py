"""Run-level operators: fetch-log resolution, snapshot selection, source
health, short listings, all-or-nothing listings and the run report.

Everything aggregates with map-side partial aggregation (``min_by``,
``count``, ``bool_and``), so a hot key is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions.text import col


def resolve_fetches(
    attempts: DataFrame,
    key: str = "url",
    attempt: str = "attempt",
    success: Column | None = None,
    body: str = "body",
    max_attempts: int = K.FEED_MAX_ATTEMPTS,
) -> DataFrame:
    """Fetch log ``(url, attempt, status, body)`` → per URL the body of the
    first successful attempt within ``max_attempts``, else status ``failed``."""
    ok = success if success is not None else (F.col("status") == 200)
    usable = ok & (F.col(attempt) <= max_attempts)
    agg = attempts.groupBy(key).agg(
        F.min(F.when(usable, F.col(attempt))).alias("attempt_used"),
        F.min_by(F.col(body), F.when(usable, F.col(attempt))).alias("body"),
        F.count(F.when(F.col(attempt) <= max_attempts, F.lit(1))).alias("attempts_seen"),
    )
    return agg.withColumn(
        "status", F.when(F.col("attempt_used").isNotNull(), F.lit("ok")).otherwise(F.lit("failed"))
    ).withColumn("body", F.when(F.col("attempt_used").isNotNull(), F.col("body")))


def snapshot_per_bucket(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, seconds: int = K.SNAPSHOT_MAX_AGE_SECONDS
) -> DataFrame:
    """First row per key and ``seconds``-bucket: what a time-salted memo would
    have returned for every call inside the bucket."""
    b = D.time_bucket(ts, seconds).alias("bucket")
    return (
        df.select(*keys, b, ts, tie, value)
        .groupBy(*keys, "bucket")
        .agg(F.min_by(F.col(value), F.struct(F.col(ts), F.col(tie))).alias(value))
    )


def source_health(df: DataFrame, expected: DataFrame, source: str, valid: Column) -> DataFrame:
    """Per expected source: rows, valid rows and a status (``empty``,
    ``no_valid`` or ``ok``); a source with no rows at all (an empty feed, a
    page without its list) is ``empty``.  Counts are aggregated before the
    join (one row per source)."""
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(valid).alias("n_valid"))
    joined = expected.select(source).distinct().join(counts, source, "left")
    return joined.select(
        source,
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_valid", F.lit(0)).alias("n_valid"),
    ).withColumn(
        "status",
        F.when(F.col("n_rows") == 0, F.lit("empty"))
        .when(F.col("n_valid") == 0, F.lit("no_valid"))
        .otherwise(F.lit("ok")),
    )


class UnhealthySource(RuntimeError):
    """A strict run met a source without a valid row."""


def require_healthy(health: DataFrame, source: str) -> None:
    """Raise for the first sources (by name) that are not ``ok``."""
    bad = health.filter(F.col("status") != "ok").orderBy(source).limit(10).collect()
    if bad:
        raise UnhealthySource("; ".join(f"{r[source]}: {r['status']}" for r in bad))


def listing_success() -> Column:
    """A listing capture counts if its status is OK and its body is not empty."""
    return (F.col("status") == 200) & (F.length(F.coalesce(F.col("body"), F.lit(""))) > 0)


def short_groups(df: DataFrame, key: str, min_rows: int = K.SHORT_PAGE_ROWS) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < min_rows)


def all_or_nothing(df: DataFrame, key: str, ok: Column) -> DataFrame:
    """Keep only groups whose every row is ok (one bad row loses the group).
    Aggregate + semi join instead of a whole-group window; AQE splits a
    skewed left side of the semi join."""
    good = df.groupBy(key).agg(F.bool_and(ok).alias("_all_ok")).filter("_all_ok").select(key)
    return df.join(good, key, "left_semi")


def run_report(df: DataFrame, keys: Sequence[str], error: Column | None = None, related: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if error is not None:
        aggs.append(F.count_if(error).alias("n_errors"))
    if related is not None:
        aggs.append(F.sum(F.size(col(related))).cast("bigint").alias("n_related"))
    return df.groupBy(*keys).agg(*aggs)
