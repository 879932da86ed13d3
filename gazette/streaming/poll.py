"""The poll of captured pages with state, and what it keeps.

Captures land as files.  A stream reads each file once; keyed state holds, for each
page, when its newest capture was taken and what it said (a hash).  A capture that
is newer goes on to the transform; one that is older than the state (it landed
late) or says the same is counted and goes no further, and a late capture of a page
that nobody saw before is as good as any: no watermark drops it.  State is a few
numbers a page, so it grows with the pages, not with the captures.

What the transform finds is merged into a ``LatestTable``.  A page's newest
capture replaces its former items, also if it lists nothing any more.

The stream's checkpoint and state live under ``spark.checkpoint.dir``.  A poll
that dies is repeated from the checkpoint; the table counts it once.  For many
pages set the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), which spills to disk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gazette import constants as K
from gazette.operators.latest import LatestTable
from gazette.operators.sinks import _names
from gazette.session import checkpoint_dir, written

class ForeignTable(ValueError):
    """A table that another checkpoint's polls are in: their numbers would be taken for these."""


def _start(spark: SparkSession, latest: LatestTable, name: str, checkpoint: str | None) -> str:
    folder = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/gazette-poll/{name}"
    if latest.polls() >= 0 and not _names(spark, f"{folder}/offsets"):
        raise ForeignTable(f"{latest.path} holds polls, but {folder} has read nothing yet")
    return folder


STATE = "at bigint, body bigint, captures bigint"
NEWEST = "url string, html string, at bigint, captures bigint"


def _newest(
    key: tuple[str | None], batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """The page's newest capture, if it is newer than the state and says something else."""
    known = state.get if state.exists else None
    best, seen = None, 0
    for batch in batches:
        seen += len(batch)
        for html, at, body in zip(batch["html"], batch["at"], batch["body"]):
            rank = (not pd.isna(at), 0 if pd.isna(at) else int(at), int(body))
            if best is None or rank > best[0]:
                best = (rank, html)
    (dated, at, body), html = best
    before = (False, 0, 0) if known is None else (known[0] is not None, known[0] or 0, known[1])
    captures = seen + (known[2] if known else 0)
    if known is not None and (dated, at, body) <= before:
        state.update((known[0], known[1], captures))
        return
    state.update((at if dated else None, body, captures))
    if known is None or body != known[1]:  # else the same page again: only its time moves on
        yield pd.DataFrame({"url": [key[0]], "html": [html], "at": pd.array([at if dated else None], "Int64"), "captures": [captures]})


def newest_captures(stream: DataFrame) -> DataFrame:
    """A stream of captures ``(url, html, fetched_at)`` → the pages whose newest
    capture changed, as ``NEWEST``.  A capture without a body is none."""
    keyed = stream.filter(F.col("html").isNotNull()).select(
        "url", "html", F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("at"), F.xxhash64("html").alias("body")
    )
    return keyed.groupBy("url").applyInPandasWithState(_newest, NEWEST, STATE, "update", GroupStateTimeout.NoTimeout)


def page_rules(per_link: int = K.PER_LINK_LATEST) -> dict:
    """How items of listing pages merge: the newest capture's, ten valid ones a page."""
    return {
        "link": "listing_url",
        "order": [F.col("published_at").desc_nulls_last(), F.col("item_pos").asc_nulls_last()],
        "per_link": per_link,
        "captured": "captured_at",
        "counts": (F.size("reasons") == 0) & ~F.col("page_mark"),
    }


def _items(pages: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The transform's rows with their capture time, and one mark row a page, so
    that a page without items replaces what it listed before."""
    at = pages.select(F.col("url").alias("_url"), F.timestamp_micros("at").alias("captured_at"))
    rows = transform(pages.select("url", "html"))
    rows = rows.join(at, rows["listing_url"].eqNullSafe(at["_url"]), "left").drop("_url").withColumn("page_mark", F.lit(False))
    marks = at.select(F.col("_url").alias("listing_url"), "captured_at", F.lit(True).alias("page_mark"))
    return rows.unionByName(marks, allowMissingColumns=True)


def poll_pages(
    spark: SparkSession,
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    name: str,
    checkpoint: str | None = None,
    per_link: int = K.PER_LINK_LATEST,
) -> LatestTable:
    """Process all captures that have landed since the last poll, then stop.

    ``transform`` maps pages ``(url, html)`` to candidates with ``listing_url``,
    ``item_pos``, ``published_at`` and ``reasons``.  Only pages whose content
    changed are parsed; of a page that was captured again unchanged, the items
    stand as they are."""
    latest = LatestTable(spark, table, **page_rules(per_link))
    folder = _start(spark, latest, name, checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        pages = written(spark, batch, f"poll-{name}")  # the state is read once
        latest.append(_items(pages, transform), epoch)

    query = (
        newest_captures(stream)
        .writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest


def poll_items(
    spark: SparkSession,
    stream: DataFrame,
    table: str,
    name: str,
    link: str,
    order: list[Column],
    checkpoint: str | None = None,
    per_link: int = K.PER_LINK_LATEST,
) -> LatestTable:
    """Items that each land once, kept as the first ``per_link`` of each link."""
    latest = LatestTable(spark, table, link=link, order=order, per_link=per_link, captured=None)
    folder = _start(spark, latest, name, checkpoint)
    query = (
        stream.writeStream.queryName(name)
        .foreachBatch(lambda batch, epoch: latest.append(batch, epoch) and None)
        .option("checkpointLocation", folder)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return latest


def latest_items(table: LatestTable) -> DataFrame | None:
    """The rows of pages without their marks; None before the first poll."""
    rows = table.read()
    return None if rows is None else rows.filter(~F.col("page_mark")).drop("page_mark")
