"""The latest items of each link as a table that polls merge into.

A poll appends a *delta*: what it found, cut to what can still count.  A
reader merges the newest *base* with the deltas after it; ``compact`` writes that
merge as the next base.  So a poll writes what it found and never reads the
history, and a read costs one base and at most ``COMPACT_AFTER`` deltas.

Merging is associative: of each link only the newest capture counts, and of its
valid items the first ``per_link`` by publication time, so the best of the
parts' best are the best of all.  With ``accumulate`` every capture counts, for
sources that list each item once.

Deltas and bases go live by marker files as in ``sinks``; a marker's name holds
the poll's number, so a poll that is repeated after a failure counts once::

    <table>/run=<id>/...                      rows of a delta or base
    <table>/_live/<poll, 20 digits>-d-<id>    delta of that poll
    <table>/_live/<poll, 20 digits>-e-<id>    base of all polls up to that one
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.operators.sinks import _hadoop, _names

#: Deltas after which an append compacts.
COMPACT_AFTER = 16
_MARKER = re.compile(r"([0-9]{20})-([de])-([0-9a-f]{32})")


def merge(
    rows: DataFrame,
    link: str = "link",
    order: Sequence[Column] = (),
    per_link: int = K.PER_LINK_LATEST,
    captured: str | None = "captured_at",
    counts: Column | None = None,
) -> DataFrame:
    """Rows that can still count: those of each link's newest capture
    (``captured``; all captures if None), and of the ones for which ``counts``
    holds the first ``per_link`` in ``order``, which must be total.  Others, as
    rejects or the mark of an empty page, all stay.  A frequent link ships at
    most ``per_link`` of the rows that count from each task."""
    if captured is not None:
        when = F.struct(F.col(captured).isNotNull(), F.col(captured))
        newest = rows.groupBy(link).agg(F.max(when).alias("_newest")).withColumnRenamed(link, "_link")
        met = rows.join(newest, rows[link].eqNullSafe(newest["_link"]))
        rows = met.filter(when == F.col("_newest")).select(*rows.columns)
    counts = F.lit(True) if counts is None else F.coalesce(counts, F.lit(False))
    ranked = rows.filter(counts).withColumn("_rank", F.row_number().over(Window.partitionBy(link).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= per_link).drop("_rank").unionByName(rows.filter(~counts))


class LatestTable:
    """A table of latest items under ``path`` with the rules of ``merge``."""

    def __init__(self, spark: SparkSession, path: str, **rules) -> None:
        self.spark, self.path, self.rules = spark, path.rstrip("/"), rules

    def _markers(self) -> list[tuple[int, str, str]]:
        """(poll, kind, run) of all markers, oldest first; one delta and one base a poll."""
        found = {}
        for name in _names(self.spark, f"{self.path}/_live"):
            m = _MARKER.fullmatch(name)
            if m:
                found[int(m[1]), m[2]] = m[3]
        return [(*k, run) for k, run in sorted(found.items())]

    def live(self) -> list[str]:
        """Runs that make up the table: the newest base and the deltas after it."""
        markers = self._markers()
        base = max((i for i, (_, kind, _) in enumerate(markers) if kind == "e"), default=0)
        return [run for _, _, run in markers[base:]]

    def _read(self, runs: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/run={r}" for r in runs])

    def read(self) -> DataFrame | None:
        """The merged rows of all polls; None before the first."""
        runs = self.live()
        return merge(self._read(runs), **self.rules) if runs else None

    def polls(self) -> int:
        """Number of the last poll that is in the table; -1 before the first."""
        return max((poll for poll, _, _ in self._markers()), default=-1)

    def _add(self, rows: DataFrame, poll: int, kind: str) -> None:
        run = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/run={run}")
        marker = f"{self.path}/_live/{poll:020d}-{kind}-{run}"
        fs, path = _hadoop(self.spark, marker)
        fs.create(path(marker), False).close()

    def append(self, rows: DataFrame, poll: int) -> bool:
        """Add what a poll found; False if that poll is in the table already.
        Every ``COMPACT_AFTER`` deltas they become a base."""
        if poll <= self.polls():
            return False
        self._add(merge(rows, **self.rules), poll, "d")
        if len(self.live()) > COMPACT_AFTER:
            self.compact()
        return True

    def compact(self) -> None:
        """Write the merged rows as a base.  Readers of the former runs keep them until ``expire``."""
        rows, poll = self.read(), self.polls()
        if rows is not None:
            self._add(rows, poll, "e")

    def expire(self) -> list[str]:
        """Delete runs that the last two bases do not need; their markers go last."""
        markers = self._markers()
        bases = [i for i, (_, kind, _) in enumerate(markers) if kind == "e"]
        if len(bases) < 2:
            return []
        gone = markers[: bases[-2]]
        fs, path = _hadoop(self.spark, self.path)
        for _, _, run in gone:
            fs.delete(path(f"{self.path}/run={run}"), True)
        for poll, kind, run in gone:
            fs.delete(path(f"{self.path}/_live/{poll:020d}-{kind}-{run}"), False)
        return [run for _, _, run in gone]
