"""Sinks: one table of candidates, published by namespace in whole runs.

A run is staged under a name of its own and then switched live by one new
marker file, so readers see either the former run or the new one, never a
mixture and never a hole::

    <table>/namespace=<ns>/run=<id>/...            candidates of a run
    <table>/_outcomes/namespace=<ns>/run=<id>/...  its outcome, published with it
    <table>/_live/namespace=<ns>/<version>-<id>    marker: the newest version is live

A marker is empty and its name says everything: creating one file is atomic on
local disks, HDFS and object stores, where overwriting or renaming a folder is
not.  A run that dies at any point before its marker leaves the former run as it
was; its staged files are never read and ``expire_runs`` removes them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLICATION_COLUMNS = (
    "regulator",
    "type",
    "web_title",
    "published_at",
    "web_url",
    "category",
    "ai_topic",
    "related_urls",
)


def tag_namespace(df: DataFrame, namespace: str) -> DataFrame:
    return df.withColumn("namespace", F.lit(namespace))


def union_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; duplicates across sources are kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


NAMESPACE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_MARKER = re.compile(r"([0-9]{20})-([0-9a-f]{32})")
CANDIDATES, OUTCOMES, _LIVE = "", "_outcomes/", "_live/"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and its Path class (any store Spark can write to)."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _hadoop(spark, folder)
    if not fs.exists(path(folder)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path(folder)))


def _folder(table: str, kind: str, namespace: str, run: str) -> str:
    return f"{table.rstrip('/')}/{kind}namespace={namespace}/run={run}"


def versions(spark: SparkSession, table: str, namespace: str) -> list[tuple[int, str]]:
    """(version, run) of a namespace's markers, oldest first."""
    found = (_MARKER.fullmatch(n) for n in _names(spark, f"{table.rstrip('/')}/{_LIVE}namespace={namespace}"))
    return [(int(m[1]), m[2]) for m in found if m]


def live_runs(spark: SparkSession, table: str, namespaces: Sequence[str] | None = None) -> dict[str, str]:
    """The live run of each namespace that was ever published."""
    if namespaces is None:
        names = _names(spark, f"{table.rstrip('/')}/{_LIVE}")
        namespaces = [n.removeprefix("namespace=") for n in names if n.startswith("namespace=")]
    found = {n: versions(spark, table, n) for n in namespaces}
    return {n: v[-1][1] for n, v in found.items() if v}


def read_live(
    spark: SparkSession,
    table: str,
    kind: str = CANDIDATES,
    runs: dict[str, str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """All rows of the live runs (or of ``runs``, resolved before, so that
    several reads see one state), with their ``namespace``.  ``merge_schema``
    also reads columns that only some namespaces have."""
    runs = live_runs(spark, table) if runs is None else runs
    if not runs:
        raise FileNotFoundError(f"nothing is published under {table}")
    folders = [_folder(table, kind, n, r) for n, r in sorted(runs.items())]
    base = f"{table.rstrip('/')}/{kind}".rstrip("/")
    reader = spark.read.option("basePath", base).option("mergeSchema", str(merge_schema).lower())
    return reader.parquet(*folders).drop("run")


def stage(df: DataFrame, table: str, namespace: str, run: str, kind: str = CANDIDATES) -> None:
    """Write one part of a run; nobody reads it before ``switch_live``."""
    df.drop("namespace", "run").write.parquet(_folder(table, kind, namespace, run))


def switch_live(spark: SparkSession, table: str, namespace: str, run: str) -> int:
    """Make a staged run the live one by creating its marker; returns its version."""
    former = versions(spark, table, namespace)
    version = former[-1][0] + 1 if former else 1
    # two writers may take one version: both markers stand, and all readers agree on the greater name
    marker = f"{table.rstrip('/')}/{_LIVE}namespace={namespace}/{version:020d}-{run}"
    fs, path = _hadoop(spark, marker)
    fs.create(path(marker), False).close()
    return version


def write_namespace(df: DataFrame, path: str, namespace: str, outcome: DataFrame | None = None) -> str:
    """Publish candidates with ``reasons``, and the run's outcome beside them,
    as the namespace's live run; ``status`` (valid / rejected) becomes a column.
    An empty frame publishes an empty namespace.  Returns the run's id."""
    if not NAMESPACE.fullmatch(namespace):
        raise ValueError(f"not a namespace: {namespace!r}")
    spark, run = df.sparkSession, uuid.uuid4().hex
    status = F.when(F.size("reasons") == 0, F.lit("valid")).otherwise(F.lit("rejected"))
    stage(df.withColumn("status", status), path, namespace, run)
    if outcome is not None:
        stage(outcome, path, namespace, run, OUTCOMES)
    switch_live(spark, path, namespace, run)
    return run


def expire_runs(spark: SparkSession, table: str, namespace: str, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
    """Delete what no reader needs: runs older than the newest ``keep`` versions,
    and staged runs without a marker that are older than ``grace_hours`` (a
    younger one may still be written).  Returns the deleted runs."""
    if keep < 1:
        raise ValueError("the live run must be kept")
    table = table.rstrip("/")
    known = versions(spark, table, namespace)
    kept = {r for _, r in known[-keep:]}
    marked = {r for _, r in known}
    oldest = spark._jvm.System.currentTimeMillis() - int(grace_hours * 3_600_000)
    fs, path = _hadoop(spark, table)
    gone = set()
    for kind in (CANDIDATES, OUTCOMES):
        folder = f"{table}/{kind}namespace={namespace}"
        for name in _names(spark, folder):
            run = name.removeprefix("run=")
            at = path(f"{folder}/{name}")
            if run in kept or (run not in marked and fs.getFileStatus(at).getModificationTime() > oldest):
                continue
            if fs.delete(at, True):
                gone.add(run)
    for version, run in known[:-keep]:  # markers last: a run with a marker always has its files
        fs.delete(path(f"{table}/{_LIVE}namespace={namespace}/{version:020d}-{run}"), False)
    return sorted(gone)
