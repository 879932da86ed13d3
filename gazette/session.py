"""Session construction and shared-storage locations.

Library code never invents a machine-local folder on a cluster: lineage cuts
and streaming checkpoints live under ``spark.checkpoint.dir`` as configured
by the cluster.  Only a local-mode session (tests, bench) without that setting
gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app: str = "gazette",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the session the
    platform hands you with AQE on and ``spark.sql.session.timeZone`` UTC
    (times are TIMESTAMP_NTZ, but formatting one passes through the zone)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # small local inputs shuffle well under AQE's default 1 MB minimum
        # partition, which would squeeze CPU-heavy stages (JSON/CSV decoding,
        # HTML extraction) onto one core; on a cluster the defaults apply
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", os.environ.get("GAZETTE_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the master is local (tests) a private folder is created and registered.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage the "
            "whole cluster can read"
        )
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    folder = tempfile.mkdtemp(prefix="gazette-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: evaluated once, however
    often it is used, and independent of the executors that computed it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/gazette-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
