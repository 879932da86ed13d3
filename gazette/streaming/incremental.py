"""Incremental runs: the batch transforms driven by a file stream.

The sources are polled captures (a cron job in the original setting).  Here
new captures land as files in a folder; a Structured Streaming query picks up
only files it has not seen (the checkpoint remembers them) and hands each
micro-batch to the same batch transform the batch jobs use.
``trigger(availableNow=True)`` processes everything pending and stops, so a
scheduler can run it like a batch job.

No capture is dropped for being late: every landing is transformed, its rows
carry the time of their capture, and ``read_latest`` shows the rows of the
latest capture of each page, as a batch run over all landings does.

Exactly-once output: each micro-batch is written to its own ``batch_id``
partition with dynamic partition overwrite, so a retried batch replaces its
own files instead of appending duplicates.  Checkpoints live under the
cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gazette.plans.publications import latest_captures
from gazette.session import checkpoint_dir

LANDED_PAGE_SCHEMA = "url string, html string, fetched_at timestamp"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landing_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: str = LANDED_PAGE_SCHEMA,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream (explicit schema, no
    inference)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_dir)


def feed_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New feed files as a stream of ``<item>`` rows, each tagged with its feed
    file; malformed items are rows too (``sources.feed.feed_entries``)."""
    from gazette.sources.feed import feed_entries

    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return feed_entries(reader.load(landing_dir).withColumn("path", F.input_file_name()))


def _write_batch(df: DataFrame, epoch_id: int, out_path: str, namespace: str) -> None:
    status = F.when(F.size("reasons") == 0, F.lit("valid")).otherwise(F.lit("rejected"))
    (
        df.withColumn("namespace", F.lit(namespace))
        .withColumn("status", status)
        .withColumn("batch_id", F.lit(epoch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", "namespace")
        .parquet(out_path)
    )


def run_incremental(
    spark: SparkSession,
    landing_dir: str | None,
    transform: Callable[[DataFrame], DataFrame],
    out_path: str,
    namespace: str,
    name: str,
    checkpoint: str | None = None,
    await_end: bool = True,
    stream: DataFrame | None = None,
) -> StreamingQuery:
    """Process every pending landed file once: stream → ``transform`` per
    micro-batch (the latest capture of each URL in it) → partitioned write.
    ``stream`` replaces the default page stream (e.g. ``feed_stream``)."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/gazette-incremental/{name}"
    if stream is None:
        stream = landing_stream(spark, landing_dir)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        if "fetched_at" in batch.columns:
            pages = latest_captures(batch)
            at = pages.select(F.col("url").alias("_url"), F.col("fetched_at").alias("captured_at"))
            rows = transform(pages.drop("fetched_at"))
            rows = rows.join(at, rows["listing_url"] == at["_url"], "left").drop("_url")
        else:
            rows = transform(batch).withColumn("captured_at", F.lit(None).cast("timestamp"))
        _write_batch(rows, epoch_id, out_path, namespace)

    query = (
        stream.writeStream.queryName(name)
        .foreachBatch(handle)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    if await_end:
        query.awaitTermination()
    return query


def read_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """All rows of the latest capture of each listing page (by capture time,
    then by micro-batch)."""
    rows = spark.read.parquet(out_path)
    when = F.struct(F.col("captured_at").isNotNull(), "captured_at", "batch_id")
    last = rows.groupBy("namespace", "listing_url").agg(F.max(when).alias("_last"))
    return (
        rows.join(last, ["namespace", "listing_url"])
        .filter(F.col("batch_id") == F.col("_last.batch_id"))
        .drop("_last")
    )
