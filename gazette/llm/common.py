"""Helpers that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.session import checkpoint_dir


def name_of(column: str) -> str:
    """A column name quoted for Spark, so that dots in it are not field access."""
    return "`" + column.replace("`", "``") + "`"


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage, fixes generated ids, and survives lost executors (the
    files do not live on them).
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for tables that nothing lazy reads any more."""
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, a query's shuffle files are deleted when it ends, not when the driver
    happens to collect garbage; for queries whose results are written or collected."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def hashed_joins(spark: SparkSession, mb: int) -> AbstractContextManager[None]:
    """Inside, joins whose shuffled partitions all turn out smaller than this need no sorts."""
    return setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", f"{mb}m")


@F.arrow_udf(T.BinaryType())
def ascii_lower(texts: pa.Array) -> pa.Array:
    """UTF-8 bytes with A-Z alone lower-cased; null reads as empty."""
    return pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.binary())


def fold(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def byte_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [b or b"" for b in column.to_pylist()]


#: Bytes that Spark hands to a Python worker at a time; texts may be long.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch hold many long texts (a session setting)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Rows that a task holds as Python objects at a time.
SLICE = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small slices, so that only few rows are Python objects
    at once; an empty batch stays one slice."""
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # workers outlive their tasks


def each(values: pa.Array, rows: int = SLICE) -> Iterator:
    """The values of an array as Python objects, few at a time."""
    for at in range(0, len(values), rows):
        yield from values.slice(at, rows).to_pylist()
    pa.default_memory_pool().release_unused()


def blocks(data: bytes, size: int = 1 << 20, overlap: int = 0) -> Iterator[np.ndarray]:
    """Consecutive byte blocks of a text; each begins ``overlap`` bytes early."""
    view = np.frombuffer(data, np.uint8)
    for at in range(0, max(len(view), 1), size):
        yield view[max(0, at - overlap) : at + size]


_BIGRAM_BUCKETS = 1024


def bigram_counts(data: bytes) -> np.ndarray:
    """Hashed byte-bigram counts of a whole text, block by block."""
    out = np.zeros(_BIGRAM_BUCKETS, np.int64)
    for block in blocks(data, overlap=1):
        if len(block) > 1:
            ids = (block[:-1].astype(np.uint16) * np.uint16(37) + block[1:]) & np.uint16(_BIGRAM_BUCKETS - 1)
            out += np.bincount(ids, minlength=_BIGRAM_BUCKETS)
    return out


#: Rows of a table that may be broadcast, and copies of a larger one that spread a frequent key.
SMALL_TABLE, SALTS = 100_000, 16


def look_up(rows: DataFrame, table: DataFrame, on: list[str], size: int) -> DataFrame:
    """Inner join with a table of ``size`` rows, whatever key is frequent in
    ``rows``: a small table is broadcast, a larger one is copied to salted keys."""
    if size <= SMALL_TABLE:
        return rows.join(F.broadcast(table), on)
    spread = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*[F.col(name_of(c)) for c in rows.columns]), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(spread, [*on, "salt"]).drop("salt")
