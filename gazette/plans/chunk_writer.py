"""Writes rows in the chunk database's format, so that queries can read whole
tables back through its decoders."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import col, int_div
from gazette.sources.chunk_source import opened
from gazette.sources.chunkdb import write_index_rows


def json_value(c: Column | str) -> Column:
    """A column as raw JSON text (strings quoted and escaped, NULL → null)."""
    c = col(c)
    quoted = F.regexp_replace(F.to_json(F.array(c.cast("string"))), r"^\[|\]$", "")
    return F.when(c.isNull(), F.lit("null")).otherwise(quoted)


def encode_chunks(df: DataFrame, sort_id: str, raw_values: Sequence[Column], chunk_size: int) -> DataFrame:
    """Rows → ``(chunk_id, chunk)`` flat JSON arrays of ``chunk_size`` records
    in ``sort_id`` order.  Sort ids are dense from 0, as a record's id is its
    position; a gap inside a chunk raises.  Each group holds at most
    ``chunk_size`` records, so no group can grow with the data."""
    rec = F.concat_ws(",", *raw_values)
    keyed = df.select(
        int_div(sort_id, chunk_size).alias("chunk_id"),
        F.struct(F.col(sort_id).alias("sid"), rec.alias("rec")).alias("r"),
    )
    ordered = F.array_sort(F.collect_list("r"))
    text = F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda s: s["rec"]), ","), F.lit("]"))
    least, most, n = F.min("r.sid"), F.max("r.sid"), F.count(F.lit(1))
    dense = (least == F.col("chunk_id") * chunk_size) & (most - least + 1 == n)
    gap = F.raise_error(F.concat(F.lit("sort ids are not dense in chunk "), F.col("chunk_id").cast("string")))
    return keyed.groupBy("chunk_id").agg(F.when(dense, text).otherwise(gap.cast("string")).alias("chunk"))


def _files(root: str, group_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(root)
        for batch in batches:
            for chunk_id, chunk in zip(batch.column("chunk_id").to_pylist(), batch.column("chunk").to_pylist()):
                folder = f"{path}/data/{chunk_id // group_size}"
                fs.create_dir(folder)
                with fs.open_output_stream(f"{folder}/chunk_{chunk_id}.json") as f:  # a retry writes the same bytes
                    f.write(chunk.encode())
            yield pa.RecordBatch.from_arrays([batch.column("chunk_id")], ["chunk_id"])

    return run


def write_database(
    spark: SparkSession,
    chunks: DataFrame,
    root: str,
    header: Sequence[str],
    chunk_size: int,
    group_size: int,
    total: int,
    indexes: Mapping[str, DataFrame],
) -> str:
    """Chunks ``(chunk_id, chunk)`` and indexes (per key the rows of
    ``chunkdb.index_chunk_stats``) as a database under ``root``; the version
    list, which makes it readable, is written last."""
    version = f"{root.rstrip('/')}/1/{uuid.uuid4().hex}"
    chunks.mapInArrow(_files(version, group_size), "chunk_id bigint").agg(F.count(F.lit(1))).first()
    for key, stats in indexes.items():
        write_index_rows(stats, f"{version}/indexes/{key}/rows")
    meta = {
        "header": list(header),
        "indexes": list(indexes),
        "chunk_size": chunk_size,
        "chunk_group_size": group_size,
        "total_records": total,
    }
    _, number, name = version.rsplit("/", 2)
    for path, doc in ((f"{version}/metadata.json", meta), (f"{root.rstrip('/')}/versions.json", [{"version": number, "hash": name}])):
        fs, at = opened(path)
        fs.create_dir(at.rsplit("/", 1)[0])
        with fs.open_output_stream(at) as f:
            f.write(json.dumps(doc).encode())
    return root
