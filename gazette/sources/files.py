"""Landed files of linked documents: listing, kinds and contents.

A crawl's folder holds far more than a run wants.  So the scan lists files without
reading them, the wanted links meet that list, and only the files that are left are opened, for
their first bytes (the kind) or whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import col
from gazette.sources.chunk_source import opened

# FIXED VALUES: leading bytes (hexadecimal) of file kinds, as their formats define them.
MAGIC = (
    ("255044462D", "pdf"),
    ("504B0304", "zip"),
    ("89504E470D0A1A0A", "png"),
    ("FFD8FF", "jpeg"),
    ("47494638", "gif"),
    ("1F8B", "gzip"),
    ("D0CF11E0A1B11AE1", "ole"),
    ("7B5C727466", "rtf"),
)
#: Bytes of a file that its kind is told from.
HEAD = 64


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, name, length, modified)`` of the files under ``path`` that are not
    empty; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), "length", F.col("modificationTime").alias("modified"))


def linked_files(files: DataFrame, links: DataFrame, name: Column) -> DataFrame:
    """Links with the file that landed for each: ``path`` and ``length`` are null
    where none did.  ``name`` says what a link's file is called; of files of
    one name the last modified counts, then the greater path."""
    newest = F.max_by(F.struct("path", "length"), F.struct("modified", "path"))
    named = files.groupBy("name").agg(newest.alias("file"))
    met = links.withColumn("_name", name).join(named, F.col("_name") == F.col("name"), "left")
    return met.select(*links.columns, "file.path", "file.length")


def _contents(most: int | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column("path").to_pylist()):
                data = None
                if path is not None:
                    fs, at = opened(path)
                    with fs.open_input_stream(at) as f:
                        data = f.read() if most is None else f.read(most)
                row = [*batch.slice(i, 1).columns, pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(row, schema.types)], schema=schema)

    return run


def with_contents(rows: DataFrame, most: int | None = None, out: str = "content") -> DataFrame:
    """Rows with the bytes of the file at their ``path`` (the first ``most``, or
    all), one file a batch; null for a null path.  A file that vanished since it
    was listed fails the job, as it should."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.withColumn(out, F.lit(None).cast("binary")).schema
    return rows.mapInArrow(_contents(most, to_arrow_schema(schema)), schema)


def file_kind(head: Column | str) -> Column:
    """Kind of a file by its first bytes: one of ``MAGIC``, else ``html``,
    ``xml`` or ``text``, or ``binary`` if a zero byte is among them; null without bytes."""
    head = col(head)
    spelled = F.hex(head)
    kind = F.when(head.isNull(), F.lit(None).cast("string"))
    for magic, name in MAGIC:
        kind = kind.when(spelled.startswith(magic), F.lit(name))
    text = F.lower(F.ltrim(F.decode(head, "ISO-8859-1")))
    kind = kind.when(text.rlike(r"^(?:\u00ef\u00bb\u00bf)?\s*<(?:!doctype html|html)"), F.lit("html"))
    kind = kind.when(text.rlike(r"^(?:\u00ef\u00bb\u00bf)?\s*<\?xml"), F.lit("xml"))
    return kind.when(spelled.rlike("^(?:..)*?00"), F.lit("binary")).otherwise(F.lit("text"))
