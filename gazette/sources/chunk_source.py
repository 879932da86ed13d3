"""The chunk database as a Spark data source, ``spark.read.format("chunkdb")``.

    read_chunkdb(spark, root, where={"type": ["18"]}, records=(0, 9_999))

Rows are the database's records: ``record_id``, ``chunk_id`` and each header field as raw JSON
text.  The conditions reach the source as options, so they are known while the
query is planned: values of an indexed key are looked up in the index, which names
their ranges of sort ids, bounds on the record id cut the chunk ids themselves,
and only the chunks that are left become partitions.  Reading drops the other
rows of those chunks.

The source takes no filters from the optimizer (``pushFilters``): Spark 4.1 keeps
the last filters pushed to a loaded relation for all its scans, so two queries
over one DataFrame would read each other's rows.  A DataFrame's own filters are
applied by Spark after the scan, and any number of queries may use it.

An index may be one document (``index.json``, as the site serves it) or rows
(``rows/bucket=<b>/*.json``, one line for each value and index chunk), of which
the planner reads only the value's bucket.  What planning holds is intervals of chunk ids,
adjoining ones merged, never a list of chunks or paths.

Files are opened with ``pyarrow.fs`` from the root's address, so the root may be
a local or mounted folder or any store that pyarrow knows.
"""

from __future__ import annotations

import io
import json
import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Chunks that one partition reads, at least; partitions of a scan, at most (larger scans read more chunks each).
CHUNKS_PER_PARTITION, MOST_PARTITIONS = 16, 100_000
#: Buckets of an index that is kept as rows.
INDEX_BUCKETS = 64
#: Records of a batch.
BATCH = 4096

Interval = tuple[int, int]  # first and last, both included


def index_bucket(value: str) -> int:
    return zlib.crc32(value.encode()) % INDEX_BUCKETS


def opened(address: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an address; Hadoop writes local ones as ``file:/x``."""
    if re.match(r"file:/[^/]", address):
        address = address.removeprefix("file:")
    return pafs.FileSystem.from_uri(address)


def file_bytes(address: str) -> bytes:
    fs, path = opened(address)
    with fs.open_input_stream(path) as f:
        return f.read()


def merged(intervals: list[Interval]) -> list[Interval]:
    """Sorted intervals, overlapping and adjoining ones united."""
    out: list[Interval] = []
    for lo, hi in sorted(i for i in intervals if i[0] <= i[1]):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def common(a: list[Interval], b: list[Interval]) -> list[Interval]:
    """Intersection of two sorted interval lists."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        lo, hi = max(a[i][0], b[j][0]), min(a[i][1], b[j][1])
        if lo <= hi:
            out.append((lo, hi))
        if a[i][1] < b[j][1]:
            i += 1
        else:
            j += 1
    return out


@dataclass
class ChunkRange(InputPartition):
    first: int
    last: int


def _elements(text: str) -> Iterator[str | None]:
    """Elements of a flat JSON array as raw text: strings unquoted, null as
    None, nested values compact."""
    decode = json.JSONDecoder().raw_decode
    blank = re.compile(r"[ \t\r\n]*")
    at = blank.match(text, 0).end()
    if text[at : at + 1] != "[":
        return
    at = blank.match(text, at + 1).end()
    while at < len(text) and text[at] != "]":
        value, end = decode(text, at)
        if value is None or isinstance(value, str):
            yield value
        elif isinstance(value, (list, dict)):
            yield json.dumps(value, ensure_ascii=False, separators=(",", ":"))
        else:
            yield text[at:end]
        at = blank.match(text, end).end()
        if text[at : at + 1] == ",":
            at = blank.match(text, at + 1).end()


class ChunkReader(DataSourceReader):
    """Chunks of one version of the database, cut down by conditions."""

    def __init__(self, root: str, meta: dict, fields: list[str], per_partition: int) -> None:
        self.root, self.fields, self.per_partition = root, fields, per_partition
        self.header, self.indexes = meta["header"], meta.get("indexes") or []
        self.size, self.group = int(meta["chunk_size"]), int(meta["chunk_group_size"])
        chunks = -(-int(meta["total_records"] or 0) // self.size)
        self.chunks: list[Interval] = [(0, chunks - 1)] if chunks else []
        self.wanted: dict[str, set[str]] = {}
        self.records: Interval = (0, 1 << 62)

    # -- planning -----------------------------------------------------------
    def keep_values(self, field: str, values: Sequence[str]) -> None:
        """Only records whose field has one of the values (raw text)."""
        if field not in self.header:
            raise ValueError(f"not in the header: {field}")
        self.wanted[field] = set(values)
        if field in self.indexes:
            self.chunks = common(self.chunks, self._of_values(field, self.wanted[field]))

    def keep_records(self, first: int, last: int) -> None:
        """Only records ``first`` to ``last``, both included."""
        self.records = (max(first, 0), last)
        self.chunks = common(self.chunks, merged([(max(first, 0) // self.size, last // self.size if last >= 0 else -1)]))

    def _of_values(self, key: str, values: set[str]) -> list[Interval]:
        """Chunks that may hold the values, by the index of their key."""
        ranges = [r for v in sorted(values) for r in self._ranges(key, v)]
        return merged([(lo // self.size, hi // self.size) for lo, hi in ranges])

    def _ranges(self, key: str, value: str) -> Iterator[Interval]:
        folder = f"{self.root}/indexes/{key}"
        fs, path = opened(f"{folder}/rows")
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            for entry in json.loads(file_bytes(f"{folder}/index.json")):
                if str(entry["value"]) == value:
                    yield from zip(entry["first_sort_id_per_chunk"], entry["last_sort_id_per_chunk"])
            return
        bucket = pafs.FileSelector(f"{path}/bucket={index_bucket(value)}", allow_not_found=True)
        for info in fs.get_file_info(bucket):
            if info.base_name.startswith(("_", ".")):
                continue
            with fs.open_input_stream(info.path) as f:
                for line in io.TextIOWrapper(f, encoding="utf-8"):
                    row = json.loads(line)
                    if row["value"] == value:
                        yield row["first_sort_id"], row["last_sort_id"]

    def partitions(self) -> list[ChunkRange]:
        total = sum(hi - lo + 1 for lo, hi in self.chunks)
        step = max(self.per_partition, -(-total // MOST_PARTITIONS))
        return [ChunkRange(at, min(at + step - 1, hi)) for lo, hi in self.chunks for at in range(lo, hi + 1, step)]

    # -- reading ------------------------------------------------------------
    def read(self, partition: ChunkRange) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no chunk is left
            return
        rows: list[tuple] = []
        for chunk in range(partition.first, partition.last + 1):
            for row in self._records(chunk):
                rows.append(row)
                if len(rows) == BATCH:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    def _records(self, chunk: int) -> Iterator[tuple]:
        text = file_bytes(f"{self.root}/data/{chunk // self.group}/chunk_{chunk}.json").decode("utf-8", "replace")
        flat, width = list(_elements(text)), len(self.header)
        places = [self.header.index(f) for f in self.fields]
        tests = [(self.header.index(f), values) for f, values in self.wanted.items()]
        for i in range(len(flat) // width):  # a trailing partial record is no record
            record_id = chunk * self.size + i
            if not self.records[0] <= record_id <= self.records[1]:
                continue
            if all(flat[i * width + p] in values for p, values in tests):
                yield (record_id, chunk, *(flat[i * width + p] for p in places))

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        types = [pa.int64(), pa.int64(), *[pa.string()] * len(self.fields)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["record_id", "chunk_id", *self.fields]
        )


class ChunkDatabase(DataSource):
    """Options: ``path`` (the database's root, or one version's folder),
    ``fields`` (comma-separated header fields; all without it), ``where`` (a
    JSON object, field → list of values), ``records`` (``first:last``),
    ``chunksPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return "chunkdb"

    def _meta(self) -> tuple[str, dict]:
        root = self.options["path"].rstrip("/")
        fs, path = opened(f"{root}/versions.json")
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            listed = json.loads(file_bytes(f"{root}/versions.json"))
            if not listed:
                raise ValueError(f"no version listed under {root}")
            root = f"{root}/{listed[0]['version']}/{listed[0]['hash']}"
        return root, json.loads(file_bytes(f"{root}/metadata.json"))

    def _fields(self, meta: dict) -> list[str]:
        chosen = self.options.get("fields")
        fields = [f.strip() for f in chosen.split(",")] if chosen else list(meta["header"])
        unknown = [f for f in fields if f not in meta["header"]]
        if unknown:
            raise ValueError(f"not in the header: {', '.join(unknown)}")
        return fields

    def schema(self) -> T.StructType:
        fields = self._fields(self._meta()[1])
        ids = [T.StructField(c, T.LongType()) for c in ("record_id", "chunk_id")]
        return T.StructType([*ids, *[T.StructField(f, T.StringType()) for f in fields]])

    def reader(self, schema: T.StructType) -> ChunkReader:
        root, meta = self._meta()
        per_partition = int(self.options.get("chunksPerPartition", CHUNKS_PER_PARTITION))
        reader = ChunkReader(root, meta, self._fields(meta), per_partition)
        for field, values in json.loads(self.options.get("where", "{}")).items():
            reader.keep_values(field, values)
        if "records" in self.options:
            reader.keep_records(*(int(x) for x in self.options["records"].split(":")))
        return reader


def read_chunkdb(
    spark: SparkSession,
    root: str,
    fields: Sequence[str] | None = None,
    where: Mapping[str, Sequence[str]] | None = None,
    records: tuple[int, int] | None = None,
) -> DataFrame:
    """The database's records, of all fields or of ``fields``: those whose fields
    have one of their values in ``where``, with ids ``records[0]`` to
    ``records[1]``.  A null field has no value."""
    spark.dataSource.register(ChunkDatabase)
    reader = spark.read.format("chunkdb").option("path", root)
    if fields:
        reader = reader.option("fields", ",".join(fields))
    if where:
        reader = reader.option("where", json.dumps({k: list(v) for k, v in where.items()}))
    if records:
        reader = reader.option("records", f"{records[0]}:{records[1]}")
    return reader.load()
