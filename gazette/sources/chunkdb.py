"""The chunked JSON publication database, landed as files.

Layout (as served remotely, copied into shared storage)::

    <root>/versions.json                              [{version, hash}, ...]
    <root>/<version>/<hash>/metadata.json             {header, indexes, chunk_size,
                                                       chunk_group_size, total_records}
    <root>/<version>/<hash>/indexes/<key>/index.json  [{value, total_records,
                                                       first_sort_id_per_chunk,
                                                       last_sort_id_per_chunk}]
    <root>/<version>/<hash>/data/<group>/chunk_<id>.json   flat JSON array

Data chunks are decoded as DataFrames: one text row per chunk file, the flat
array split into records of ``len(header)`` values with ``transform`` over a
``sequence`` and ``posexplode`` — no driver loop, no per-record Python.  Only
the metadata document (one small row) is read on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions import text as T
from gazette.functions import urls as U
from gazette.functions.text import col, int_div
from gazette.operators.select import global_ordinal
from gazette.sources.chunk_source import INDEX_BUCKETS, file_bytes

CHILD_FIELDS = 11  # id, timestamp, year, month, day, 4 unused, pdf list, metadata


# ---------------------------------------------------------------------------
# locator (S8)
# ---------------------------------------------------------------------------
def chunk_group(chunk_id: Column | str, group_size: int | Column) -> Column:
    gs = group_size if isinstance(group_size, Column) else F.lit(group_size)
    return int_div(col(chunk_id), gs)


def locate(
    kind: Column | str,
    db_root: str,
    version: Column | str,
    hash_: Column | str,
    key: Column | str | None = None,
    value_id: Column | str | None = None,
    item: Column | str | None = None,
    chunk_id: Column | str | None = None,
    group_size: int | None = None,
) -> Column:
    """URL (or path) of a database object; an unknown kind raises."""
    kind = col(kind)
    root = F.lit(db_root.rstrip("/") + "/")
    versioned = F.concat(root, col(version), F.lit("/"), col(hash_), F.lit("/"))
    null = F.lit(None).cast("string")
    key_c = col(key) if key is not None else null
    index_chunk = (
        F.concat(versioned, F.lit("indexes/"), key_c, F.lit("/"), col(value_id).cast("string"),
                 F.lit("/chunk_"), col(item).cast("string"), F.lit(".json"))
        if value_id is not None and item is not None
        else null
    )
    data = (
        F.concat(versioned, F.lit("data/"), chunk_group(chunk_id, group_size).cast("string"),
                 F.lit("/chunk_"), col(chunk_id).cast("string"), F.lit(".json"))
        if chunk_id is not None and group_size is not None
        else null
    )
    return (
        F.when(kind == "versions", F.concat(root, F.lit("versions.json")))
        .when(kind == "metadata", F.concat(versioned, F.lit("metadata.json")))
        .when(kind == "index", F.concat(versioned, F.lit("indexes/"), key_c, F.lit("/index.json")))
        .when(kind == "index_chunk", index_chunk)
        .when(kind == "data", data)
        .otherwise(F.raise_error(F.concat(F.lit("no such database object: "), kind)))
    )


# ---------------------------------------------------------------------------
# landed files
# ---------------------------------------------------------------------------
def _json_doc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))


def first_listed(doc: Column | str) -> Column:
    """First ``{version, hash}`` of a version document, by position; null if
    it lists none."""
    return F.get(F.from_json(col(doc), "array<struct<version:string,hash:string>>"), 0)


def first_version(spark: SparkSession, root: str) -> DataFrame:
    """The first listed version (position semantics, not the maximum)."""
    first = first_listed("doc")
    return _json_doc(spark, f"{root.rstrip('/')}/versions.json").select(
        first["version"].alias("version"), first["hash"].alias("hash")
    )


METADATA_SCHEMA = (
    "header array<string>, indexes array<string>, chunk_size bigint, "
    "chunk_group_size bigint, total_records bigint"
)


def read_metadata(spark: SparkSession, versioned_root: str) -> dict:
    """The metadata document (one small row; read on the driver)."""
    row = (
        _json_doc(spark, f"{versioned_root.rstrip('/')}/metadata.json")
        .select(F.from_json("doc", METADATA_SCHEMA).alias("m"))
        .select("m.*")
        .first()
    )
    if row is None or not row["header"]:
        raise ValueError(f"no usable metadata under {versioned_root}")
    return row.asDict()


INDEX_SCHEMA = (
    "array<struct<value:string,total_records:bigint,"
    "first_sort_id_per_chunk:array<bigint>,last_sort_id_per_chunk:array<bigint>>>"
)


def read_index(spark: SparkSession, versioned_root: str, key: str) -> DataFrame:
    """Index values of one key: position = ``index_value_id``."""
    return index_rows(_json_doc(spark, f"{versioned_root.rstrip('/')}/indexes/{key}/index.json"), key)


def index_rows(doc: DataFrame, key: str) -> DataFrame:
    """An index document ``(doc)`` as rows, one for each value."""
    return doc.select(F.posexplode(F.from_json("doc", INDEX_SCHEMA)).alias("index_value_id", "e")).select(
        F.lit(key).alias("index_key"),
        F.col("index_value_id").cast("bigint").alias("index_value_id"),
        F.col("e.value").alias("value"),
        F.col("e.total_records").alias("total_records"),
        F.col("e.first_sort_id_per_chunk").alias("first_sort_id_per_chunk"),
        F.col("e.last_sort_id_per_chunk").alias("last_sort_id_per_chunk"),
        F.size("e.first_sort_id_per_chunk").cast("bigint").alias("number_of_chunks"),
    )


INDEX_ROW_SCHEMA = "value string, index_chunk bigint, first_sort_id bigint, last_sort_id bigint, n_records bigint"


def write_index_rows(stats: DataFrame, path: str) -> None:
    """An index as rows: one JSON line for each value and index chunk
    (``index_chunk_stats``), dealt to buckets by the value, so that looking one
    value up reads one bucket and no index is ever one document."""
    bucket = F.pmod(F.crc32(F.col("value").cast("string").cast("binary")), F.lit(INDEX_BUCKETS)).cast("int")
    rows = stats.select(F.col("value").cast("string").alias("value"), "index_chunk", "first_sort_id", "last_sort_id", "n_records")
    rows.withColumn("bucket", bucket).write.partitionBy("bucket").json(path)


def read_index_rows(spark: SparkSession, path: str) -> DataFrame:
    """The lines of an index, as ``index_chunk_stats`` made them."""
    return spark.read.schema(f"{INDEX_ROW_SCHEMA}, bucket int").json(path).drop("bucket")


def index_values(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """An index's rows → one for each value: its position among the values
    (``index_value_id``), totals, and the first and last sort id.  Values are
    combined before the shuffle, and numbered by range, not in one task."""
    values = rows.groupBy("value").agg(
        F.sum("n_records").alias("total_records"),
        F.count(F.lit(1)).alias("number_of_chunks"),
        F.min("first_sort_id").alias("first_sort_id"),
        F.max("last_sort_id").alias("last_sort_id"),
    )
    return global_ordinal(spark, values, [F.col("value")], "index_value_id")


def read_data_chunks(spark: SparkSession, versioned_root: str) -> DataFrame:
    """All data chunk files → ``(chunk_id, chunk)``, the id taken from the
    file name."""
    df = spark.read.text(f"{versioned_root.rstrip('/')}/data/*/chunk_*.json", wholetext=True)
    return df.select(
        F.regexp_extract(F.input_file_name(), r"chunk_([0-9]+)\.json$", 1).cast("bigint").alias("chunk_id"),
        F.col("value").alias("chunk"),
    )


# ---------------------------------------------------------------------------
# decode (P10, W1, P11–P13)
# ---------------------------------------------------------------------------
def decode_chunks(
    chunks: DataFrame,
    header: Sequence[str],
    chunk_size: int,
    fields: Sequence[str] | None = None,
    chunk_col: str = "chunk",
    id_col: str = "chunk_id",
) -> DataFrame:
    """Flat chunk arrays → one row per complete record.

    Values stay raw JSON text (strings unquoted); a trailing partial record is
    dropped; ``record_id = chunk_id * chunk_size + position``.  Only the
    ``fields`` asked for are projected (column pruning inside the chunk).
    """
    width = len(header)
    wanted = list(fields) if fields is not None else list(header)
    # parse each chunk once: the array is a column before the lambda uses it
    # (an expression inside a lambda is evaluated per element)
    parsed = chunks.select(F.col(id_col), F.from_json(F.col(chunk_col), "array<string>").alias("_flat"))
    flat = F.col("_flat")
    n = int_div(F.size(flat), width).cast("int")
    records = F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * width + 1, width)),
    ).otherwise(F.array().cast("array<array<string>>"))
    exploded = parsed.select(F.col(id_col), F.posexplode(records).alias("idx", "vals"))
    return exploded.select(
        (F.col(id_col) * F.lit(chunk_size) + F.col("idx")).cast("bigint").alias("record_id"),
        *[F.get("vals", header.index(f)).alias(f) for f in wanted],
    )


def child_schema() -> str:
    return ", ".join(f"f{i} string" for i in range(CHILD_FIELDS))


_CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _child_record(x: Column) -> Column:
    """Parsed CSV row → the child struct (NULL when it has fewer than five
    fields).  A present field is never NULL: Spark's CSV reader turns an
    unquoted empty field into NULL, so presence comes from the field count
    and present fields read as ``""``.  Inner JSON quotes written as ``\\"``
    are restored before decoding; a bad list or map decodes as empty."""
    p, n = x["p"], x["n"]

    def field(i: int) -> Column:
        return F.when(n > i, F.coalesce(p[f"f{i}"], F.lit("")))

    pdfs = F.coalesce(F.from_json(T.unescape_json_quotes(field(9)), "array<string>"), F.array().cast("array<string>"))
    meta = F.coalesce(
        F.from_json(T.unescape_json_quotes(field(10)), "map<string,string>"),
        F.create_map().cast("map<string,string>"),
    )
    rec = F.struct(
        field(0).alias("publicationId"),
        field(1).alias("timestamp"),
        F.struct(field(2).alias("year"), field(3).alias("month"), field(4).alias("day")).alias("date"),
        pdfs.alias("pdfUrls"),
        meta.alias("metadata"),
    )
    return F.when(n >= 5, rec)


def _parse_child_csv(raw: Column) -> Column:
    """One CSV string → ``struct<p: parsed fields, n: field count>``; the
    count is the commas outside quoted sections plus one."""
    outside = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "")
    n = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    parsed = F.struct(F.from_csv(raw, child_schema(), _CSV_OPTIONS).alias("p"), n.alias("n"))
    return F.when(raw.isNotNull() & (raw != F.lit("")), parsed)


def decode_child(raw: Column | str) -> Column:
    """One child CSV string → ``struct<publicationId, timestamp, date{year,
    month, day}, pdfUrls, metadata>``; NULL when fields 0–4 are missing."""
    return F.transform(F.array(_parse_child_csv(col(raw))), lambda x: F.when(x.isNotNull(), _child_record(x)))[0]


def decode_children(raw_list: Column | str) -> Column:
    """A JSON list of child CSV strings → decoded children, failures and
    empty strings dropped.  Each CSV string is parsed once (inner
    ``transform``); the outer one only reads fields of the parsed struct."""
    arr = F.coalesce(F.from_json(col(raw_list), "array<string>"), F.array().cast("array<string>"))
    parsed = F.filter(F.transform(arr, _parse_child_csv), lambda x: x.isNotNull())
    return F.filter(F.transform(parsed, _child_record), lambda c: c.isNotNull())


NESTED_FIELDS = ("relatedPublications", "childrenPublication")


def decode_nested(records: DataFrame) -> DataFrame:
    """Records with the nested publication lists they carry decoded in place;
    all other fields stay raw."""
    return records.withColumns({f: decode_children(f) for f in NESTED_FIELDS if f in records.columns})


def db_type_code(update_type: str) -> int:
    return K.DB_TYPE_CODE_REGULATION if update_type == "regulation" else K.DB_TYPE_CODE_NEWS


def record_to_publication(records: DataFrame, base_url: str, update_type: str, regulator: str = "ECB") -> DataFrame:
    """Decoded records (raw JSON text per field) → publication rows."""
    base = F.lit(base_url)
    children = decode_children("childrenPublication")
    related = F.flatten(
        F.transform(children, lambda c: F.transform(c["pdfUrls"], lambda u: U.resolve_url(u, base)))
    )
    doc_types = F.from_json(F.col("documentTypes"), "array<string>")
    passthrough = [c for c in ("update_type",) if c in records.columns]
    # the first document link becomes a column before resolve_url reads it
    # (it references its input many times; a JSON parse must not repeat)
    records = records.withColumn("_doc0", F.get(doc_types, 0))
    return records.select(
        "record_id",
        *passthrough,
        F.lit(regulator).alias("regulator"),
        F.lit(update_type).alias("type"),
        T.nfkc(F.get_json_object("publicationProperties", "$.Title")).alias("web_title"),
        D.from_epoch_seconds(F.col("pub_timestamp").try_cast("bigint")).alias("published_at"),
        U.resolve_url("_doc0", base).alias("web_url"),
        F.coalesce(F.col("Taxonomy"), F.lit("")).alias("category"),
        F.lit(None).cast("string").alias("ai_topic"),
        related.alias("related_urls"),
    )


def latest_of_types(records: DataFrame, update_types: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` records of each update type's code, all types in one
    pass: the code → type map is a literal ``CASE``; the ranking plans a
    partial ``WindowGroupLimit`` (≤ n rows per type leave each map task)."""
    from gazette.operators.select import top_n_per_group

    code = F.col("type").try_cast("int")
    mapped = None
    for ut in update_types:
        cond = code == F.lit(db_type_code(ut))
        mapped = F.when(cond, F.lit(ut)) if mapped is None else mapped.when(cond, F.lit(ut))
    tagged = records.withColumn("update_type", mapped).filter(F.col("update_type").isNotNull())
    return top_n_per_group(tagged, ["update_type"], [F.col("record_id")], n, "_rank").drop("_rank")


def chunk_count(total: Column | str, chunk_size: Column | str) -> Column:
    """Chunks holding ``total`` records: ceiling (a short tail chunk counts)."""
    return int_div(col(total) + col(chunk_size) - 1, col(chunk_size))


# ---------------------------------------------------------------------------
# index pruning
# ---------------------------------------------------------------------------
def index_chunk_stats(df: DataFrame, key: str, sort_id: str, chunk_size: int) -> DataFrame:
    """Index of ``key``: per value, its sort ids cut into chunks of
    ``chunk_size`` → ``(value, index_chunk, first_sort_id, last_sort_id,
    n_records)``.  Positions come from the skew-safe ordinal, so a value
    holding a third of all rows is never numbered in one task."""
    from gazette.operators.select import ordinal_within

    ranked = ordinal_within(df.select(F.col(key).alias("value"), F.col(sort_id).alias("sid")), ["value"], "sid", "sid")
    return (
        ranked.withColumn("index_chunk", int_div(F.col("ordinal") - 1, chunk_size))
        .groupBy("value", "index_chunk")
        .agg(
            F.min("sid").alias("first_sort_id"),
            F.max("sid").alias("last_sort_id"),
            F.count(F.lit(1)).alias("n_records"),
        )
    )


#: Buckets that the chunk ids are cut into for the range join.
_RANGE_BUCKETS = 1024


def chunks_for_ranges(stats: DataFrame, chunks: DataFrame, chunk_size: int) -> DataFrame:
    """Ids of the chunks in a manifest ``(chunk_id)`` that index ranges
    (``first_sort_id``, ``last_sort_id``) touch.  An equi-join on buckets of
    the manifest's ids: a range meets at most ``_RANGE_BUCKETS`` + 1 of them,
    however wide it is."""
    last = chunks.agg(F.max("chunk_id")).first()[0]
    width = (0 if last is None else last) // _RANGE_BUCKETS + 1
    top = F.lit(0 if last is None else last).cast("bigint")
    ranges = stats.select(
        int_div("first_sort_id", chunk_size).alias("lo"),
        F.least(int_div("last_sort_id", chunk_size), top).alias("hi"),
    ).filter("lo <= hi")
    cut = ranges.select(
        "lo", "hi", F.explode(F.sequence(int_div("lo", width), int_div("hi", width))).alias("bucket")
    )
    ids = chunks.select("chunk_id", int_div("chunk_id", width).alias("bucket")).distinct()
    # a bucket that one range spans needs no other range
    reach = cut.groupBy("bucket", "lo").agg(F.max("hi").alias("hi"))
    return (
        ids.join(reach, "bucket")
        .filter((F.col("chunk_id") >= F.col("lo")) & (F.col("chunk_id") <= F.col("hi")))
        .select("chunk_id")
        .distinct()
    )


def leading_chunks(
    spark: SparkSession, versioned_root: str, meta: dict, codes: Sequence[int], n: int, key: str = "type"
) -> DataFrame | None:
    """Ids of the data chunks that can hold the first ``n`` records of each
    code, by the index of ``key``; None without such an index.  An index chunk
    names its first and last sort id, so the leading index chunks that hold
    ``n`` records bound them: at most n + 1 ranges of sort ids per code."""
    if key not in (meta.get("indexes") or []):
        return None
    size = int(meta["chunk_size"])
    index = read_index(spark, versioned_root, key).filter(F.col("value").isin([str(c) for c in codes]))
    cut = index.select("total_records", F.posexplode(F.arrays_zip("first_sort_id_per_chunk", "last_sort_id_per_chunk")).alias("item", "r"))
    leading = cut.filter(F.col("item") * size < n).select(
        F.col("r.first_sort_id_per_chunk").alias("first_sort_id"), F.col("r.last_sort_id_per_chunk").alias("last_sort_id")
    )
    total = meta.get("total_records") or 0
    chunks = spark.range(0, -(-int(total) // size)).withColumnRenamed("id", "chunk_id")
    return chunks_for_ranges(leading, chunks, size)


def read_chunk_rows(chunks: DataFrame, versioned_root: str, group_size: int) -> DataFrame:
    """``(chunk_id, chunk)`` of the chunks named by rows: each task opens the
    files of its own ids, so their paths never gather on the driver."""
    root = versioned_root.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk_id in batch.column("chunk_id").to_pylist():
                text = file_bytes(f"{root}/data/{chunk_id // group_size}/chunk_{chunk_id}.json").decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([chunk_id], pa.int64()), pa.array([text])], ["chunk_id", "chunk"])

    return chunks.select("chunk_id").mapInArrow(run, "chunk_id bigint, chunk string")
