"""Chunk-database queries over the landed tables: the ``events`` table is
written in the database's chunk format and read back through the decoders,
so every step runs on the whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions.text import int_div
from gazette.operators.select import global_ordinal
from gazette.plans.registry import register
from gazette.plans import chunk_writer as W
from gazette.session import checkpoint_dir, written
from gazette.sources import chunkdb as C
from gazette.sources.chunk_source import read_chunkdb
from gazette.sources.tables import read_table

CHUNK_SIZE = 100
GROUP_SIZE = 10
DB_ROOT = "https://db.example.com/dbs/publications.en"
DB_VERSION, DB_HASH = "1", "0f0f"
ECB_BASE = dict((r[0], r[3]) for r in K.REGULATORS)["ECB"]

EVENT_HEADER = ["event_id", "pub_timestamp", "user_id", "type", "event_type", "props"]
RECORD_HEADER = [
    "type",
    "pub_timestamp",
    "publicationProperties",
    "documentTypes",
    "Taxonomy",
    "childrenPublication",
]


def _event_chunks(spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    if wanted is not None:
        ev = ev.join(wanted, int_div("event_id", CHUNK_SIZE) == wanted["chunk_id"], "left_semi")
    code = F.when(F.col("event_type") == "purchase", F.lit(K.DB_TYPE_CODE_REGULATION)).otherwise(
        F.lit(K.DB_TYPE_CODE_NEWS)
    )
    raw = [
        F.col("event_id").cast("string"),
        D.to_epoch_seconds("ts").cast("string"),
        F.col("user_id").cast("string"),
        code.cast("string"),
        W.json_value("event_type"),
        F.coalesce(F.col("props"), F.lit("null")),
    ]
    return W.encode_chunks(ev, "event_id", raw, CHUNK_SIZE)


@register
def q_chunk_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat chunks → records; id = chunk * size + position."""
    recs = C.decode_chunks(_event_chunks(spark, sf_dir), EVENT_HEADER, CHUNK_SIZE,
                           fields=["event_id", "user_id", "event_type", "props"])
    return recs.select(
        "record_id",
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        "event_type",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    )


def _type_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type")
    return C.index_chunk_stats(ev, "event_type", "event_id", CHUNK_SIZE)


@register
def q_index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of ``event_type`` — per value and index chunk, the first
    and last sort id and the record count."""
    return _type_index(spark, sf_dir).withColumnRenamed("value", "event_type")


@register
def q_index_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of ``event_type`` written as rows (one JSON line for each
    value and index chunk) and read back: positions of the values, totals,
    first and last sort ids."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/gazette-index-{uuid.uuid4().hex}"
    C.write_index_rows(_type_index(spark, sf_dir), folder)
    return C.index_values(spark, C.read_index_rows(spark, folder)).withColumnRenamed("value", "event_type")


PRUNE_BLOCK = 250  # records of one value of the clustered key
PRUNE_VALUE = 3


@register
def q_index_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a key that is clustered in storage order, read only the data
    chunks that the index ranges of one value touch, decode them and keep
    that value's records; ``n_chunks`` is how many were read."""
    ev = read_table(spark, sf_dir, "events", "event_id")
    block = int_div("event_id", PRUNE_BLOCK)
    index = C.index_chunk_stats(ev.select(block.alias("block"), "event_id"), "block", "event_id", CHUNK_SIZE)
    manifest = ev.select(int_div("event_id", CHUNK_SIZE).alias("chunk_id")).distinct()
    wanted = C.chunks_for_ranges(index.filter(F.col("value") == PRUNE_VALUE), manifest, CHUNK_SIZE)
    # the writer's rows are pruned too: no other chunk is built
    chunks = _event_chunks(spark, sf_dir, wanted)
    recs = C.decode_chunks(chunks, EVENT_HEADER, CHUNK_SIZE, fields=["event_id", "user_id", "event_type"])
    read = chunks.agg(F.count(F.lit(1)).alias("n_chunks"))
    kept = recs.withColumn("id", F.col("event_id").try_cast("bigint")).filter(int_div("id", PRUNE_BLOCK) == PRUNE_VALUE)
    return kept.select(
        "record_id",
        F.col("id").alias("event_id"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        read.scalar().alias("n_chunks"),
    )


PRUNE_HEADER = ["event_id", "user_id", "event_type", "block"]


def _clustered_database(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as a chunk database with indexes of ``block``, which is
    clustered in storage order, and ``event_type``, which is not."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    ev = ev.withColumn("block", int_div("event_id", PRUNE_BLOCK).cast("string"))
    raw = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), W.json_value("event_type"), W.json_value("block")]
    indexes = {k: C.index_chunk_stats(ev.select(k, "event_id"), k, "event_id", CHUNK_SIZE) for k in ("block", "event_type")}
    root = f"{checkpoint_dir(spark).rstrip('/')}/gazette-chunkdb-{uuid.uuid4().hex}"
    chunks = W.encode_chunks(ev, "event_id", raw, CHUNK_SIZE)
    return W.write_database(spark, chunks, root, PRUNE_HEADER, CHUNK_SIZE, GROUP_SIZE, ev.count(), indexes)


@register
def q_index_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` written as a chunk database and read through the source
    by a value of an indexed key: only the chunks that the index names for it
    are read (``n_chunks``)."""
    records = read_chunkdb(spark, _clustered_database(spark, sf_dir), where={"block": [str(PRUNE_VALUE)]})
    rows = written(spark, records, "pruned")
    return rows.select(
        "record_id",
        F.col("event_id").try_cast("bigint").alias("event_id"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        rows.agg(F.count_distinct("chunk_id").alias("n")).scalar().alias("n_chunks"),
    )


@register
def q_chunk_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version list, metadata, index and chunks of a database read
    by the source: two values of an index and a bound on the record id."""
    root, fields = _clustered_database(spark, sf_dir), ["event_id", "event_type"]
    last = read_chunkdb(spark, root, fields).agg(F.max("record_id")).first()[0]
    half = (-1 if last is None else last) // 2
    chosen = read_chunkdb(spark, root, fields, {"event_type": ["purchase", "error"]}, (0, half))
    return chosen.select("record_id", "chunk_id", F.col("event_id").try_cast("bigint").alias("event_id"), "event_type")


@register
def q_chunk_locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address of every data chunk (group = id div group size) and
    of every index chunk."""
    data = _event_chunks(spark, sf_dir).select(
        F.lit("data").alias("kind"),
        F.lit(None).cast("string").alias("key"),
        F.col("chunk_id").alias("item"),
        C.locate(F.lit("data"), DB_ROOT, F.lit(DB_VERSION), F.lit(DB_HASH), chunk_id="chunk_id",
                 group_size=GROUP_SIZE).alias("url"),
    )
    # index_value_id = position of the value in the key's index document
    stats = _type_index(spark, sf_dir)
    values = stats.select("value").distinct()
    value_ids = global_ordinal(spark, values, [F.col("value")], "value_id")
    idx = stats.join(value_ids, "value").select(
        F.lit("index_chunk").alias("kind"),
        F.col("value").alias("key"),
        F.col("index_chunk").alias("item"),
        C.locate(F.lit("index_chunk"), DB_ROOT, F.lit(DB_VERSION), F.lit(DB_HASH), key=F.lit("event_type"),
                 value_id="value_id", item="index_chunk").alias("url"),
    )
    return data.unionByName(idx)


@register
def q_chunk_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per value — records, chunks needed (ceiling; the banker's
    rounded count drops a short tail chunk and is shown for contrast) and
    the fetch bound ``least(requested, total)``."""
    ev = read_table(spark, sf_dir, "events", "event_type")
    tot = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("total_records"))
    size = F.lit(CHUNK_SIZE)
    return tot.select(
        "event_type",
        "total_records",
        C.chunk_count("total_records", size).alias("n_chunks"),
        F.bround(F.col("total_records") / size).cast("bigint").alias("n_chunks_rounded"),
        F.least(F.lit(K.DB_FETCH_REQUESTED).cast("bigint"), F.col("total_records")).alias("fetch_bound"),
    )


def _record_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events written as publication records (title, epoch, document link,
    taxonomy, child CSV strings carrying PDF lists)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    n_children = F.coalesce(k % 3, F.lit(0))
    sid = F.col("event_id").cast("string")
    epoch = D.to_epoch_seconds("ts").cast("string")

    def child(j):
        return F.concat(
            sid, F.lit(f"-{j},"), epoch, F.lit(","),
            F.date_format("ts", "yyyy"), F.lit(","), F.date_format("ts", "MM"), F.lit(","),
            F.date_format("ts", "dd"), F.lit(',a,b,c,d,"[\\""/pdf/'), sid, F.lit(f"-{j}.pdf"),
            F.lit('\\""]","{\\""k\\"":\\""'), F.coalesce(k.cast("string"), F.lit("")), F.lit('\\""}"'),
        )

    children = F.slice(F.array(child(1), child(2)), 1, n_children)
    raw = [
        F.when(F.col("event_type") == "purchase", F.lit(K.DB_TYPE_CODE_REGULATION))
        .otherwise(F.lit(K.DB_TYPE_CODE_NEWS)).cast("string"),
        D.to_epoch_seconds("ts").cast("string"),
        F.to_json(F.struct(F.concat(F.lit("Event "), sid, F.lit(" "), F.col("event_type")).alias("Title"))),
        F.to_json(F.array(F.concat(F.lit("/e/"), sid, F.lit(".html")))),
        W.json_value(F.when(F.col("event_type") != "error", F.col("event_type"))),
        F.to_json(children),
    ]
    return W.encode_chunks(ev, "event_id", raw, CHUNK_SIZE)


@register
def q_record_to_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database records → publications (title, epoch time,
    first document link resolved, taxonomy or "", children's PDFs flattened)."""
    recs = C.decode_chunks(_record_chunks(spark, sf_dir), RECORD_HEADER, CHUNK_SIZE)
    pubs = C.record_to_publication(recs, ECB_BASE, "regulation")
    return pubs.select(
        F.col("record_id").alias("event_id"),
        "web_title",
        "published_at",
        "web_url",
        "category",
        F.size("related_urls").cast("bigint").alias("n_related"),
        F.get("related_urls", 0).alias("first_related"),
    )


@register
def q_type_latest_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 records (storage order) of the type code each
    update type maps to (regulation → 18, news → 1)."""
    recs = C.decode_chunks(_record_chunks(spark, sf_dir), RECORD_HEADER, CHUNK_SIZE, fields=["type"])
    top = C.latest_of_types(recs, ["regulation", "news"], K.PER_LINK_LATEST)
    return top.select("update_type", F.col("record_id").alias("event_id"))


@register
def q_nested_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both nested lists of a record decoded; empty strings and short
    rows are dropped from either."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    key = F.col("p_partkey").cast("string")
    full = lambda prefix: F.concat(F.lit(prefix), key, F.lit(",1700000000,2024,05,15"))
    short = F.concat(F.lit("S"), key, F.lit(",1"))
    lists = part.select(
        "p_partkey",
        F.to_json(F.array(F.lit(""), short, full("R"))).alias("relatedPublications"),
        F.to_json(F.slice(F.array(full("C"), full("D"), short), 1, F.col("p_size") % 4)).alias("childrenPublication"),
    )
    rows = C.decode_nested(lists)
    return rows.select(
        "p_partkey",
        F.size("relatedPublications").cast("bigint").alias("n_related"),
        F.get("relatedPublications", 0)["publicationId"].alias("first_related"),
        F.size("childrenPublication").cast("bigint").alias("n_children"),
        F.get("childrenPublication", 0)["publicationId"].alias("first_child"),
    )


@register
def q_child_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child CSV strings inside a JSON list; short rows dropped,
    bad or missing JSON fields decode as empty, empty strings skipped."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    key = F.col("p_partkey").cast("string")
    head = F.concat(F.lit("P"), key, F.lit(",1700000000,2024,"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"),
                    F.lit(",15"))
    good_pdfs = F.concat(F.lit('"[\\""/pdf/'), key, F.lit('-a.pdf\\"",\\""/pdf/'), key, F.lit('-b.pdf\\""]"'))
    bad_pdfs = F.concat(F.lit('"[\\""/pdf/'), key, F.lit('-a.pdf"'))
    meta = F.concat(F.lit('"{\\""brand\\"":\\""'), F.col("p_brand"), F.lit('\\""}"'))
    case = F.col("p_size") % 4
    raw = (
        F.when(case == 0, F.concat(key, F.lit(","), F.col("p_size").cast("string")))
        .when(case == 1, F.concat_ws(",", head, F.lit("a,b,c,d"), bad_pdfs, meta))
        .when(case == 2, head)
        .otherwise(F.concat_ws(",", head, F.lit("a,b,c,d"), good_pdfs, meta))
    )
    lists = part.select("p_partkey", F.to_json(F.array(raw, F.lit(""))).alias("children"))
    kids = lists.select("p_partkey", F.explode(C.decode_children("children")).alias("c"))
    return kids.select(
        "p_partkey",
        F.col("c.publicationId").alias("pub_id"),
        F.col("c.date.year").alias("year"),
        F.col("c.date.month").alias("month"),
        F.col("c.date.day").alias("day"),
        F.size("c.pdfUrls").cast("bigint").alias("n_pdfs"),
        F.get("c.pdfUrls", 0).alias("first_pdf"),
        F.col("c.metadata")["brand"].alias("meta_brand"),
    )
