"""Queries over whole runs: publishing, polls with state, scans of landed files."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions import text as T
from gazette.functions import variant as J
from gazette.operators import sinks as S
from gazette.operators import validate as V
from gazette.plans.catalog import _doc_candidates
from gazette.plans.publications import latest_captures
from gazette.plans.registry import register
from gazette.session import checkpoint_dir, written
from gazette.sources import captures as CP
from gazette.sources import feed as FD
from gazette.sources import files as FL
from gazette.sources import pages as P
from gazette.sources.chunk_source import opened
from gazette.sources.tables import read_table
from gazette.streaming import poll as L
from gazette.streaming.incremental import landing_stream


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/gazette-{name}-{uuid.uuid4().hex}"


@register
def q_publish_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the candidates of two namespaces are published, one namespace is
    published again with half its rows, and both are read back by their live runs."""
    table = _folder(spark, "published")
    candidates = written(spark, _doc_candidates(spark, sf_dir).select("doc_id", "lang", "title", "reasons"), "candidates")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    S.write_namespace(candidates.filter(english), table, "english")
    S.write_namespace(candidates.filter(~english), table, "other")
    S.write_namespace(candidates.filter(english & (F.col("doc_id") % 2 == 0)), table, "english")
    rows = S.read_live(spark, table)
    return rows.select("namespace", "doc_id", "title", "status", F.size("reasons").cast("bigint").alias("n_reasons"))


def _landed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as captures of the users' pages: the page says which event it shows."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    title = F.concat(F.lit("Event "), F.col("event_id").cast("string"), F.lit(" "), "event_type")
    return ev.select(
        F.concat(F.lit("https://www.example.com/users/"), F.col("user_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><title>"), title, F.lit("</title></html>")).alias("html"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        (F.col("event_id") % 3).alias("landing"),
    )


@register
def q_poll_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.10: captures land in files that overlap in time; a poll reads some of
    them file by file, stops, and a second poll goes on from its checkpoint and
    state.  What is left is the newest capture of each page, late ones included."""
    landing, table, checkpoint = (_folder(spark, x) for x in ("landing", "latest", "poll"))

    def transform(pages: DataFrame) -> DataFrame:
        title = P.page_title("html")
        return pages.select(
            F.col("url").alias("listing_url"),
            F.lit(1).cast("bigint").alias("item_pos"),
            title.alias("web_title"),
            F.lit(None).cast("timestamp_ntz").alias("published_at"),
            F.array_compact(F.array(F.when(~V.title_ok(title), F.lit("title_length")))).alias("reasons"),
        )

    captures = _landed_captures(spark, sf_dir)
    for landings in ((1,), (0, 2)):
        some = captures.filter(F.col("landing").isin(*landings))
        some.repartition(len(landings), "landing").drop("landing").write.mode("append").parquet(landing)
        latest = L.poll_pages(spark, landing_stream(spark, landing, max_files_per_trigger=1), transform, table, "users", checkpoint)
    return L.latest_items(latest).select(
        "listing_url", "web_title", F.size("reasons").cast("bigint").alias("n_reasons")
    )


@register
def q_poll_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3/2.10: the ten latest items of each link, kept by polls: each poll adds
    what it found, cut to ten a link, and deltas are merged into bases."""
    landing, table, checkpoint = (_folder(spark, x) for x in ("landing", "latest", "poll"))
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint"
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").asc()]
    for half in (1, 0):
        some = ev.filter(F.col("event_id") % 2 == half).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id")
        some.repartition(3, "event_id").write.mode("append").parquet(landing)
        stream = landing_stream(spark, landing, schema, max_files_per_trigger=1)
        latest = L.poll_items(spark, stream, table, "items", "user_id", order, checkpoint)
    latest.compact()
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(*order))
    return latest.read().select("user_id", rank.cast("bigint").alias("rn"), "event_id").filter(F.col("rn") <= K.PER_LINK_LATEST)


# --------------------------------------------------------------------------
# landed files and free-form JSON
# --------------------------------------------------------------------------
def _land(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened(folder)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                fs.create_dir(f"{path}/{name[:2]}")
                with fs.open_output_stream(f"{path}/{name[:2]}/{name}") as f:  # a retry writes the same bytes
                    f.write(content)
            yield pa.RecordBatch.from_arrays([batch.column("name")], ["name"])

    return run


@register
def q_landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as files, a third with a PDF head and all
    with bytes that are no UTF-8.  Links to some of them, and to some that never
    landed, meet the listing; only those files are opened, for kind and repaired text."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    number = F.col("doc_id").cast("string")
    head = F.when(F.col("doc_id") % 3 == 0, F.lit("%PDF-1.4 ")).otherwise(F.lit("page "))
    content = F.concat(F.concat(head, F.coalesce("text", F.lit(""))).cast("binary"), F.unhex(F.lit("20E9FF20")))
    folder = _folder(spark, "files")
    named = docs.select(F.concat(F.lpad(number, 12, "0"), F.lit(".bin")).alias("name"), content.alias("content"))
    named.mapInArrow(_land(folder), "name string").agg(F.count(F.lit(1))).first()

    url = F.concat(F.lit("https://www.example.com/files/"), number, F.when(F.col("doc_id") % 2 == 0, F.lit("")).otherwise(F.lit("-gone")))
    links = docs.filter(F.col("doc_id") % 4 < 2).select("doc_id", url.alias("url"))
    linked = F.nullif(F.regexp_extract("url", "files/([0-9]+)$", 1), F.lit(""))
    name = F.concat(F.lpad(linked, 12, "0"), F.lit(".bin"))
    found = FL.linked_files(FL.list_files(spark, folder), links, name)
    text = T.valid_utf8("content")
    rows = FL.with_contents(found).withColumn("text", text)
    return rows.select(
        "doc_id",
        F.col("path").isNotNull().alias("found"),
        F.col("length").alias("n_bytes"),
        FL.file_kind(F.substring("content", 1, FL.HEAD)).alias("kind"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.right("text", F.lit(4)).alias("ending"),
    )


@register
def q_variant_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-form JSON parsed once as VARIANT and read by typed paths; the
    texts are ``events.props`` as they are, nested, cut short, as lists and as plain values."""
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "props")
    case = F.col("event_id") % 5
    props = (
        F.when(case == 0, F.col("props"))
        .when(case == 1, F.concat(F.lit('{"meta": '), "props", F.lit(', "tags": ["'), "event_type", F.lit('", 7]}')))
        .when(case == 2, F.expr("left(props, char_length(props) - 1)"))
        .when(case == 3, F.concat(F.lit("["), "props", F.lit(", null]")))
        .otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    )
    fields = {"k": (["$.k", "$.meta.k", "$[0].k"], "bigint"), "tag": ("$.tags[0]", "string"), "n": ("$.tags[1]", "bigint")}
    return J.decode(ev.select("event_id", props.alias("props")), "props", fields).drop("props")


@register
def q_feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files in which every seventh item is malformed (a wrong end
    tag, a bare ampersand, no end at all): the others are candidates as ever, the
    malformed ones rejects with their text."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", "url", P.page_title("html").alias("title"))
    pub_date = D.rss_format(F.timestamp_add("HOUR", F.col("page_id") % 300, D.ntz_lit(dt.datetime(2024, 1, 1))))
    guid = F.concat(F.lit("page-"), F.col("page_id").cast("string"))
    item = F.to_xml(
        F.struct(F.col("title"), guid.alias("guid"), F.col("url").alias("link"), pub_date.alias("pubDate")), {"rowTag": "item"}
    )
    broken = (
        F.when(F.col("page_id") % 3 == 0, F.replace(item, F.lit("</link>"), F.lit("</lnk>")))
        .when(F.col("page_id") % 3 == 1, F.replace(item, F.lit("</link>"), F.lit(" & more</link>")))
        .otherwise(F.replace(item, F.lit("</item>"), F.lit("")))
    )
    folder = _folder(spark, "feeds")
    pages.select(F.when(F.col("page_id") % 7 == 3, broken).otherwise(item).alias("value")).write.text(folder)
    rows = FD.entries_to_candidates(FD.read_feeds(spark, folder), dt.datetime(2024, 1, 20))
    return rows.select(
        F.col("web_url"),
        F.col("web_title"),
        F.array_join("reasons", ",").alias("reasons"),
        F.regexp_extract("malformed", "<guid>page-([0-9]+)</guid>", 1).try_cast("bigint").alias("malformed_page"),
    )


@register
def q_bucketed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2/2.10: captures of users' pages kept in buckets of their URL; the links
    of some users are restricted to them, and each item looks up the newest
    capture of its page.  No capture is shuffled after it is written."""
    name = f"captures_{uuid.uuid4().hex}"
    captures = _landed_captures(spark, sf_dir).drop("landing")
    table = CP.write_captures(captures, name, _folder(spark, "captures"), buckets=8)
    customers = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    url = F.concat(F.lit("https://www.example.com/users/"), F.col("c_custkey").cast("string"))
    items = customers.filter(F.col("c_nationkey") < 12).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), url.alias("link"))
    pages = latest_captures(CP.wanted_captures(table, items.select(F.col("link").alias("url"))))
    found = CP.lookup_captures(pages, items, "link")
    return found.select("c_custkey", P.page_title("detail_html").alias("web_title"))


@register
def q_field_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields read as their declared types; a missing value, one of
    another type and a good one are told apart."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value")
    number = F.col("event_id")
    raw = ev.select(
        "event_id",
        F.when(number % 7 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .when(number % 7 != 1, F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(number % 5 == 0, F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        F.when(number % 3 == 0, F.lit("n/a")).otherwise(F.lit("12.50")).alias("value"),
    )
    typed = V.typed_fields(raw, {"user_id": "bigint", "ts": "timestamp_ntz", "value": "decimal(10,2)"})
    reasons = F.concat(V.missing_fields(user_id="user_id"), F.col("reasons"))
    # a value of the wrong type is missing, too, but has its own reason
    own = F.filter(reasons, lambda r: ~(r.startswith("missing:") & F.array_contains(reasons, F.replace(r, F.lit("missing:"), F.lit("type:")))))
    return typed.select("event_id", "user_id", "ts", F.col("value").isNull().alias("no_value"), F.array_join(own, ",").alias("reasons"))
