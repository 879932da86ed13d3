"""RSS feeds: landed feed files (or a text column of feed items) → entries →
publication candidates with reasons.

A feed file is cut into its ``<item>`` texts by one expression, and Spark's XML
parser reads each text by itself with an explicit schema.  So a malformed item is
one reject, with its text; Spark's own file scan would give up the rest of the
file with it.  An empty feed is reported by the source-health report, never
raised from inside a task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import dates as D
from gazette.functions import text as T
from gazette.functions import urls as U
from gazette.functions.text import col
from gazette.operators import validate as V

ITEM_SCHEMA = (
    "title string, link string, pubDate string, description string, "
    "enclosure array<struct<_url:string>>"
)
ITEM_FIELDS = ("title", "link", "pubDate", "description", "enclosure")


#: An item up to its end, the next item or the end of the file; CDATA is passed over whole.
#: Possessive loops: no recursion and no turning back, however long an item is.
ITEM_RE = r"(?s)<item(?=[\s/>])(?:<!\[CDATA\[.*?\]\]>|(?!</item\s*>|(?!\A)<item[\s/>]).)*+(?:</item\s*>)?+"
_COMMENT_RE = r"(?s)<!--.*?-->"
_LATIN = r"(?i)^[^>]{0,100}?encoding\s*=\s*[\"'](?:iso-8859-1|latin-?1)[\"']"


def feed_text(content: Column | str) -> Column:
    """A feed file's bytes as text: Latin-1 if its declaration says so, else
    UTF-8 with invalid sequences repaired."""
    content = col(content)
    head = F.decode(F.substring(content, 1, 200), "ISO-8859-1")
    return F.when(head.rlike(_LATIN), F.decode(content, "ISO-8859-1")).otherwise(T.valid_utf8(content))


def feed_items(text: Column | str) -> Column:
    """The texts of a feed's items in their order (ARRAY<STRING>)."""
    text = col(text)
    read = F.when(text.contains("<!--"), F.regexp_replace(text, _COMMENT_RE, "")).otherwise(text)
    return F.regexp_extract_all(read, F.lit(ITEM_RE), 0)


def feed_entries(files: DataFrame) -> DataFrame:
    """Feed files ``(path, content)`` → one row for each item, tagged with its
    feed; a malformed one has no fields but its text in ``malformed``."""
    texts = files.select(F.col("path").alias("feed"), feed_text("content").alias("_text"))
    items = texts.select("feed", F.explode(feed_items("_text")).alias("_item"))
    return items.withColumn("_e", parse_item("_item")).select("_e.*", "feed")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Feed files → one row per ``<item>`` (see ``feed_entries``)."""
    return feed_entries(spark.read.format("binaryFile").load(path).withColumn("path", F.input_file_name()))


def parse_item(xml: Column | str) -> Column:
    """One ``<item>…</item>`` string → the item struct; of a malformed one only its text in ``malformed``."""
    parsed = F.from_xml(col(xml), f"{ITEM_SCHEMA}, malformed string", {"columnNameOfCorruptRecord": "malformed"})

    def whole(e: Column) -> Column:
        fields = [F.when(e["malformed"].isNull(), e[f]).alias(f) for f in ITEM_FIELDS]
        return F.struct(*fields, e["malformed"].alias("malformed"))

    return F.transform(F.array(parsed), whole)[0]


def entries_to_candidates(entries: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """Feed entries → ``(web_title, published_at, web_url, related_urls,
    reasons)``.  Required: title, link, pubDate.  A link without http(s) rejects
    the entry; an enclosure without it is only skipped.  A malformed item is
    rejected as such, with its text in ``malformed``."""
    entries = entries.withColumn("title", T.strip_ws("title"))
    title = T.nfkc("title")
    enclosures = F.coalesce(F.col("enclosure"), F.array().cast("array<struct<_url:string>>"))
    related = F.filter(F.transform(enclosures, lambda e: e["_url"]), lambda u: U.has_http_prefix(u))
    out = entries.select(
        *[c for c in entries.columns if c not in ("title", "link", "pubDate", "description", "enclosure")],
        title.alias("web_title"),
        D.parse_rss("pubDate").alias("published_at"),
        F.col("link").alias("web_url"),
        related.alias("related_urls"),
        V.missing_fields(title="title", link="link", published="pubDate").alias("_missing"),
        F.col("pubDate").alias("_pub_raw"),
        F.when(F.col("link").isNotNull() & ~U.has_http_prefix("link"), F.lit("invalid_link")).alias("_bad_link"),
    )
    bad_date = F.when(F.col("_pub_raw").isNotNull() & F.col("published_at").isNull(), F.lit("invalid_date"))
    parse_reasons = F.concat(F.col("_missing"), F.array_compact(F.array(bad_date, F.col("_bad_link"))))
    record_reasons = V.publication_reasons("web_title", "published_at", "web_url", "related_urls", as_of)
    reasons = F.when(F.size(parse_reasons) > 0, parse_reasons).otherwise(record_reasons)
    if "malformed" in entries.columns:
        reasons = F.when(F.col("malformed").isNotNull(), F.array(F.lit("malformed_item"))).otherwise(reasons)
    return out.withColumn("reasons", reasons).drop("_missing", "_pub_raw", "_bad_link")
