"""Landed web pages: scans and the JVM-side field extraction.

Two ways to get fields out of HTML:

* this module — Java regexes for flat fields (``<title>``, ``<h1>``, anchors).
  Stays inside whole-stage codegen, no Python; used on the hot path.
* ``sources.extract`` — structural selectors (cards, definition lists, nested
  lists) as column expressions over the nodes that one parser pass per page finds.

Both drop the ``html`` column as early as possible: only keys and extracted
fields ever reach a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import text as T
from gazette.functions.text import col

TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
H1_RE = r"(?is)<h1[^>]*>(.*?)</h1>"
# an anchor's href with its quotes, if any; other attributes may hold ">" in quotes.
# Every loop is possessive, so Java neither recurses nor turns back on long tags, and
# a name ends at "<", so a page of stray "<a" is read once.
HREF_RE = (
    r"""(?i)<a(?:\s++(?!href\s*+=)[^\s=<>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+)*+"""
    r"""\s++href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)"""
)
TAG_RE = r"<[^>]*>"
#: What a browser does not read as markup.
UNREAD_RE = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?</\1\s*>"


def element_text(html: Column | str, pattern: str) -> Column:
    """Text of the first element matched by ``pattern`` (tags removed,
    basic entities decoded, whitespace stripped); NULL when absent."""
    raw = F.regexp_extract(col(html), pattern, 1)
    return T.nullif_empty(T.strip_ws(T.unescape_basic(F.regexp_replace(raw, TAG_RE, ""))))


def page_title(html: Column | str) -> Column:
    return element_text(html, TITLE_RE)


def page_heading(html: Column | str) -> Column:
    return element_text(html, H1_RE)


def page_hrefs(html: Column | str) -> Column:
    """All anchor hrefs in document order (ARRAY<STRING>): any quotes or none,
    any case, entities decoded; not those in comments or scripts."""
    html = col(html)
    read = F.when(html.rlike("(?i)<(?:!--|script|style)"), F.regexp_replace(html, UNREAD_RE, " ")).otherwise(html)
    quoted = F.regexp_extract_all(read, F.lit(HREF_RE), 1)

    def bare(h: Column) -> Column:
        return F.when(h.startswith('"') | h.startswith("'"), F.substring(h, F.lit(2), F.length(h) - 2)).otherwise(h)

    return F.transform(quoted, lambda h: F.when(h.contains("&"), T.unescape_basic(bare(h))).otherwise(bare(h)))


def read_landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Raw captures landed as files → (url-like path, text) with invalid UTF-8
    repaired (U+FFFD), as a page scan would see them."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return raw.select(F.col("path").alias("url"), T.valid_utf8("content").alias("html"))
