"""Format queries: RSS items, definition-list listings, CSV strings and raw
files — each built from a landed table and read back through the source
decoders, so the work grows with the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import dates as D
from gazette.functions import text as T
from gazette.functions import urls as U
from gazette.plans.registry import register
from gazette.sources import pages as P
from gazette.sources.tables import read_table

AS_OF = dt.datetime(2024, 1, 15)
SITE = "https://www.example.com"
DL_PAGE_ITEMS = 10  # items per listing page


@register
def q_rss_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page written as an RSS ``<item>`` (title, link, RFC-822
    date, enclosures — raw and resolved) and parsed back with the XML
    reader; entries → publication candidates with reasons."""
    from gazette.sources.feed import entries_to_candidates, parse_item

    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html").select(
        "page_id", "url", P.page_title("html").alias("title"), P.page_hrefs("html").alias("hrefs")
    )
    root = U.site_root("url")
    enclosure = F.transform(
        F.concat(F.col("hrefs"), F.transform("hrefs", lambda h: U.resolve_url(h, root))),
        lambda u: F.struct(u.alias("_url")),
    )
    pub_date = D.rss_format(F.timestamp_add("HOUR", F.col("page_id"), D.ntz_lit(dt.datetime(2024, 1, 1))))
    item = F.to_xml(
        F.struct(F.col("title"), F.col("url").alias("link"), pub_date.alias("pubDate"), enclosure.alias("enclosure")),
        {"rowTag": "item"},
    )
    entries = pages.select("page_id", parse_item(item).alias("e")).select("page_id", "e.*")
    cands = entries_to_candidates(entries, AS_OF)
    return cands.select(
        "page_id",
        "web_title",
        "web_url",
        "published_at",
        F.size("related_urls").cast("bigint").alias("n_enclosures"),
        (F.size("reasons") == 0).alias("is_valid"),
    )


def _dl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition-list listing pages: ten orders per customer page."""
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    fields = {
        "k": F.col("o_orderkey").cast("string"),
        "day": F.date_format("o_orderdate", "d MMMM yyyy"),
        "prio": F.col("o_orderpriority"),
    }

    def render(s):
        k = s["k"]
        return F.concat(
            F.lit("<dt>"), s["day"], F.lit('</dt><dd><a href="/orders/'), k, F.lit('.en.html">Order '), k,
            F.lit(" "), s["prio"], F.lit('</a><dl><dt>files</dt><dd><a href="/pdf/'), k,
            F.lit('.en.pdf?v=1">pdf</a> <a href="/pdf/'), k, F.lit('.de.pdf">de</a></dd></dl></dd>'),
        )

    wrap = ("<html><body><h1>Orders</h1><dl>", "</dl></body></html>")
    return _pages_of_ten(o, "o_custkey", "o_orderkey", fields, render, spark, wrap)


@register
def q_dl_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition-list listing pages (first ``dl``, direct dt/dd
    children zipped by position; nested lists ignored) → publications with
    English-only, query-stripped, de-duplicated related links."""
    from gazette.sources.extract import extract
    from gazette.sources.specs import DL_CHILDREN

    items = extract(_dl_pages(spark, sf_dir), DL_CHILDREN, keys=("o_custkey", "page_no"))
    root = F.lit(SITE)
    related = U.english_only(U.resolve_all("related", root), ".en.")
    out = items.filter(F.col("page_status") == "ok").withColumn("link_clean", T.strip_ws("link")).select(
        "o_custkey",
        "page_no",
        "item_pos",
        F.regexp_extract("link", r"/orders/([0-9]+)\.", 1).cast("bigint").alias("o_orderkey"),
        T.nfkc(T.strip_ws("title")).alias("web_title"),
        D.listing_date("date_text").alias("published_at"),
        U.resolve_url("link_clean", root).alias("web_url"),
        related.alias("related"),
    )
    return out.select(
        "o_custkey", "page_no", "item_pos", "o_orderkey", "web_title", "published_at", "web_url",
        F.size("related").cast("bigint").alias("n_related"),
        F.get("related", 0).alias("first_related"),
    )


_CSV = {"quote": '"', "escape": '"'}
_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@register
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows → one CSV string each → decoded with the same quoting."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    line = F.to_csv(F.struct(*part.columns), _CSV)
    return part.select(F.from_csv(line, _PART_SCHEMA, _CSV).alias("r")).select("r.*")


def _pages_of_ten(
    df: DataFrame,
    key: str,
    order: str,
    fields: dict,
    render,
    spark: SparkSession,
    wrap: tuple[str, str],
    items: int = DL_PAGE_ITEMS,
) -> DataFrame:
    """Rows → listing pages of ten (``items``) items per ``key`` (document order =
    ``order``) as ``(key, page_no, url, html)``.

    Only the raw ``fields`` cross the shuffle; ``render`` turns each item's
    struct into markup after the group-by.  In-key positions come from the
    skew-safe ordinal (a key holding a third of all rows is still numbered
    across many tasks); each page group holds at most ``items`` items."""
    from gazette.operators.select import ordinal_within

    ranked = ordinal_within(df, [key], order, order, out="rn")
    keyed = ranked.select(
        key,
        T.int_div(F.col("rn") - 1, items).alias("page_no"),
        F.struct(F.col("rn"), *[c.alias(name) for name, c in fields.items()]).alias("s"),
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list("s")), render), "")
    pages = keyed.groupBy(key, "page_no").agg(
        F.concat(F.lit(wrap[0]), body, F.lit(wrap[1])).alias("html")
    )
    return pages.select(
        key, "page_no", F.format_string(f"{SITE}/listing/%d/%d", F.col(key), F.col("page_no")).alias("url"), "html"
    )


_CARD_WRAP = (
    "<html><body><div id='main-content'><div><div><main><div>intro</div>"
    "<div><div><div><nav><ul>",
    "</ul></nav></div></div></div></main></div></div></div></body></html>",
)


@register
def q_card_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article-card listing pages (ten orders per customer page)
    through the card flow: link and title from the card, date from the URL
    when it carries one, else from the description; empty titles and
    undatable cards are rejected with their reasons."""
    from gazette.plans.publications import card_publications

    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    fields = {
        "href": F.when(
            k % 2 == 0,
            F.concat(F.lit("/en/press/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-order-"), ks, F.lit(".html")),
        ).otherwise(F.concat(F.lit("/en/press/order-"), ks, F.lit(".html"))),
        "title": F.when(k % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Order "), ks)),
        "desc": F.concat(
            F.when((k % 2 == 1) & (k % 5 == 0), F.lit("no date: ")).otherwise(
                F.concat(F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(": "))
            ),
            F.col("o_orderpriority"),
        ),
    }

    def render(s):
        return F.concat(
            F.lit('<li><div class="collection__item"><a class="teasable__link" href="'), s["href"],
            F.lit('"><div class="teasable__title teasable__title--marked"><div>'), s["title"],
            F.lit('</div></div><div class="teasable__text"><p>'), s["desc"], F.lit("</p></div></a></div></li>"),
        )

    pages = _pages_of_ten(o, "o_custkey", "o_orderkey", fields, render, spark, _CARD_WRAP).select("url", "html")
    cands = card_publications(pages, None, SITE, AS_OF)
    return cands.select(
        F.regexp_extract("listing_url", r"/listing/([0-9]+)/", 1).cast("bigint").alias("o_custkey"),
        F.regexp_extract("listing_url", r"/([0-9]+)$", 1).cast("bigint").alias("page_no"),
        "item_pos",
        F.regexp_extract("web_url", r"order-([0-9]+)\.html", 1).cast("bigint").alias("o_orderkey"),
        "web_title",
        "published_at",
        "web_url",
        F.array_join("reasons", ",").alias("reasons"),
    )


_SEARCH_WRAP = ("<html><body><ul class='results'>", "</ul></body></html>")


@register
def q_search_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result pages (ten events per user page) through the
    search flow: ``Date: d MMMM yyyy``, link, title and category per card; a
    card missing a part is rejected with the missing names."""
    from gazette.plans.publications import search_publications

    ev = read_table(spark, sf_dir, "events", "user_id", "event_id", "ts", "event_type")
    fields = {
        "id": F.col("event_id").cast("string"),
        "day": F.date_format("ts", "d MMMM yyyy"),
        "cat": F.when(F.col("event_type") != "error", F.col("event_type")),
    }

    def render(s):
        category = F.when(
            s["cat"].isNotNull(), F.concat(F.lit('<div class="mas-tag mas-tag__text">'), s["cat"], F.lit("</div>"))
        ).otherwise(F.lit(""))
        return F.concat(
            F.lit('<li class="mas-search-page__result"><div class="ts:xs">Date: '), s["day"],
            F.lit('</div><a class="mas-link mas-link--no-underline" href="/e/'), s["id"],
            F.lit('"><span class="mas-link__text">Event '), s["id"], F.lit("</span></a>"), category, F.lit("</li>"),
        )

    pages = _pages_of_ten(ev, "user_id", "event_id", fields, render, spark, _SEARCH_WRAP).select("url", "html")
    cands = search_publications(pages, None, SITE, "news", "MAS", dt.datetime(2024, 6, 1))
    return cands.select(
        F.regexp_extract("listing_url", r"/listing/([0-9]+)/", 1).cast("bigint").alias("user_id"),
        F.regexp_extract("listing_url", r"/([0-9]+)$", 1).cast("bigint").alias("page_no"),
        "item_pos",
        F.regexp_extract("web_url", r"/e/([0-9]+)$", 1).cast("bigint").alias("event_id"),
        "web_title",
        "published_at",
        "category",
        F.array_join("reasons", ",").alias("reasons"),
    )


_LINK_WRAP = (
    "<html><body><div id='main-content'><div><div><main><nav><ul>",
    "</ul></nav></main></div></div></div></body></html>",
)


@register
def q_related_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachment lists of detail pages (sixty line items of a supplier
    each) through the link-list flow: first link of each item, relative links
    resolved, items without a link skipped, order kept, cut at fifty."""
    from gazette.plans.publications import detail_links

    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber")
    li = li.withColumn("item", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    k = F.col("item")
    fields = {
        "a": F.when(k % 7 == 0, F.lit("none")).otherwise(
            F.concat(
                F.lit('<a href="'),
                F.when(k % 3 == 0, F.lit("https://files.example.net/")).otherwise(F.lit("/files/")),
                k.cast("string"),
                F.lit('.pdf">file</a> <a href="/second">other</a>'),
            )
        )
    }

    def render(s):
        return F.concat(F.lit("<li>"), s["a"], F.lit("</li>"))

    pages = _pages_of_ten(li, "l_suppkey", "item", fields, render, spark, _LINK_WRAP, items=60).select("url", "html")
    lists = detail_links(pages, SITE).select("detail_url", F.posexplode("related_urls").alias("pos0", "related_url"))
    return lists.select(
        F.regexp_extract("detail_url", r"/listing/([0-9]+)/", 1).cast("bigint").alias("l_suppkey"),
        F.regexp_extract("detail_url", r"/([0-9]+)$", 1).cast("bigint").alias("page_no"),
        (F.col("pos0") + 1).cast("bigint").alias("pos"),
        "related_url",
    )


@register
def q_related_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages of search results (ten orders of a customer each)
    through the related-cards flow: PDF links first, then links of related
    cards, order kept; other links are not taken."""
    from gazette.plans.publications import related_cards

    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderkey")
    fields = {"k": F.col("o_orderkey").cast("string"), "kind": F.col("o_orderkey") % 3}

    def render(s):
        card = F.concat(
            F.lit('<div class="box related-to-this-regulation-listing--result"><h1 class="mas-search-card__title"><a href="/r/'),
            s["k"], F.lit('">r</a></h1></div>'),
        )
        pdf = F.concat(F.lit('<p><a href="/f/'), s["k"], F.lit('.pdf?v=1">f</a></p>'))
        plain = F.concat(F.lit('<h1 class="mas-search-card__title"><a href="/n/'), s["k"], F.lit('">n</a></h1>'))
        return F.when(s["kind"] == 0, pdf).when(s["kind"] == 1, card).otherwise(plain)

    pages = _pages_of_ten(o, "o_custkey", "o_orderkey", fields, render, spark, ("<html><body>", "</body></html>"))
    cards = related_cards(pages.select("url", "html"), SITE).select(
        "detail_url", F.posexplode("related_urls").alias("pos0", "url")
    )
    return cards.select(
        F.regexp_extract("detail_url", r"/listing/([0-9]+)/", 1).cast("bigint").alias("o_custkey"),
        F.regexp_extract("detail_url", r"/([0-9]+)$", 1).cast("bigint").alias("page_no"),
        (F.col("pos0") + 1).cast("bigint").alias("pos"),
        "url",
    )


def _dl_rows(cands: DataFrame) -> DataFrame:
    return cands.select(
        F.regexp_extract("listing_url", r"/listing/([0-9]+)/", 1).cast("bigint").alias("o_custkey"),
        F.regexp_extract("listing_url", r"/([0-9]+)$", 1).cast("bigint").alias("page_no"),
        "item_pos",
        "web_title",
        "published_at",
        "web_url",
        F.array_join("reasons", ",").alias("reasons"),
    )


@register
def q_dl_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first listing form: every dt of the page with every dd, nested
    ones too; a nested pair has no date and is rejected for it."""
    from gazette.plans.publications import dl_publications
    from gazette.sources.specs import DL_DESCENDANTS

    pages = _dl_pages(spark, sf_dir).select("url", "html")
    return _dl_rows(dl_publications(pages, SITE, "news", "ECB", DL_DESCENDANTS, as_of=dt.datetime(2024, 6, 1)))


@register
def q_dl_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: pages that begin with a dt right in the body, without a list."""
    from gazette.plans.publications import dl_publications

    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    fields = {"k": F.col("o_orderkey").cast("string"), "day": F.date_format("o_orderdate", "d MMMM yyyy")}

    def render(s):
        return F.concat(
            F.lit("<dt>"), s["day"], F.lit('</dt><dd><a href="/orders/'), s["k"], F.lit('.en.html">Order '), s["k"],
            F.lit("</a></dd>"),
        )

    pages = _pages_of_ten(o, "o_custkey", "o_orderkey", fields, render, spark, ("<html><body>", "</body></html>"))
    return _dl_rows(dl_publications(pages.select("url", "html"), SITE, "news", "ECB", as_of=dt.datetime(2024, 6, 1)))
