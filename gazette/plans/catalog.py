"""Registered queries over the landed tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of its SQL twin in ``plans.oracles``.  Every query reads
the whole tables it names; outputs are scalars (lists are exploded or
summarised) so an order-insensitive comparison is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import text as T
from gazette.functions import urls as U
from gazette.operators import validate as V
from gazette.sources import pages as P
from gazette.plans.registry import register
from gazette.sources.tables import read_table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages", "page_id", "url", "html")


def _page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages → (page_id, url, root, title, hrefs); ``html`` does not survive."""
    return _pages(spark, sf_dir).select(
        "page_id",
        "url",
        U.site_root("url").alias("root"),
        P.page_heading("html").alias("title"),
        P.page_hrefs("html").alias("hrefs"),
    )


def _resolved(df: DataFrame) -> DataFrame:
    return df.withColumn("related", U.resolve_all("hrefs", F.col("root")))


# --------------------------------------------------------------------------
# pages → publications (the flagship)
# --------------------------------------------------------------------------
@register
def q_page_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One publication per landed page: heading as title, the page URL,
    its language path segment, empty category, resolved related links and
    the validation verdict."""
    df = _resolved(_page_fields(spark, sf_dir))
    return df.select(
        "page_id",
        F.col("title").alias("web_title"),
        F.col("url").alias("web_url"),
        U.host("url").alias("host"),
        F.regexp_extract(U.path("url"), r"^/([A-Za-z]{2})/", 1).alias("lang"),
        F.lit("").alias("category"),
        F.size("related").cast("bigint").alias("n_related"),
        F.get("related", 0).alias("first_related"),
        V.title_ok("title").alias("title_ok"),
        U.is_valid_url("url").alias("url_ok"),
        V.related_ok("related").alias("related_ok"),
    ).withColumn("is_valid", F.col("title_ok") & F.col("url_ok") & F.col("related_ok"))


def _hrefs_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, root, pos, href) for every anchor, positions 1-based."""
    return _page_fields(spark, sf_dir).select(
        "page_id", "root", F.posexplode("hrefs").alias("pos0", "href")
    ).select("page_id", "root", (F.col("pos0") + 1).cast("bigint").alias("pos"), "href")


# --------------------------------------------------------------------------
# page scan / extraction / links
# --------------------------------------------------------------------------
@register
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's nodes, then every anchor with its position and text."""
    from gazette.sources.extract import extract
    from gazette.sources.specs import ANCHORS

    items = extract(_pages(spark, sf_dir), ANCHORS, keys=("page_id",))
    return items.filter(F.col("page_status") == "ok").select(
        "page_id",
        F.col("item_pos").alias("pos"),
        F.col("href"),
        F.col("text").alias("link_text"),
    )


@register
def q_first_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First match per element → first resolved link of each page."""
    df = _resolved(_page_fields(spark, sf_dir))
    return df.select("page_id", F.get("related", 0).alias("first_link"))


@register
def q_collect_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: links as rows, collected again per page in document order."""
    from gazette.plans.publications import ordered_list

    rows = _hrefs_exploded(spark, sf_dir).withColumn("clean", T.strip_ws("href"))
    rows = rows.select("page_id", "pos", U.resolve_url("clean", F.col("root")).alias("link"))
    df = ordered_list(rows.filter(U.is_valid_url("link")), "page_id", "pos", "link", "links")
    return df.select(
        "page_id",
        F.array_join("links", "|").alias("links"),
        F.size("links").cast("bigint").alias("n_links"),
    )


@register
def q_resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every href resolved against its page's site root."""
    df = _hrefs_exploded(spark, sf_dir).withColumn("clean", T.strip_ws("href"))
    return df.select("page_id", "pos", "href", U.resolve_url("clean", F.col("root")).alias("resolved_url"))


# FIXED VALUES: one href for each branch of reference resolution.
HREF_BRANCHES = (
    "https://other.example.org/x/../y", "//cdn.example.org/p?q#f", "/a/../b", "./c", "../up/d", "e/./f/../g", "?q=1",
    "#frag", "", "mailto:x@example.org", "/h//i", "/..", "j;p=1/../k", "HTTP://Upper.example.org/p", "/l.pdf?v=1#p2",
)


@register
def q_resolve_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of URL resolution, against the roots of the pages."""
    pages = _pages(spark, sf_dir).select("page_id", U.site_root("url").alias("root"))
    branch = F.element_at(F.array(*map(F.lit, HREF_BRANCHES)), (F.col("page_id") % len(HREF_BRANCHES) + 1).cast("int"))
    return pages.withColumn("href", branch).select(
        "page_id", "href", U.resolve_url("href", F.col("root")).alias("resolved_url")
    )


@register
def q_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheme, host, path, query, fragment of every page URL."""
    return _pages(spark, sf_dir).select(
        "page_id",
        U.scheme("url").alias("scheme"),
        U.netloc("url").alias("netloc"),
        U.path("url").alias("path"),
        U.query("url").alias("query"),
        U.fragment("url").alias("fragment"),
    )


@register
def q_url_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheme + host check on the page URL, the raw hrefs and the
    resolved links."""
    df = _resolved(_page_fields(spark, sf_dir))
    return df.select(
        "page_id",
        U.is_valid_url("url").alias("url_ok"),
        F.size(F.filter("hrefs", lambda h: U.is_valid_url(h))).cast("bigint").alias("n_valid_raw"),
        F.size(F.filter("related", lambda h: U.is_valid_url(h))).cast("bigint").alias("n_valid_resolved"),
    )


@register
def q_http_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """http(s) prefix on the link (rejects the row) and on attachments
    (only skipped): raw hrefs have none, resolved links all do."""
    df = _resolved(_page_fields(spark, sf_dir))
    return df.select(
        "page_id",
        U.has_http_prefix("url").alias("link_ok"),
        F.size(F.filter("hrefs", lambda h: U.has_http_prefix(h))).cast("bigint").alias("n_http_raw"),
        F.size(F.filter("related", lambda h: U.has_http_prefix(h))).cast("bigint").alias("n_http_resolved"),
    )


def _suffix_case() -> Column:
    """A path for each page, in turn: plain, upper case, in the query only, with parameters."""
    cases = ["/a.html", "/a.HTML?x=1", "/a?f=b.html", "/a.html;v=1#top"]
    return F.element_at(F.array(*map(F.lit, cases)), (F.col("page_id") % len(cases) + 1).cast("int"))


@register
def q_path_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 vs C4: path-suffix test (any case; query, fragment and parameters
    ignored) against a plain substring test, extension ``.html``, on the page
    URLs and on links where the two disagree."""
    pages = _pages(spark, sf_dir).withColumn("link", F.concat(U.site_root("url"), _suffix_case()))
    return pages.select(
        "page_id",
        U.path_ends_with("url", ".html").alias("path_ends_html"),
        F.col("url").contains(".html").alias("contains_html"),
        U.path_ends_with("link", ".html").alias("link_ends_html"),
        F.col("link").contains(".html").alias("link_contains_html"),
    )


@register
def q_english_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strip queries, keep English URLs, distinct per host
    (language marker of these sites: the ``/en/`` path segment)."""
    return (
        _pages(spark, sf_dir)
        .select(U.host("url").alias("host"), U.strip_query("url").alias("clean_url"))
        .filter(F.col("clean_url").contains("/en/"))
        .distinct()
    )


RELATED_CAP = 5  # the pages carry 4-6 links; 50 would never bind here


@register
def q_related_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: a related list passes when it has at most the cap and every
    item is a valid URL; one bad item rejects the row."""
    df = _resolved(_page_fields(spark, sf_dir))
    return df.select(
        "page_id",
        F.size("related").cast("bigint").alias("n_related"),
        F.forall("related", lambda u: U.is_valid_url(u)).alias("all_valid"),
        V.related_ok("related", RELATED_CAP).alias("related_ok"),
    )


@register
def q_manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table of links with their lazy-render flag (also links
    that no page answers) joined to the landed pages; pages without a link
    are not read further."""
    from gazette.plans.publications import manifest_join

    pages = _pages(spark, sf_dir).select("page_id", "url")
    listed = pages.filter(F.col("page_id") % 3 == 0).select("url", (F.col("page_id") % 2 == 0).alias("lazy"))
    gone = pages.filter(F.col("page_id") % 5 == 0).select(F.concat("url", F.lit("/gone")).alias("url"), F.lit(True).alias("lazy"))
    return manifest_join(pages, listed.unionByName(gone).distinct()).select("page_id", "url", "lazy")


# --------------------------------------------------------------------------
# documents / labels: text cleaning, validation, rejects, lookups, reports
# --------------------------------------------------------------------------
def _doc_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → (doc_id, lang, source, title, n_lines); the text column is
    consumed in the first projection."""
    return read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select(
        "doc_id",
        "lang",
        "source",
        T.nullif_empty(T.strip_ws(T.first_line("text"))).alias("title"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
    )


@register
def q_title_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title (first line, stripped) must have 3..500 characters."""
    df = _doc_titles(spark, sf_dir)
    return df.select(
        "doc_id",
        F.coalesce(F.length("title"), F.lit(0)).cast("bigint").alias("title_len"),
        V.title_ok("title").alias("title_ok"),
    )


@register
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strip, split-and-pick, lower, quote unescape (title line) and
    the stripped length of the whole text."""
    df = read_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        T.strip_ws(T.first_line("text")).alias("title"),
        F.length(T.strip_ws("text")).cast("bigint").alias("text_len"),
    )
    return df.select(
        "doc_id",
        "title",
        T.split_pick("title", " ", 1).alias("first_word"),
        T.split_pick("title", " ", 2).alias("second_word"),
        F.lower("title").alias("title_lower"),
        T.unescape_json_quotes("title").alias("title_unquoted"),
        "text_len",
    )


@register
def q_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles written in full-width forms normalise back to themselves;
    the ASCII names of parts pass through untouched."""
    ascii_marks = "".join(chr(c) for c in range(0x21, 0x7F))
    wide_marks = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    return part.select(
        "p_partkey",
        T.nfkc(F.translate("p_name", ascii_marks, wide_marks)).alias("name_nfkc"),
        T.nfkc(F.concat(F.col("p_type"), F.lit(" \u2460 \ufb01"))).alias("type_nfkc"),
        T.nfkc("p_name").alias("name_plain"),
    )


def _doc_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate rows: titles left-joined to their labels, with reasons."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    df = _doc_titles(spark, sf_dir).join(labels, "doc_id", "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("title").isNull(), F.lit("empty_title")),
            F.when(F.col("title").isNotNull() & ~V.title_ok("title"), F.lit("title_length")),
        )
    )
    return df.withColumn("reasons", F.concat(reasons, V.missing_fields(quality="quality")))


@register
def q_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate-and-split, then count rejects per reason."""
    rejects = V.reject_rows(_doc_candidates(spark, sf_dir), "source", "doc_id")
    return V.reason_summary(rejects)


@register
def q_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: per expected source — rows, valid rows and status; the sources of
    documents and, as feeds that brought nothing, the hosts of pages."""
    from gazette.operators.runs import source_health

    rows = _doc_candidates(spark, sf_dir)
    hosts = read_table(spark, sf_dir, "pages", "url").select(U.host("url").alias("source"))
    expected = rows.select("source").unionByName(hosts)
    return source_health(rows, expected, "source", F.size("reasons") == 0)


@register
def q_lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows left-joined to their detail rows, only where
    the gates hold (type gate: English; file gate: a third of the links are
    PDFs, written in several ways)."""
    from gazette.operators.enrich import gated_lookup

    links = F.array(*map(F.lit, ["/a.pdf", "/a.html", "/b.PDF?v=1", "/b?f=x.pdf", "/c", "/d.pdf.html"]))
    listing = read_table(spark, sf_dir, "documents", "doc_id", "lang").withColumn(
        "link", F.concat(F.lit("https://www.example.com"), F.element_at(links, (F.col("doc_id") % 6 + 1).cast("int")))
    )
    details = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").withColumnRenamed(
        "doc_id", "detail_id"
    )
    gate = (listing["lang"] == F.lit("en")) & ~U.path_ends_with(listing["link"], ".pdf")
    joined = gated_lookup(listing, details, [("doc_id", "detail_id")], gate)
    return joined.select(
        "doc_id", "lang", "quality", "toxic", F.col("detail_id").isNotNull().alias("enriched")
    )


@register
def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/A1: counts per source and language — rows, errors, related items."""
    from gazette.operators.runs import run_report

    df = _doc_titles(spark, sf_dir).withColumn("lines", F.sequence(F.lit(1), F.col("n_lines").cast("int")))
    return run_report(df, ["source", "lang"], ~V.title_ok("title"), "lines")


@register
def q_flatten_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlated flatten — each record's children (lines) each carry a
    list (their words); the record's related list is all of them in order."""
    from gazette.operators.enrich import flatten_children

    df = read_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        F.transform(
            F.split("text", "\n"),
            lambda line: F.struct(F.filter(F.split(line, " "), lambda w: w != F.lit("")).alias("words")),
        ).alias("children"),
    )
    flat = flatten_children("children", "words")
    return df.select(
        "doc_id",
        F.size("children").cast("bigint").alias("n_children"),
        F.size(flat).cast("bigint").alias("n_flat"),
        F.get(flat, 0).alias("first_flat"),
        F.get(flat, F.size(flat) - 1).alias("last_flat"),
    )


@register
def q_union_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources tagged with their namespace, UNION ALL by name
    (duplicates kept), counted per namespace."""
    from gazette.operators.sinks import union_sources

    ev = read_table(spark, sf_dir, "events", "event_id", "event_type").select(
        F.concat(F.lit("events-"), F.col("event_type")).alias("namespace"), F.col("event_id").alias("key")
    )
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang").select(
        F.concat(F.lit("documents-"), F.col("lang")).alias("namespace"), F.col("doc_id").alias("key")
    )
    return union_sources(ev, docs).groupBy("namespace").agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------
# conversations: short listings, all-or-nothing, positional zip
# --------------------------------------------------------------------------
@register
def q_short_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings (a customer's orders) with fewer than 10 rows."""
    from gazette.operators.runs import short_groups

    return short_groups(read_table(spark, sf_dir, "orders", "o_custkey"), "o_custkey")


@register
def q_page_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bad row loses its whole group (non-empty text, known role)."""
    from gazette.operators.runs import all_or_nothing

    df = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    ok = (F.coalesce(F.length(T.strip_ws("text")), F.lit(0)) > 0) & F.col("role").isin("user", "assistant")
    return all_or_nothing(df.select("conv_id", "turn", ok.alias("ok")), "conv_id", F.col("ok")).select(
        "conv_id", "turn"
    )


@register
def q_zip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-th user turn with the n-th assistant turn of each
    conversation, stopping at the shorter side."""
    from gazette.operators.select import zip_pairs

    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    users = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("turn").alias("user_turn"))
    bots = conv.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("turn").alias("assistant_turn")
    )
    pairs = zip_pairs(users, bots, ["conv_id"], "turn", "turn")
    return pairs.select("conv_id", "pair_idx", "user_turn", "assistant_turn")


# --------------------------------------------------------------------------
# events: top-N, latest per link, JSON, epoch, snapshots, fetch logs, bounds
# --------------------------------------------------------------------------
def _events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", *cols)


@register
def q_type_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the 10 newest records per type (total order: ts, then id)."""
    from gazette.operators.select import top_n_per_group

    ev = _events(spark, sf_dir, "event_type", "event_id", "ts")
    top = top_n_per_group(ev, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()], 10, "rn")
    return top.select("event_type", F.col("rn").cast("bigint").alias("rn"), "event_id", "ts")


@register
def q_latest_per_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: ten latest items per listing link (here: per user)."""
    from gazette.operators.select import latest_per_link

    ev = _events(spark, sf_dir, "user_id", "event_id", "ts")
    top = latest_per_link(ev, "user_id", "ts", "event_id")
    return top.select("user_id", F.col("rank").cast("bigint").alias("rn"), "event_id")


@register
def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON field of a string column; malformed → NULL."""
    ev = _events(spark, sf_dir, "event_id", "props")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@register
def q_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time → epoch seconds → time (zone independent)."""
    from gazette.functions import dates as D

    ev = _events(spark, sf_dir, "event_id", "ts").select("event_id", D.to_epoch_seconds("ts").alias("epoch_s"))
    return ev.select("event_id", "epoch_s", D.from_epoch_seconds("epoch_s").alias("ts_back"))


@register
def q_time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record per key in each 5-minute bucket — what a
    5-minute memo returns for every call in the bucket."""
    from gazette.operators.runs import snapshot_per_bucket

    ev = _events(spark, sf_dir, "user_id", "ts", "event_id")
    return snapshot_per_bucket(ev.withColumn("first_event", F.col("event_id")), ["user_id"], "ts", "event_id", "first_event")


@register
def q_fetch_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fetch log (attempts in time order per URL; here per user, an
    ``error`` event is a failed try) → first success within 6 attempts."""
    from gazette import constants as K
    from gazette.operators.runs import resolve_fetches
    from gazette.operators.select import top_n_per_group

    ev = _events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    attempts = top_n_per_group(ev, ["user_id"], [F.col("ts"), F.col("event_id")], K.FEED_MAX_ATTEMPTS, "attempt")
    res = resolve_fetches(
        attempts,
        key="user_id",
        attempt="attempt",
        success=F.coalesce(F.col("event_type") != F.lit("error"), F.lit(False)),
        body="event_id",
        max_attempts=K.FEED_MAX_ATTEMPTS,
    )
    return res.select(
        "user_id",
        F.col("attempt_used").cast("bigint").alias("attempt_used"),
        F.col("body").alias("first_ok_event"),
        F.col("attempts_seen").cast("bigint").alias("attempts_seen"),
        "status",
    )


@register
def q_fetch_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, the rule of listings: OK status and a non-empty body within three
    attempts (here a ``view`` event has no body)."""
    from gazette import constants as K
    from gazette.operators.runs import listing_success, resolve_fetches
    from gazette.operators.select import top_n_per_group

    ev = _events(spark, sf_dir, "user_id", "ts", "event_id", "event_type")
    attempts = top_n_per_group(ev, ["user_id"], [F.col("ts"), F.col("event_id")], 6, "attempt").select(
        F.col("user_id").alias("url"),
        "attempt",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("event_id").cast("string")).alias("body"),
    )
    res = resolve_fetches(attempts, success=listing_success(), max_attempts=K.LISTING_MAX_ATTEMPTS)
    return res.select(
        F.col("url").alias("user_id"),
        F.col("attempt_used").cast("bigint").alias("attempt_used"),
        F.col("body").cast("bigint").alias("first_ok_event"),
        F.col("attempts_seen").cast("bigint").alias("attempts_seen"),
        "status",
    )


AS_OF = "2024-01-15 00:00:00"


@register
def q_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication time within [1975-01-01, as_of + 5 days]."""
    import datetime as dt

    from gazette.functions import dates as D

    as_of = dt.datetime.fromisoformat(AS_OF)
    ev = _events(spark, sf_dir, "event_id", "ts").withColumn("r", D.date_bounds_reasons("ts", as_of))
    return ev.select("event_id", (F.size("r") == 0).alias("date_ok"), F.array_join("r", ",").alias("reasons"))


@register
def q_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{REG} {type} from {yyyy-MM-dd}: {title} ({url})``."""
    from gazette.functions import dates as D

    ev = _events(spark, sf_dir, "event_id", "event_type", "ts")
    return ev.select(
        "event_id",
        T.display_line(
            F.upper(F.substring("event_type", 1, 3)),
            F.col("event_type"),
            D.display_day("ts"),
            F.concat(F.lit("Event "), F.col("event_id").cast("string")),
            F.concat(F.lit("https://events.example.com/e/"), F.col("event_id").cast("string")),
        ).alias("display"),
    )


# --------------------------------------------------------------------------
# orders: first version, date formats, year manifest
# --------------------------------------------------------------------------
@register
def q_first_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first entry of a version document, by position and not the
    largest; an empty document has none."""
    from gazette.sources.chunkdb import first_listed

    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    entry = lambda n: F.struct((F.col("o_orderkey") + n).cast("string").alias("version"), F.col("o_orderstatus").alias("hash"))
    doc = F.when(F.col("o_orderkey") % 10 == 0, "[]").otherwise(F.to_json(F.array(entry(0), entry(5), entry(-3))))
    return o.select("o_orderkey", first_listed(doc).alias("v")).select(
        "o_orderkey", F.col("v.version").alias("version"), F.col("v.hash").alias("hash")
    )


@register
def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source date format written and parsed back, plus the
    card rule (URL date first, else the text before ':')."""
    from gazette.functions import dates as D

    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    day = F.col("o_orderdate")
    url = F.concat(F.lit("https://www.example.com/press/"), F.date_format(day, "yyyy-MM-dd"), F.lit("-item.html"))
    nourl = F.lit("https://www.example.com/press/item.html")
    desc = F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(": text"))
    return o.select(
        "o_orderkey",
        D.parse_rss(D.rss_format(day)).alias("rss_parsed"),
        D.parse_dotted(F.date_format(day, "d.M.yyyy")).alias("dotted_parsed"),
        D.parse_iso_day(F.date_format(day, "yyyy-MM-dd")).alias("iso_parsed"),
        D.parse_long_day(F.date_format(day, "d MMMM yyyy")).alias("long_parsed"),
        D.card_date(url, F.lit("no date here")).alias("card_url_parsed"),
        D.card_date(nourl, desc).alias("card_text_parsed"),
    )


@register
def q_year_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing URL per year from the first to the last year,
    newest first, with the number of records each year holds."""
    o = read_table(spark, sf_dir, "orders", "o_orderdate").select(F.year("o_orderdate").alias("year"))
    span = o.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("year")
    )
    counts = o.groupBy("year").agg(F.count(F.lit(1)).alias("n_orders"))
    return (
        span.join(counts, "year", "left")
        .select(
            F.col("year").cast("bigint").alias("year"),
            F.format_string("https://www.example.com/press/accounts/%d/html/index_include.en.html", "year").alias("url"),
            F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"),
        )
        .orderBy(F.desc("year"))
    )


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------
@register
def q_dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes from small dimensions (size-checked broadcast);
    unknown keys stay visible as unmatched."""
    from gazette.operators.enrich import join_dimension

    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    dim = join_dimension(nat, reg, "n_regionkey", "r_regionkey")
    out = join_dimension(sup, dim, "s_nationkey", "n_nationkey")
    return out.select("s_suppkey", "n_name", "r_name", F.col("n_name").isNotNull().alias("matched"))


@register
def q_regulator_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17: regulator codes in any case against the dimension; unknown codes
    become rejects, rows without a code are left alone."""
    from gazette.operators.enrich import reject_unknown_regulators

    codes = F.array(*[F.lit(c) for c in ("ECB", "ecb", "MAS", "Mas", "BOE", "", None)])
    rows = read_table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id",
        F.element_at(codes, (F.col("doc_id") % 7 + 1).cast("int")).alias("regulator"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("title_length"))).otherwise(F.array().cast("array<string>")).alias("reasons"),
    )
    judged = reject_unknown_regulators(rows, spark)
    return judged.select("doc_id", "regulator", F.array_join("reasons", ",").alias("reasons"))


@register
def q_dictionary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary-encoded column decoded by a broadcast equi-join to
    the dictionary (index → value)."""
    from gazette.operators.enrich import join_dimension

    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    dictionary = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    out = join_dimension(cust, dictionary, "c_nationkey", "n_nationkey")
    return out.select("c_custkey", "c_nationkey", F.col("n_name").alias("decoded"))
