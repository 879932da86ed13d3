"""End-to-end flows: landed captures → publication candidates with reasons →
(valid publications, rejects) → one table partitioned by namespace.

Every flow is a DataFrame plan: extraction runs once per page, the ``html``
column never reaches a shuffle, detail pages are joined (not fetched) by URL
behind the same gates the sites need, and validation never raises — a bad
row becomes a reject with its reasons.

Candidate schema (all flows)::

    source, listing_url, item_pos, regulator, type, web_title, published_at,
    web_url, category, ai_topic, related_urls, reasons
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions import dates as D
from gazette.functions import text as T
from gazette.functions import urls as U
from gazette.operators import sinks as S
from gazette.operators import validate as V
from gazette.operators.enrich import gated_lookup
from gazette.operators.runs import all_or_nothing
from gazette.operators.select import latest_per_link, top_n_per_group
from gazette.session import written
from gazette.sources import chunkdb as C
from gazette.sources.extract import SourceSpec, extract
from gazette.sources.feed import entries_to_candidates
from gazette.sources.specs import CARD_LIST, DL_CHILDREN, LINK_LIST, RELATED_CARDS, SEARCH_RESULTS

CANDIDATE_COLUMNS = (
    "source",
    "listing_url",
    "item_pos",
    "regulator",
    "type",
    "web_title",
    "published_at",
    "web_url",
    "category",
    "ai_topic",
    "related_urls",
    "reasons",
)



def _empty() -> Column:
    return F.array().cast("array<string>")


def _finish(df: DataFrame, as_of: _dt.datetime | None, parse_reasons: Column | None = None,
            related_cap: int = K.MAX_RELATED_URLS, validate_related: bool = True) -> DataFrame:
    """Add record-level reasons (after any parse reasons) and the fixed
    column order.  ``validate_related=False`` leaves the related list
    unchecked (web cards attach it after validation, capped instead)."""
    related = "related_urls" if validate_related else None
    record = V.publication_reasons("web_title", "published_at", "web_url", related, as_of, related_cap)
    reasons = record if parse_reasons is None else F.when(F.size(parse_reasons) > 0, parse_reasons).otherwise(record)
    out = df.withColumn("reasons", reasons)
    for c in CANDIDATE_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*CANDIDATE_COLUMNS)


def ordered_list(df: DataFrame, key: str, pos: str, value: str, out: str) -> DataFrame:
    """(key, pos, value) rows → (key, [values in pos order]); one group is
    one page's links, so its size is bounded by the page."""
    return df.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(value)))), lambda s: s[value]).alias(out)
    )


def looked_up(detail_pages: DataFrame, listing: DataFrame) -> DataFrame:
    """The latest capture of the detail pages that listing rows point to; no
    other page's body leaves its scan or is parsed."""
    wanted = listing.select(F.col("web_url").alias("url")).distinct()
    return latest_captures(detail_pages.join(wanted, "url", "left_semi")).select("url", "html")


# ---------------------------------------------------------------------------
# article cards + attachment lists on detail pages
# ---------------------------------------------------------------------------
def detail_links(detail_pages: DataFrame, base_url: str, spec: SourceSpec = LINK_LIST) -> DataFrame:
    """Detail pages → (detail_url, related_urls): first link per list item,
    relative links resolved, order kept, no dedupe, capped at 50."""
    items = extract(detail_pages, spec, keys=("url",)).filter(F.col("page_status") == "ok")
    href = F.col("href")
    resolved = F.when(U.is_valid_url(href), href).otherwise(U.resolve_url("href", F.lit(base_url)))
    links = items.filter(href.isNotNull() & (href != "")).select(
        F.col("url").alias("detail_url"), "item_pos", resolved.alias("link")
    )
    lists = ordered_list(links, "detail_url", "item_pos", "link", "related_urls")
    return lists.withColumn("related_urls", F.slice("related_urls", 1, K.MAX_RELATED_URLS))


def card_publications(
    listing_pages: DataFrame,
    detail_pages: DataFrame | None,
    base_url: str,
    as_of: _dt.datetime | None = None,
    source: str = "cards",
) -> DataFrame:
    """Listing pages of article cards → candidates.  Cards whose link is a
    PDF are not looked up; the others take the attachment links of their
    detail page (left join — a missing page gives an empty list)."""
    cards = extract(listing_pages, CARD_LIST, keys=("url",))
    base = F.lit(base_url)
    # cleaned fields become columns first: resolve_url reads its input many
    # times, and a column reference keeps that cheap (no re-evaluation)
    clean = cards.select(
        F.lit(source).alias("source"),
        F.col("url").alias("listing_url"),
        "item_pos",
        "page_status",
        T.nullif_empty(T.strip_ws("link")).alias("_link"),
        T.nullif_empty(T.strip_ws("title")).alias("_title"),
        T.strip_ws("description").alias("_desc"),
    )
    resolved = clean.select(
        "*",
        T.nfkc("_title").alias("web_title"),
        F.when(F.col("_link").isNotNull(), U.resolve_url("_link", base)).alias("web_url"),
    )
    df = resolved.select(
        "source", "listing_url", "item_pos", "page_status", "web_url", "web_title",
        D.card_date(F.coalesce("web_url", F.lit("")), "_desc").alias("published_at"),
    )
    if detail_pages is not None:
        df = written(df.sparkSession, df, "cards")
        gate = ~U.path_ends_with("web_url", ".pdf")
        details = detail_links(looked_up(detail_pages, df.filter(gate)), base_url)
        df = gated_lookup(df, details, [("web_url", "detail_url")], ~U.path_ends_with(df["web_url"], ".pdf")).drop("detail_url")
    df = df.withColumn("related_urls", F.coalesce(F.col("related_urls") if "related_urls" in df.columns else _empty(), _empty()))
    parse = F.array_compact(
        F.array(
            F.when(F.col("page_status") != "ok", F.col("page_status")),
            F.when((F.col("page_status") == "ok") & F.col("web_url").isNull(), F.lit("missing:link")),
            F.when((F.col("page_status") == "ok") & F.col("web_title").isNull(), F.lit("missing:title")),
            F.when((F.col("page_status") == "ok") & F.col("published_at").isNull(), F.lit("invalid_date")),
        )
    )
    df = df.withColumn("category", F.lit("")).withColumn("ai_topic", F.lit(None).cast("string"))
    return _finish(df, as_of, parse, validate_related=False)


# ---------------------------------------------------------------------------
# RSS feeds
# ---------------------------------------------------------------------------
def feed_publications(entries: DataFrame, as_of: _dt.datetime | None = None, source: str = "rss") -> DataFrame:
    """Feed entries (``sources.feed.read_feeds``) → candidates."""
    c = entries_to_candidates(entries, as_of)
    return c.select(
        F.lit(source).alias("source"),
        F.col("feed").alias("listing_url") if "feed" in c.columns else F.lit(None).cast("string").alias("listing_url"),
        F.lit(None).cast("bigint").alias("item_pos"),
        F.lit(None).cast("string").alias("regulator"),
        F.lit(None).cast("string").alias("type"),
        "web_title",
        "published_at",
        "web_url",
        F.lit("").alias("category"),
        F.lit(None).cast("string").alias("ai_topic"),
        "related_urls",
        "reasons",
        *[F.col(x) for x in ("malformed",) if x in c.columns],
    )


# ---------------------------------------------------------------------------
# definition-list listings
# ---------------------------------------------------------------------------
def dl_publications(
    listing_pages: DataFrame,
    base_url: str,
    update_type: str,
    regulator: str,
    spec: SourceSpec = DL_CHILDREN,
    english_only: bool = True,
    as_of: _dt.datetime | None = None,
    source: str = "dl",
) -> DataFrame:
    """dt/dd listing pages → candidates: date from the dt, title and link from
    the first anchor of the dd, related links from lists nested in the dd."""
    items = extract(listing_pages, spec, keys=("url",))
    base = F.lit(base_url)
    related = U.resolve_all(F.coalesce(F.col("related"), _empty()), base)
    if english_only:
        related = U.english_only(related, K.ENGLISH_MARKER)
    clean = items.select(
        "*",
        T.nullif_empty(T.strip_ws("title")).alias("_title"),
        T.strip_ws("link").alias("_link"),
    )
    df = clean.select(
        F.lit(source).alias("source"),
        F.col("url").alias("listing_url"),
        "item_pos",
        "page_status",
        F.lit(regulator).alias("regulator"),
        F.lit(update_type).alias("type"),
        T.nfkc("_title").alias("web_title"),
        D.listing_date("date_text").alias("published_at"),
        F.when(F.col("link").isNotNull(), U.resolve_url("_link", base)).alias("web_url"),
        F.lit("").alias("category"),
        related.alias("related_urls"),
    )
    parse = F.array_compact(
        F.array(
            F.when(F.col("page_status") != "ok", F.col("page_status")),
            F.when((F.col("page_status") == "ok") & F.col("web_url").isNull(), F.lit("missing:link")),
            F.when((F.col("page_status") == "ok") & F.col("web_title").isNull(), F.lit("missing:title")),
            F.when((F.col("page_status") == "ok") & F.col("published_at").isNull(), F.lit("invalid_date")),
        )
    )
    return _finish(df, as_of, parse)


# ---------------------------------------------------------------------------
# search-result cards + related cards on detail pages
# ---------------------------------------------------------------------------
def related_cards(detail_pages: DataFrame, base_url: str) -> DataFrame:
    """Detail pages → (detail_url, related_urls): PDF links first, then links
    of related cards; resolved, order and duplicates kept."""
    one = extract(detail_pages, RELATED_CARDS, keys=("url",)).filter(F.col("page_status") == "ok")
    base = F.lit(base_url)
    both = F.concat(F.coalesce("pdf_links", _empty()), F.coalesce("card_links", _empty()))
    return one.select(
        F.col("url").alias("detail_url"),
        U.resolve_all(both, base).alias("related_urls"),
    )


def search_publications(
    listing_pages: DataFrame,
    detail_pages: DataFrame | None,
    base_url: str,
    update_type: str,
    regulator: str,
    as_of: _dt.datetime | None = None,
    source: str = "search",
) -> DataFrame:
    """Search-result pages → candidates; a card missing any part is rejected
    with the names of the missing parts; only regulations are enriched."""
    items = extract(listing_pages, SEARCH_RESULTS, keys=("url",))
    base = F.lit(base_url)
    clean = items.select(
        "*",
        T.strip_ws("date_text").alias("_date_text"),
        T.strip_ws("link").alias("_link"),
        T.strip_ws("title").alias("_title"),
    )
    df = clean.select(
        F.lit(source).alias("source"),
        F.col("url").alias("listing_url"),
        "item_pos",
        "page_status",
        F.lit(regulator).alias("regulator"),
        F.lit(update_type).alias("type"),
        T.nfkc("_title").alias("web_title"),
        D.parse_long_day(F.split_part("_date_text", F.lit(": "), F.lit(2))).alias("published_at"),
        F.when(F.col("link").isNotNull(), U.resolve_url("_link", base)).alias("web_url"),
        T.strip_ws("category").alias("category"),
        V.missing_fields(date="date_text", link="link", title="title", category="category").alias("_missing"),
    )
    if detail_pages is not None and update_type == "regulation":
        df = written(df.sparkSession, df, "results")
        details = related_cards(looked_up(detail_pages, df), base_url)
        df = gated_lookup(df, details, [("web_url", "detail_url")], df["type"] == "regulation").drop("detail_url")
    if "related_urls" not in df.columns:
        df = df.withColumn("related_urls", _empty())
    df = df.withColumn("related_urls", F.coalesce("related_urls", _empty()))
    parse = F.concat(
        F.array_compact(F.array(F.when(F.col("page_status") != "ok", F.col("page_status")))),
        F.when(F.col("page_status") == "ok", F.col("_missing")).otherwise(_empty()),
        F.array_compact(
            F.array(
                F.when(
                    (F.size("_missing") == 0) & (F.col("page_status") == "ok") & F.col("published_at").isNull(),
                    F.lit("invalid_date"),
                )
            )
        ),
    )
    return _finish(df, as_of, parse)


# ---------------------------------------------------------------------------
# chunk database
# ---------------------------------------------------------------------------
def db_publications(
    spark: SparkSession,
    db_root: str,
    update_type: str | Sequence[str],
    base_url: str,
    regulator: str = "ECB",
    n: int = K.PER_LINK_LATEST,
    source: str = "db",
    as_of: _dt.datetime | None = None,
) -> DataFrame:
    """Landed chunk database → the first ``n`` records (storage order) of each
    update type's code, as candidates.  Only the chunks that the type index
    names for those records are read; without a type index all are, in one
    pass for all update types.  A missing or empty database fails the run
    instead of yielding an empty table."""
    types = [update_type] if isinstance(update_type, str) else list(update_type)
    ver = C.first_version(spark, db_root).first()
    if ver is None or ver["version"] is None:
        raise ValueError(f"no version listed under {db_root}")
    root = f"{db_root.rstrip('/')}/{ver['version']}/{ver['hash']}"
    meta = C.read_metadata(spark, root)
    wanted = C.leading_chunks(spark, root, meta, [C.db_type_code(t) for t in types], n)
    if wanted is None:
        chunks = C.read_data_chunks(spark, root)
    else:
        chunks = C.read_chunk_rows(wanted, root, int(meta["chunk_group_size"]))
    records = C.decode_chunks(chunks, meta["header"], int(meta["chunk_size"]))
    chosen = C.latest_of_types(records, types, n)
    pubs = C.record_to_publication(chosen, base_url, "", regulator).withColumn("type", F.col("update_type"))
    df = pubs.select(
        F.lit(source).alias("source"),
        F.lit(db_root).alias("listing_url"),
        F.col("record_id").alias("item_pos"),
        *[c for c in pubs.columns if c not in ("record_id", "update_type")],
    )
    return _finish(df, as_of)


# ---------------------------------------------------------------------------
# selection, union, publish
# ---------------------------------------------------------------------------
def keep_latest(candidates: DataFrame, per_link: int | None = K.PER_LINK_LATEST) -> DataFrame:
    """Ten latest valid items per listing link (rejects are all kept).  Reads
    ``candidates`` twice: give it a written table, not an extraction."""
    valid = candidates.filter(F.size("reasons") == 0)
    rejects = candidates.filter(F.size("reasons") > 0)
    top = latest_per_link(valid, "listing_url", "published_at", "item_pos", per_link).drop("rank")
    return top.unionByName(rejects)


def first_per_url(candidates: DataFrame, key: str = "web_url") -> DataFrame:
    """Of valid candidates that share ``key`` the newest stays (ties: listing,
    then position); rejects are kept."""
    order = [F.col("published_at").desc_nulls_last(), F.col("listing_url"), F.col("item_pos"), F.col("source")]
    top = top_n_per_group(candidates.filter(F.size("reasons") == 0), [key], order, 1, "rank").drop("rank")
    return top.unionByName(candidates.filter(F.size("reasons") > 0))


def atomic_pages(candidates: DataFrame) -> DataFrame:
    """Opt-in all-or-nothing mode: a listing page with any rejected row loses
    all its rows (they become rejects with reason ``page_rejected``)."""
    good_pages = all_or_nothing(candidates, "listing_url", F.size("reasons") == 0).select("listing_url").distinct()
    flagged = candidates.join(good_pages.withColumn("_page_ok", F.lit(True)), "listing_url", "left")
    reasons = F.when(
        F.col("_page_ok").isNull() & (F.size("reasons") == 0), F.array(F.lit("page_rejected"))
    ).otherwise(F.col("reasons"))
    return flagged.withColumn("reasons", reasons).select(*candidates.columns)


def split(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publications, rejects) of a candidate frame (lazy; both read it)."""
    pubs = candidates.filter(F.size("reasons") == 0).select(*S.PUBLICATION_COLUMNS, "source", "listing_url")
    rejects = V.reject_rows(candidates, "source", F.coalesce("web_url", "listing_url"))
    return pubs, rejects


def publish(
    frames: Sequence[tuple[str, DataFrame]], path: str, outcomes: dict[str, DataFrame] | None = None
) -> dict[str, str]:
    """Publish candidate frames to their namespaces, each as one run (with its
    outcome, if given) that replaces the namespace's former run at once, also
    an empty one; frames of one namespace are united.  Returns the runs."""
    by_namespace: dict[str, list[DataFrame]] = {}
    for namespace, df in frames:
        by_namespace.setdefault(namespace, []).append(df)
    return {
        namespace: S.write_namespace(S.union_sources(*parts), path, namespace, (outcomes or {}).get(namespace))
        for namespace, parts in by_namespace.items()
    }


def read_publications(spark: SparkSession, path: str, runs: dict[str, str] | None = None) -> DataFrame:
    """The valid rows of the live runs (or of ``runs``, see ``sinks.live_runs``)."""
    return (
        S.read_live(spark, path, runs=runs)
        .filter(F.col("status") == "valid")
        .select(*S.PUBLICATION_COLUMNS, "source", "listing_url", "namespace")
    )


def read_rejects(spark: SparkSession, path: str, runs: dict[str, str] | None = None) -> DataFrame:
    df = S.read_live(spark, path, runs=runs, merge_schema=True).filter(F.col("status") == "rejected")
    return V.reject_rows(df.drop("status"), "source", F.coalesce("web_url", "listing_url")).withColumn(
        "namespace", F.get_json_object("detail", "$.namespace")
    )


def latest_captures(captures: DataFrame, ts: str = "fetched_at") -> DataFrame:
    """One capture per URL: the latest by ``ts`` where there is one, ties by a
    hash of the body, so that batch, stream and recomputation agree.  Each map
    task forwards one capture per URL; give it captures already restricted to
    the wanted URLs, as this is where bodies are shuffled."""
    order = [F.col("_body").desc_nulls_last()]
    if ts in captures.columns:
        order.insert(0, F.col(ts).desc_nulls_last())
    keyed = captures.withColumn("_body", F.xxhash64("html"))
    return top_n_per_group(keyed, ["url"], order, 1, "_rank").drop("_rank", "_body")


def manifest_join(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """Landed pages restricted to a link manifest ``(url, lazy, namespace,
    type, ...)`` by URL — the batch form of a list of links to visit."""
    return pages.join(manifest, "url", "inner")
