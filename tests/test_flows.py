"""End-to-end flows on invented landed files."""

import datetime as dt
import json
import os

import pytest
from fixtures import (
    BASE,
    CARD_LISTING,
    DETAIL_NO_LIST,
    DETAIL_RATES,
    DETAIL_STATEMENT,
    DL_BODY_PAGE,
    DL_PAGE,
    EMPTY_FEED,
    RELATED_DETAIL,
    RSS_FEED,
    SEARCH_PAGE,
)
from pyspark.sql import functions as F

from gazette.plans import publications as PUB
from gazette.sources.feed import read_feeds

AS_OF = dt.datetime(2025, 2, 10)


def _pages(spark, rows):
    return spark.createDataFrame(rows, "url string, html string")


def test_card_flow_with_detail_pages(spark):
    listing = _pages(spark, [(f"{BASE}/en/press", CARD_LISTING)])
    details = _pages(
        spark,
        [
            (f"{BASE}/en/press/2025-01-29-rates.html", DETAIL_RATES),
            (f"{BASE}/en/press/statement.html", DETAIL_STATEMENT),
            (f"{BASE}/en/press/no-date.html", DETAIL_NO_LIST),
            (f"{BASE}/files/report.pdf", DETAIL_RATES),  # never looked up: PDF gate
        ],
    )
    cands = PUB.card_publications(listing, details, BASE, AS_OF)
    rows = {r.item_pos: r for r in cands.collect()}
    assert rows[1].reasons == [] and rows[1].published_at == dt.datetime(2025, 1, 29)
    assert rows[1].related_urls == [f"{BASE}/files/a.pdf", "https://other.example.org/b.pdf", f"{BASE}/c/d.html"]
    assert rows[2].web_title == "Statement" and rows[2].published_at == dt.datetime(2025, 2, 3)
    assert len(rows[2].related_urls) == 50  # web lists are capped, not rejected
    assert rows[3].reasons == ["invalid_date"]  # no URL date and no description
    assert rows[4].reasons == ["invalid_date"]  # invalid URL date: no fallback to the text
    assert rows[5].related_urls == [] and rows[5].reasons == []  # PDF: no lookup
    assert rows[6].reasons == ["missing:title"]
    assert rows[7].reasons == ["missing:link"]
    # valid + rejects = input
    pubs, rejects = PUB.split(cands)
    assert pubs.count() + cands.filter(F.size("reasons") > 0).count() == cands.count() == 7
    assert rejects.filter("reason = 'missing:link'").count() == 1


def test_rss_flow_from_files(spark, scratch):
    feeds = os.path.join(scratch, "feeds")
    os.makedirs(feeds)
    with open(os.path.join(feeds, "main.xml"), "w") as f:
        f.write(RSS_FEED)
    with open(os.path.join(feeds, "empty.xml"), "w") as f:
        f.write(EMPTY_FEED)
    entries = read_feeds(spark, feeds)
    cands = {r.web_title: r for r in PUB.feed_publications(entries, AS_OF).collect()}
    assert len(cands) == 6  # the empty feed has no items
    ok = cands["Valid entry"]
    assert ok.reasons == [] and ok.published_at == dt.datetime(2025, 1, 29, 12, 0)
    assert ok.related_urls == ["https://www.example.com/a.pdf"]  # ftp enclosure skipped
    assert cands["Missing link"].reasons == ["missing:link"]
    assert cands["Bad date"].reasons == ["invalid_date"]
    assert cands["Zone offset"].reasons == ["invalid_date"]
    assert cands["Not http"].reasons == ["invalid_link"]
    assert cands["Many enclosures"].reasons == ["invalid_related_urls"]  # feeds reject over 50


def test_rss_empty_feed_is_reported(spark, scratch):
    from gazette.operators.runs import source_health

    feeds = os.path.join(scratch, "feeds")
    os.makedirs(feeds)
    for name, body in (("empty.xml", EMPTY_FEED), ("main.xml", RSS_FEED)):
        with open(os.path.join(feeds, name), "w") as f:
            f.write(body)
    entries = read_feeds(spark, feeds)
    cands = PUB.feed_publications(entries, AS_OF)
    expected = spark.createDataFrame(
        [("file://" + os.path.join(feeds, n),) for n in ("empty.xml", "main.xml")], "listing_url string"
    )
    got = {r.listing_url.rsplit("/", 1)[-1]: (r.n_rows, r.n_valid, r.status)
           for r in source_health(cands, expected, "listing_url", F.size("reasons") == 0).collect()}
    assert got == {"empty.xml": (0, 0, "empty"), "main.xml": (6, 1, "ok")}


def test_dl_flow(spark):
    listing = _pages(spark, [(f"{BASE}/press/accounts", DL_PAGE), (f"{BASE}/press/bare", DL_BODY_PAGE)])
    rows = PUB.dl_publications(listing, BASE, "regulation", "ECB", as_of=AS_OF).collect()
    by_title = {r.web_title: r for r in rows}
    assert by_title["Account one"].related_urls == [f"{BASE}/pdf/a1.en.pdf"]  # English, query-free, distinct
    assert by_title["Account one"].published_at == dt.datetime(2024, 1, 9)
    assert by_title["Full width title"].reasons == []  # NFKC
    bad = [r for r in rows if r.web_url == f"{BASE}/press/a2.en.html"][0]
    assert bad.reasons == ["invalid_date"]
    assert {r.web_title for r in rows if r.listing_url.endswith("bare")} == {"Bare one", "Bare two"}


def test_short_listing_report(spark):
    from gazette.operators.runs import short_groups

    listing = _pages(spark, [(f"{BASE}/press/accounts", DL_PAGE)])
    cands = PUB.dl_publications(listing, BASE, "regulation", "ECB")
    assert short_groups(cands, "listing_url").first().n_rows == 3


def test_search_flow_with_related_cards(spark):
    listing = _pages(spark, [(f"{BASE}/publications", SEARCH_PAGE)])
    details = _pages(spark, [(f"{BASE}/regulation/pCon", RELATED_DETAIL)])
    rows = {r.item_pos: r for r in PUB.search_publications(listing, details, BASE, "regulation", "MAS", AS_OF).collect()}
    assert rows[1].reasons == [] and rows[1].category == "Banking"
    assert rows[1].related_urls == [f"{BASE}/files/x.pdf", f"{BASE}/files/y.pdf", f"{BASE}/regulation/related-1"]
    assert rows[2].web_title == "Full width notice"
    assert rows[3].reasons == ["missing:date"]
    assert rows[4].reasons == ["missing:category"]
    news = PUB.search_publications(listing, details, BASE, "news", "MAS", AS_OF).collect()
    assert all(r.related_urls == [] for r in news)  # only regulations are enriched


def _write_db(root, records, header, chunk_size, group_size):
    version, hsh = "7", "abc"
    os.makedirs(os.path.join(root, version, hsh, "indexes", "type"), exist_ok=True)
    with open(os.path.join(root, "versions.json"), "w") as f:
        json.dump([{"version": version, "hash": hsh}, {"version": "9", "hash": "zzz"}], f)
    vroot = os.path.join(root, version, hsh)
    with open(os.path.join(vroot, "metadata.json"), "w") as f:
        json.dump({"header": header, "indexes": ["type"], "chunk_size": chunk_size,
                   "chunk_group_size": group_size, "total_records": len(records)}, f)
    for c in range(0, (len(records) + chunk_size - 1) // chunk_size):
        flat = [v for rec in records[c * chunk_size:(c + 1) * chunk_size] for v in rec]
        if c == 0:
            flat = flat + flat[:2]  # a partial trailing record is ignored
        d = os.path.join(vroot, "data", str(c // group_size))
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"chunk_{c}.json"), "w") as f:
            json.dump(flat, f)
    with open(os.path.join(vroot, "indexes", "type", "index.json"), "w") as f:
        json.dump([{"value": "18", "total_records": 2, "first_sort_id_per_chunk": [0], "last_sort_id_per_chunk": [3]},
                   {"value": "1", "total_records": 3, "first_sort_id_per_chunk": [1, 4], "last_sort_id_per_chunk": [2, 4]}], f)
    return vroot


HEADER = ["type", "pub_timestamp", "publicationProperties", "documentTypes", "Taxonomy", "childrenPublication"]


def _rec(t, ts, title, doc, tax, children):
    return [t, ts, {"Title": title}, [doc], tax, children]


CHILD_OK = '1,1700000000,2023,11,14,a,b,c,d,"[\\""/pdf/one.pdf\\"",\\""/pdf/two.pdf\\""]","{\\""k\\"":\\""v\\""}"'
CHILD_SHORT = "1,2,3"
CHILD_BAD_JSON = '2,1700000000,2023,11,14,a,b,c,d,"[\\""/pdf/x.pdf","{}"'


def test_chunk_database_flow(spark, scratch):
    from gazette.sources import chunkdb as C

    records = [
        _rec(18, 1738152000, "Letter one", "/press/l1.en.html", None, [CHILD_OK, CHILD_SHORT, ""]),
        _rec(1, 1737547100, "Press one", "/press/p1.en.html", "Monetary", [CHILD_BAD_JSON]),
        _rec(1, 1737547000, "Press two", "/press/p2.en.html", None, []),
        _rec(18, 1737546900, "Letter two", "/press/l2.en.html", "Supervision", []),
        _rec(1, 1737546800, "Press three", "/press/p3.en.html", None, []),
    ]
    root = os.path.join(scratch, "db")
    vroot = _write_db(root, records, HEADER, 2, 2)
    ver = C.first_version(spark, root).first()
    assert (ver.version, ver.hash) == ("7", "abc")  # first listed, not the maximum
    meta = C.read_metadata(spark, vroot)
    assert meta["chunk_size"] == 2
    recs = C.decode_chunks(C.read_data_chunks(spark, vroot), meta["header"], 2)
    assert sorted(r.record_id for r in recs.collect()) == [0, 1, 2, 3, 4]
    idx = C.read_index(spark, vroot, "type").collect()
    assert [(r.index_value_id, r.value, r.number_of_chunks) for r in idx] == [(0, "18", 1), (1, "1", 2)]

    regs = PUB.db_publications(spark, root, "regulation", BASE, n=10).collect()
    assert [r.web_title for r in regs] == ["Letter one", "Letter two"] or sorted(r.web_title for r in regs) == [
        "Letter one", "Letter two"]
    first = [r for r in regs if r.web_title == "Letter one"][0]
    assert first.published_at == dt.datetime(2025, 1, 29, 12, 0)
    assert first.web_url == f"{BASE}/press/l1.en.html" and first.category == ""
    assert first.related_urls == [f"{BASE}/pdf/one.pdf", f"{BASE}/pdf/two.pdf"]
    news = PUB.db_publications(spark, root, "news", BASE, n=2).collect()
    assert sorted(r.item_pos for r in news) == [1, 2]  # first two in storage order
    assert {r.category for r in news} == {"Monetary", ""}


def test_child_decode_cases(spark):
    from gazette.sources import chunkdb as C

    df = spark.createDataFrame([(json.dumps([CHILD_OK, CHILD_SHORT, "", CHILD_BAD_JSON]),)], "c string")
    kids = df.select(C.decode_children("c").alias("k")).first().k
    assert len(kids) == 2
    assert kids[0].publicationId == "1" and kids[0].date.year == "2023"
    assert kids[0].pdfUrls == ["/pdf/one.pdf", "/pdf/two.pdf"] and kids[0].metadata == {"k": "v"}
    assert kids[1].pdfUrls == [] and kids[1].metadata == {}


def test_missing_database_fails_the_run(spark, scratch):
    root = os.path.join(scratch, "nodb")
    os.makedirs(root)
    with open(os.path.join(root, "versions.json"), "w") as f:
        f.write("[]")
    with pytest.raises(ValueError):
        PUB.db_publications(spark, root, "news", BASE)


def test_publish_single_pass_and_read_back(spark, scratch):
    listing = _pages(spark, [(f"{BASE}/en/press", CARD_LISTING)])
    cards = PUB.card_publications(listing, None, BASE, AS_OF)
    dl = PUB.dl_publications(_pages(spark, [(f"{BASE}/press/accounts", DL_PAGE)]), BASE, "regulation", "ECB", as_of=AS_OF)
    out = os.path.join(scratch, "pubs")
    PUB.publish([("bank-news", cards), ("ecb-regulations", dl)], out)
    pubs = PUB.read_publications(spark, out)
    rejects = PUB.read_rejects(spark, out)
    assert {r.namespace for r in pubs.select("namespace").distinct().collect()} == {"bank-news", "ecb-regulations"}
    total = cards.count() + dl.count()
    n_rejected_rows = spark.read.parquet(out).filter("status = 'rejected'").count()
    assert pubs.count() + n_rejected_rows == total
    assert rejects.filter("reason = 'invalid_date'").count() >= 3


def test_keep_latest_per_link(spark):
    rows = [("L", i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 15), []) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "listing_url string, item_pos long, published_at timestamp_ntz, reasons array<string>")
    kept = PUB.keep_latest(df, 10).collect()
    assert len(kept) == 10
    assert min(r.published_at for r in kept) >= dt.datetime(2024, 1, 10)


def test_page_atomic_option(spark):
    listing = _pages(spark, [(f"{BASE}/press/accounts", DL_PAGE), (f"{BASE}/press/bare", DL_BODY_PAGE)])
    cands = PUB.dl_publications(listing, BASE, "regulation", "ECB", as_of=AS_OF)
    atomic = PUB.atomic_pages(cands)
    assert atomic.count() == cands.count()
    ok = atomic.filter(F.size("reasons") == 0).collect()
    assert {r.listing_url for r in ok} == {f"{BASE}/press/bare"}
    assert atomic.filter(F.array_contains("reasons", "page_rejected")).count() == 2


def test_landed_files_scan_repairs_utf8(spark, scratch):
    from gazette.sources.pages import read_landed_files

    d = os.path.join(scratch, "landed")
    os.makedirs(d)
    with open(os.path.join(d, "p1.html"), "wb") as f:
        f.write(b"<html><title>caf\xe9 \xff</title></html>")
    row = read_landed_files(spark, d, "*.html").first()
    assert row.html == b"<html><title>caf\xe9 \xff</title></html>".decode("utf-8", "replace")


def test_db_both_types_share_one_decode(spark, scratch):
    records = [
        _rec(18, 1738152000, "Letter one", "/press/l1.en.html", None, []),
        _rec(1, 1737547100, "Press one", "/press/p1.en.html", None, []),
        _rec(18, 1737546900, "Letter two", "/press/l2.en.html", None, []),
    ]
    root = os.path.join(scratch, "db")
    _write_db(root, records, HEADER, 2, 2)
    both = PUB.db_publications(spark, root, ["regulation", "news"], BASE)
    got = sorted((r.type, r.web_title) for r in both.collect())
    assert got == [("news", "Press one"), ("regulation", "Letter one"), ("regulation", "Letter two")]
    final = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan text") == 1  # one decode serves both types


def test_search_cards_missing_link_or_title(spark):
    from fixtures import result

    page = "<html><body><ul>" + result(link=False) + result(title=False) + "</ul></body></html>"
    rows = PUB.search_publications(_pages(spark, [(f"{BASE}/p", page)]), None, BASE, "news", "MAS", AS_OF).collect()
    assert sorted(tuple(r.reasons) for r in rows) == [("missing:link", "missing:title"), ("missing:title",)]


def test_single_feed_entry(spark):
    """One entry with title, link and RFC-822 date and no enclosures gives
    exactly one publication with that title."""
    from gazette.sources.feed import parse_item

    item = (
        "<item><title>Ferry timetable</title><link>https://port.example.org/ferries</link>"
        "<pubDate>Wed, 29 Jan 2025 12:00:00 GMT</pubDate><description>From May on</description></item>"
    )
    entries = spark.createDataFrame([(item,)], "x string").select(parse_item("x").alias("e")).select("e.*")
    rows = PUB.feed_publications(entries, AS_OF).collect()
    assert len(rows) == 1 and rows[0].web_title == "Ferry timetable" and rows[0].reasons == []
