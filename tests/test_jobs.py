"""Namespace jobs over landed captures."""

import datetime as dt
import os

import pytest

from fixtures import DL_BODY_PAGE, DL_PAGE, RELATED_DETAIL, SEARCH_PAGE
from pyspark.sql import functions as F
from test_flows import HEADER, _rec, _write_db

from gazette.operators import sinks as S
from gazette.plans import jobs as J
from gazette.plans import publications as PUB

AS_OF = dt.datetime(2024, 6, 1)


def test_manifest_generates_years_newest_first(spark):
    m = J.link_manifest(spark, J.JOBS["ecb-regulations"], AS_OF).collect()
    years = [r.url for r in m if "/accounts/" in r.url]
    assert years == [J._ECB + f"/press/accounts/{y}/html/index_include.en.html" for y in (2024, 2023, 2022)]
    assert sum(1 for r in m if r.lazy) == 1


def test_ecb_regulations_job(spark, scratch):
    job = J.JOBS["ecb-regulations"]
    captures = spark.createDataFrame(
        [
            (J._ECB + "/press/accounts/2024/html/index_include.en.html", DL_PAGE),
            (J._ECB + "/press/accounts/2023/html/index_include.en.html", DL_BODY_PAGE),
            (job.links[0].url, DL_BODY_PAGE),
            ("https://unrelated.example.com/", DL_PAGE),  # not in the manifest: ignored
        ],
        "url string, html string",
    )
    root = os.path.join(scratch, "db")
    _write_db(root, [_rec(18, 1710000000, "Letter", "/press/l.en.html", None, []),
                     _rec(1, 1710000000, "Press", "/press/p.en.html", None, [])], HEADER, 2, 2)
    out = os.path.join(scratch, "pubs")
    cands = J.run_job(spark, "ecb-regulations", captures, out, AS_OF, db_root=root)
    assert cands.filter(F.col("source") == "db").count() == 1
    assert cands.filter(F.col("listing_url").startswith("https://unrelated")).count() == 0
    pubs = PUB.read_publications(spark, out)
    assert {r.namespace for r in pubs.select("namespace").distinct().collect()} == {"ecb-regulations"}
    titles = {r.web_title for r in pubs.collect()}
    assert {"Letter", "Account one", "Bare one", "Bare two"} <= titles
    assert all(r.type == "regulation" for r in pubs.collect())


def test_mas_regulations_job_enriches_from_detail_pages(spark):
    job = J.JOBS["mas-regulations"]
    captures = spark.createDataFrame(
        [(job.links[0].url, SEARCH_PAGE), (J._MAS + "/regulation/pCon", RELATED_DETAIL)], "url string, html string"
    )
    rows = J.run_job(spark, job, captures, None, AS_OF).collect()
    first = [r for r in rows if r.web_title == "Consultation paper"][0]
    assert first.related_urls == [J._MAS + "/files/x.pdf", J._MAS + "/files/y.pdf", J._MAS + "/regulation/related-1"]
    assert first.regulator == "MAS" and first.category == "Banking"


def test_mas_news_job_reads_every_sector_link(spark):
    job = J.JOBS["mas-news"]
    captures = spark.createDataFrame([(lk.url, SEARCH_PAGE) for lk in job.links], "url string, html string")
    rows = J.run_job(spark, job, captures, None, AS_OF).collect()
    assert len({r.listing_url for r in rows}) == 3
    assert all(r.related_urls == [] for r in rows)


def test_recaptured_pages_use_the_latest_capture(spark):
    job = J.JOBS["mas-news"]
    old = SEARCH_PAGE.replace("Consultation paper", "Old title")
    t = dt.datetime(2024, 5, 1)
    captures = spark.createDataFrame(
        [(job.links[0].url, old, t), (job.links[0].url, SEARCH_PAGE, t + dt.timedelta(days=1))],
        "url string, html string, fetched_at timestamp",
    )
    titles = {r.web_title for r in J.run_job(spark, job, captures, None, AS_OF).collect()}
    assert "Consultation paper" in titles and "Old title" not in titles


def test_custom_cards_and_feed_job(spark, scratch):
    """A user-defined job: an article-card list with detail pages plus a
    folder of landed feed files, published under one namespace."""
    from fixtures import BASE, CARD_LISTING, DETAIL_RATES, RSS_FEED

    job = J.Job(namespace="bank-press", regulator="BANK", update_type="news",
                links=(J.Link(f"{BASE}/en/press", "cards"),), base_url=BASE)
    captures = spark.createDataFrame(
        [(f"{BASE}/en/press", CARD_LISTING), (f"{BASE}/en/press/2025-01-29-rates.html", DETAIL_RATES)],
        "url string, html string",
    )
    feeds = os.path.join(scratch, "feeds")
    os.makedirs(feeds)
    with open(os.path.join(feeds, "main.xml"), "w") as f:
        f.write(RSS_FEED)
    out = os.path.join(scratch, "pubs")
    J.run_job(spark, job, captures, out, dt.datetime(2025, 2, 10), feeds_path=feeds)
    pubs = PUB.read_publications(spark, out).collect()
    sources = {r.source for r in pubs}
    assert sources == {"cards", "rss"}
    rates = [r for r in pubs if r.web_url == f"{BASE}/en/press/2025-01-29-rates.html"][0]
    assert len(rates.related_urls) == 3  # from its detail page


def _press_job(**more):
    from fixtures import BASE

    return J.Job(namespace="bank-press", regulator="BANK", update_type="news",
                 links=(J.Link(f"{BASE}/en/press", "cards"),), base_url=BASE, **more)


def test_a_run_replaces_its_whole_namespace(spark, scratch):
    """Rejects and publications of earlier runs do not outlive a later run."""
    out = os.path.join(scratch, "pubs")
    columns = ["source", "listing_url", "item_pos", "regulator", "type", "web_title", "published_at", "web_url",
               "category", "ai_topic", "related_urls", "reasons"]
    job = J.JOBS["mas-news"]
    base = J.run_job(spark, job, spark.createDataFrame([(job.links[0].url, SEARCH_PAGE)], "url string, html string"),
                     None, AS_OF).select(*columns)
    valid, rejected = base.filter(F.size("reasons") == 0), base.filter(F.size("reasons") > 0)
    assert valid.count() and rejected.count()
    PUB.publish([("mas-news", base), ("ecb-news", valid)], out)
    assert PUB.read_rejects(spark, out).count() > 0
    PUB.publish([("mas-news", valid)], out)
    assert PUB.read_rejects(spark, out).count() == 0
    assert PUB.read_publications(spark, out).filter("namespace = 'mas-news'").count() == valid.count()
    PUB.publish([("mas-news", rejected)], out)
    assert PUB.read_publications(spark, out).filter("namespace = 'mas-news'").count() == 0
    PUB.publish([("mas-news", base.limit(0))], out)
    assert S.read_live(spark, out).filter("namespace = 'mas-news'").count() == 0
    assert PUB.read_publications(spark, out).filter("namespace = 'ecb-news'").count() == valid.count()


def test_two_captures_of_a_detail_page_give_one_publication(spark):
    job = J.JOBS["mas-regulations"]
    rows = [(job.links[0].url, SEARCH_PAGE), (J._MAS + "/regulation/pCon", RELATED_DETAIL),
            (J._MAS + "/regulation/pCon", RELATED_DETAIL + "<!-- again -->")]
    got = J.run_job(spark, job, spark.createDataFrame(rows, "url string, html string"), None, AS_OF).collect()
    assert len([r for r in got if r.web_title == "Consultation paper"]) == 1


def test_outcome_reports_empty_short_cut_and_rejected(spark, scratch):
    out = os.path.join(scratch, "pubs")
    from dataclasses import replace

    job = replace(J.JOBS["mas-news"], per_link=1)
    captures = spark.createDataFrame([(job.links[0].url, SEARCH_PAGE), (job.links[1].url, "<html>no list</html>")],
                                     "url string, html string")
    kept = J.run_job(spark, job, captures, out, AS_OF)
    rows = {r.listing_url: r for r in J.read_outcome(spark, out).collect()}
    assert [rows[lk.url].status for lk in job.links] == ["ok", "no_valid", "empty"] or rows[job.links[2].url].status == "empty"
    first = rows[job.links[0].url]
    assert first.n_rows == first.n_valid + first.n_rejected and first.n_cut == first.n_valid - 1 and first.short
    assert kept.filter(F.size("reasons") == 0).count() == 1
    from gazette.operators.runs import UnhealthySource

    with pytest.raises(UnhealthySource):
        J.run_job(spark, replace(job, strict=True), captures, None, AS_OF)


def test_page_atomic_and_dedupe_jobs(spark):
    from dataclasses import replace

    job = J.JOBS["mas-news"]
    captures = spark.createDataFrame([(lk.url, SEARCH_PAGE) for lk in job.links], "url string, html string")
    plain = J.run_job(spark, job, captures, None, AS_OF)
    assert plain.filter(F.size("reasons") > 0).count() > 0
    atomic = J.run_job(spark, replace(job, page_atomic=True), captures, None, AS_OF)
    assert atomic.filter(F.size("reasons") == 0).count() == 0
    once = J.run_job(spark, replace(job, dedupe_on="web_url"), captures, None, AS_OF).filter(F.size("reasons") == 0)
    urls = [r.web_url for r in once.collect()]
    assert len(urls) == len(set(urls)) > 0


def test_job_from_a_fetch_log(spark):
    """Listings take the first OK attempt with a body within three tries;
    detail pages the first OK one within six."""
    job = J.JOBS["mas-regulations"]
    listing, detail = job.links[0].url, J._MAS + "/regulation/pCon"
    log = [(listing, 1, 500, None), (listing, 2, 200, ""), (listing, 3, 200, SEARCH_PAGE),
           *[(detail, i, 503, None) for i in range(1, 6)], (detail, 6, 200, RELATED_DETAIL)]
    fetches = spark.createDataFrame(log, "url string, attempt int, status int, body string")
    rows = J.run_job(spark, job, None, None, AS_OF, fetches=fetches).collect()
    assert len([r for r in rows if r.web_title == "Consultation paper"][0].related_urls) == 3
    late = spark.createDataFrame([(listing, 4, 200, SEARCH_PAGE)], fetches.schema)
    assert J.run_job(spark, job, None, None, AS_OF, fetches=late).count() == 0


def test_job_files_and_flags(spark, scratch):
    """The command line: a job file, captures, feeds, and a base URL."""
    import json

    from fixtures import BASE, CARD_LISTING, RSS_FEED

    from gazette.__main__ import main

    feeds, spec, out = (os.path.join(scratch, x) for x in ("feeds", "job.json", "out"))
    os.makedirs(feeds)
    with open(os.path.join(feeds, "main.xml"), "w") as f:
        f.write(RSS_FEED)
    with open(spec, "w") as f:
        json.dump({"namespace": "bank-press", "regulator": "BANK", "update_type": "news",
                   "links": [{"url": f"{BASE}/en/press", "flow": "cards"}]}, f)
    spark.createDataFrame([(f"{BASE}/en/press", CARD_LISTING)], "url string, html string").write.parquet(
        os.path.join(scratch, "captures"))
    assert main(["--job-file", spec, "--captures", os.path.join(scratch, "captures"), "--feeds", feeds,
                 "--base-url", BASE, "--out", out, "--as-of", "2025-02-10T00:00:00"]) == 0
    assert {r.source for r in PUB.read_publications(spark, out).select("source").collect()} == {"cards", "rss"}
    with pytest.raises(SystemExit):
        main(["--out", out])


def test_only_wanted_pages_are_parsed(spark):
    """One extractor run for each spec; bodies cross an exchange only after
    they are restricted to the wanted URLs."""
    job = J.JOBS["mas-news"]
    captures = spark.createDataFrame([(lk.url, SEARCH_PAGE) for lk in job.links] + [("https://x.org/", SEARCH_PAGE)],
                                     "url string, html string")
    wanted = captures.join(J.link_manifest(spark, job, AS_OF).select("url").distinct(), "url", "left_semi")
    plan = PUB.latest_captures(wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftSemi")
    listed = PUB.search_publications(PUB.latest_captures(wanted), None, J._MAS, "news", "MAS", AS_OF)
    assert listed._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
