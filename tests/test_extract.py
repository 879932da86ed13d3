"""The HTML extractor and the site specs, on invented pages."""

from fixtures import (
    CARD_LISTING,
    DETAIL_NO_LIST,
    DETAIL_RATES,
    DL_BODY_PAGE,
    DL_PAGE,
    RELATED_DETAIL,
    SEARCH_PAGE,
)

from pyspark.sql import functions as F

from gazette.sources.extract import Field, SourceSpec, child, desc, extract
from gazette.sources.nodes import TEXT, page_nodes, read_nodes
from gazette.sources.specs import (
    ANCHORS,
    CARD_LIST,
    DL_CHILDREN,
    DL_DESCENDANTS,
    LINK_LIST,
    RELATED_CARDS,
    SEARCH_RESULTS,
)


def extract_page(spark, spec, page):
    """Status and items of one page."""
    df = spark.createDataFrame([("u", page)], "url string, html string")
    rows = sorted(extract(df, spec).collect(), key=lambda r: r.item_pos or 0)
    return rows[0].page_status, [r.asDict() for r in rows if r.item_pos is not None]


def test_tree_handles_unclosed_tags(spark):
    page = "<p><b>one<p>two<ul><li>a<li>b</ul><br><div>x</div>"
    own = lambda *steps: SourceSpec("t", items=steps, fields=(Field("t", (), "text()"), Field("lead", ())))
    assert [r["t"] for r in extract_page(spark, own(desc("li")), page)[1]] == ["a", "b"]
    assert [r["t"] for r in extract_page(spark, own(desc("p")), page)[1]] == [None, "two"]
    assert extract_page(spark, own(desc("ul"), child("li")), page)[1][1]["lead"] == "b"


def test_values_and_steps(spark):
    """The kinds of value, nested context nodes (each match once, in document
    order), children by number, and steps without a match."""
    page = (
        '<div class="k"><i>1</i>tail<div class="k"><a href="/x">in</a></div><a href="/y"><b>deep</b>after</a></div>'
        '<div id="n" class="k z"><p>p1</p><p>p2</p><p></p></div>'
    )

    def read(*fields, items=()):
        return extract_page(spark, SourceSpec("t", items=items, fields=fields), page)

    k = desc("div", class_contains="k")
    fields = (Field("lead", ()), Field("own", (), "text()"), Field("any", (), "alltext"), Field("id", (), "@id"))
    status, got = read(*fields, items=(k,))
    assert status == "ok" and [(r["lead"], r["own"], r["any"], r["id"]) for r in got] == [
        (None, "tail", "1", None), (None, None, "in", None), (None, None, "p1", "n"),
    ]
    links = Field("links", (k, desc("a")), "@href", many=True)
    second = Field("second", (desc("div", id="n"), child("p", nth=2)))
    none = Field("none", (desc("div", class_equals="k"), child("p")))
    far = Field("far", (child("div"), child("a"), child("b")), "text()")
    by_text = Field("by_text", (desc("a", text_contains="after"),), "@href")
    status, got = extract_page(
        spark, SourceSpec("t", whole_page=True, fields=(links, second, none, far, by_text)), page
    )
    assert status == "ok" and got == [
        {"url": "u", "page_status": "ok", "item_pos": 1, "links": ["/x", "/y"], "second": "p2", "none": None,
         "far": "deep", "by_text": "/y"}
    ]


def test_nodes_hold_the_page(spark):
    """Places, parents and last descendants; null, empty and long pages; keys
    pass through, batches of many pages stay whole."""
    pages = [None, "", "<p>a<b c=1 c=2>d</b>e<!-- x -->f</p>g", "<a href=/x>y</a>" * 40_000, "<div>" * 30_000 + "</i>" * 30_000]
    pages += [f"<p>{i}</p>" for i in range(500)]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, html string").coalesce(1)
    out = page_nodes(df, keys=("k",), attributes=("c",))
    got = {r.k: [tuple(n) for n in r.nodes] for r in out.filter("k < 3 OR k > 4").collect()}
    assert sorted(got) == [0, 1, 2, *range(5, 505)]
    assert got[0] == got[1] == [(0, -1, 0, "#root", None, None)]
    assert got[2] == [
        (0, -1, 6, "#root", None, None),
        (1, 0, 5, "p", None, None),
        (2, 1, 2, TEXT, "a", None),
        (3, 1, 4, "b", None, "2"),
        (4, 3, 4, TEXT, "d", None),
        (5, 1, 5, TEXT, "ef", None),
        (6, 0, 6, TEXT, "g", None),
    ]
    assert got[504][2] == (2, 1, 2, TEXT, "499", None)
    assert [r[0] for r in out.filter("k IN (3, 4)").orderBy("k").selectExpr("size(nodes)").collect()] == [80_001, 30_001]


def test_selection_stays_one_pass_without_shuffle(spark):
    """Selection is expressions: one Python pass a page, no shuffle, and a
    condition on the status does not select twice."""
    df = spark.createDataFrame([("u", DL_PAGE)], "url string, html string")
    plan = extract(df, DL_CHILDREN).filter("page_status = 'ok'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    below = plan[plan.index("Generate") :]
    assert "Filter" not in below


def test_card_list_spec(spark):
    status, items = extract_page(spark, CARD_LIST, CARD_LISTING)
    assert status == "ok" and len(items) == 7
    first = items[0]
    assert first["link"] == "/en/press/2025-01-29-rates.html"
    assert first["title"] == "Rates decision"  # text before the first child
    assert first["description"] == "29.01.2025: Decision on rates"
    assert items[2]["description"] is None
    assert items[6]["link"] is None


def test_card_list_without_container(spark):
    assert extract_page(spark, CARD_LIST, "<html><body><ul></ul></body></html>") == ("no_container", [])


def test_link_list_spec_first_link_per_item(spark):
    status, items = extract_page(spark, LINK_LIST, DETAIL_RATES)
    assert status == "ok"
    assert [i["href"] for i in items] == ["/files/a.pdf", "https://other.example.org/b.pdf", None, "c/d.html"]
    assert extract_page(spark, LINK_LIST, DETAIL_NO_LIST)[0] == "no_container"


def test_dl_children_spec(spark):
    status, items = extract_page(spark, DL_CHILDREN, DL_PAGE)
    assert status == "ok"
    assert len(items) == 3  # the extra dt has no dd
    assert items[0]["date_text"] == "9 January 2024"
    assert items[0]["title"] == "Account one"
    assert items[0]["related"] == ["/pdf/a1.en.pdf", "/pdf/a1.en.pdf?60b657", "/pdf/a1.de.pdf"]
    assert items[1]["related"] == []


def test_dl_children_body_container(spark):
    status, items = extract_page(spark, DL_CHILDREN, DL_BODY_PAGE)
    assert status == "ok" and [i["title"] for i in items] == ["Bare one", "Bare two"]


def test_dl_descendants_shift_on_nested_lists(spark):
    # the first form zips every dt with every dd of the page; nested lists
    # add pairs, which is why the second form is the default
    _, items = extract_page(spark, DL_DESCENDANTS, DL_PAGE)
    assert len(items) > 3


def test_search_results_spec(spark):
    status, items = extract_page(spark, SEARCH_RESULTS, SEARCH_PAGE)
    assert status == "ok" and len(items) == 4  # class must match exactly
    assert items[0]["date_text"] == "Date: 9 January 2024"
    assert items[0]["title"] == "Consultation paper"
    assert items[0]["category"] == "Banking"
    assert items[2]["date_text"] is None
    assert items[3]["category"] is None


def test_related_cards_spec(spark):
    _, items = extract_page(spark, RELATED_CARDS, RELATED_DETAIL)
    assert items[0]["pdf_links"] == ["/files/x.pdf", " /files/y.pdf "]
    assert items[0]["card_links"] == ["/regulation/related-1"]


def test_extract_on_spark_keeps_every_page(spark):
    df = spark.createDataFrame(
        [("u1", CARD_LISTING), ("u2", "<html></html>"), ("u3", None)], "url string, html string"
    )
    out = extract(df, CARD_LIST, keys=("url",)).collect()
    by_status = {}
    for r in out:
        by_status.setdefault(r.url, set()).add(r.page_status)
    assert by_status == {"u1": {"ok"}, "u2": {"no_container"}, "u3": {"no_container"}}
    assert sum(1 for r in out if r.url == "u1") == 7


def test_anchor_spec_counts_driver_pages(spark):
    from conftest import SF_SMALL

    from gazette.sources.tables import read_table

    pages = read_table(spark, SF_SMALL, "pages", "page_id", "html")
    n_spark = extract(pages, ANCHORS, keys=("page_id",)).filter("page_status = 'ok'").count()
    import re

    n_regex = sum(len(re.findall(r"<a\s[^>]*?href=", r.html)) for r in pages.collect())
    assert n_spark == n_regex


def test_hrefs_equal_the_extractor(spark):
    """The column expression and the parser read the same links."""
    from gazette.sources.extract import extract
    from gazette.sources.pages import page_hrefs
    from gazette.sources.specs import ANCHORS

    pages = [
        '<a href="/n">x</a><a href=\'/s\'>x</a><a href=/u>x</a><A HREF="/upper">x</A>',
        '<a href="/q?a=1&amp;b=2">x</a><!-- <a href="/c">no</a> --><a\n  class=k  href = "/nl">x</a>',
        '<a data-x="a > b" href="/attr">x</a><abbr href="/no">x</abbr><a name=top>x</a>',
        '<script>var s = "<a href=\'/js\'>";</script><a href="">x</a><a title=\'href="/t"\' href="/real">x</a>',
        "no links", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    got = {r.page_id: r.h for r in df.select("page_id", page_hrefs("html").alias("h")).collect()}
    want = {i: [] for i in range(len(pages))}
    items = extract(df.withColumn("url", F.lit("https://e.com/")), ANCHORS, keys=("page_id",))
    for r in sorted(items.filter("page_status = 'ok'").collect(), key=lambda r: r.item_pos):
        if r.href is not None:  # an anchor without one is no link
            want[r.page_id].append(r.href)
    assert {i: h or [] for i, h in got.items()} == want


def _shape(page):
    """The nodes that a reader holds."""
    texts = [t and "".join(t) for t in page.texts]
    return list(zip(page.tags, page.parents, page.lasts(), texts, page.attributes))


def test_short_way_builds_the_parsers_tree(spark):
    """Regular markup takes the short way; both ways give one tree, on random
    markup of regular and odd parts and on landed pages."""
    import random

    from gazette.sources import nodes as X

    parts = ["<div>", "</div>", "<p class='a b'>", "</p>", "<li>", "<ul>", "</ul>", "<br/>", "<br>", "text", " &amp; ", "&copy",
             '<a href="/x?a=1&amp;b=2">', "</a>", "<!-- c -->", "<!DOCTYPE html>", "<dt>", "<dd>", "<dl>", "</dl>", "<IMG SRC=a.png>",
             "<title>T &lt; <b></title>", "<title>plain &amp;</title>", "<script>if (a<b) { '</p>' }</script>", "<style>p{}</style>",
             "< ", "<3", "<a b=c/>", "<?pi?>", "<![CDATA[x]]>", "</ div>", "<a href='q\"'>", "<input disabled>", "<!-->", "<!---->",
             "<textarea><p></textarea>", "<x-y>", "<a\nhref = '/n'\n>", "</p x>", "<a href=/u/>", "<!-- a -- b -->", "<!-- a --!>"]
    rng = random.Random(6)
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    pages += [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    short = 0
    for page in pages:
        tree = _shape(read_nodes(page))
        b = X._Nodes()
        b.feed(page)
        b.close()
        assert tree == _shape(b), page
        b.start()
        short += X._feed_regular(b, page)
    assert short > 1000


def test_long_tags_and_stray_anchors(spark):
    """A crawl holds pages that no browser made; none may end the job."""
    from gazette.sources.pages import page_hrefs

    words = "word " * 100_000
    attributes = " ".join(f'k{i}="v{i}"' for i in range(20_000))
    pages = [
        "<a " + words,
        f'<a {attributes} href="/x">y</a>',
        "<a " * 50_000 + "<a href=/z>",
        f"<a title='{words}' href=/quoted>x</a>",
        "<!-- " + words + "<a href=/c>",
        '<a title="' + words,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    got = {r.page_id: r.h for r in df.select("page_id", page_hrefs("html").alias("h")).collect()}
    assert got == {0: [], 1: ["/x"], 2: ["/z"], 3: ["/quoted"], 4: [], 5: []}
