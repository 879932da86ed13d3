"""URL columns against the standard library's urljoin/urlparse."""

from urllib.parse import urljoin, urlparse


from gazette.functions import urls as U

ROOTS = ["https://www.example.com", "http://example.org"]
HREFS = [
    "/a/b.html",
    "/a/b.pdf?x=1#top",
    "a/b",
    "../a",
    "./a/./b",
    "/a/./b/../c",
    "/a//b",
    "/a/b/..",
    "/a/b/.",
    "//cdn.example.net/x.js",
    "https://other.example.com/p?q",
    "http://plain.example.com/",
    "https:/x",
    "https:x",
    "mailto:someone@example.com",
    "#frag",
    "?q=1",
    "",
    "/a?#f",
    "/a?",
    "/a#",
    "https://www.example.com/a?",
    "/x/y?u=http://z/..",
    "/..",
    "..",
    "/en/2024-01-22-item.html",
]


def test_resolve_matches_stdlib(spark):
    rows = [(r, h) for r in ROOTS for h in HREFS]
    df = spark.createDataFrame(rows, "root string, href string")
    got = {(r.root, r.href): r.out for r in df.select("root", "href", U.resolve_url("href", "root").alias("out")).collect()}
    for r, h in rows:
        assert got[(r, h)] == urljoin(r, h), (r, h)


def test_resolve_null(spark):
    df = spark.createDataFrame([("https://e.com", None)], "root string, href string")
    assert df.select(U.resolve_url("href", "root").alias("o")).first().o is None


def test_url_parts_match_stdlib(spark):
    urls = [
        "https://user@www.example.com:8080/a/b.html?x=1&y=2#frag",
        "http://example.com",
        "ftp://files.example.com/pub/",
        "https://example.com/path%20with%20space?",
        "invalid-url",
        "//no-scheme.example.com/x",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select(
        "u", U.scheme("u").alias("s"), U.netloc("u").alias("n"), U.path("u").alias("p"),
        U.query("u").alias("q"), U.fragment("u").alias("f"),
    ).collect()
    for r in got:
        p = urlparse(r.u)
        assert (r.s, r.n, r.f, r.q) == (p.scheme, p.netloc, p.fragment, p.query), r.u
        assert r.p == p.path + (";" + p.params if p.params else ""), r.u


def test_valid_and_prefix_and_suffix(spark):
    df = spark.createDataFrame(
        [("https://example.com/article",), ("invalid-url",), ("https://example.com/a/File.PDF?x=1",), (None,)], "u string"
    )
    out = df.select(U.is_valid_url("u").alias("v"), U.has_http_prefix("u").alias("h"),
                    U.path_ends_with("u", ".pdf").alias("pdf")).collect()
    assert [r.v for r in out] == [True, False, True, False]
    assert [r.h for r in out] == [True, False, True, False]
    assert [r.pdf for r in out] == [False, False, True, False]


def test_english_only(spark):
    urls = [
        "https://e.com/pdf/a~1.en.pdf",
        "https://e.com/pdf/a~1.en.pdf?60b65716",
        "https://e.com/pdf/a~1.de.pdf",
        "https://e.com/pdf/b.en.html",
    ]
    df = spark.createDataFrame([(urls,)], "u array<string>")
    got = df.select(U.english_only("u", ".en.").alias("o")).first().o
    assert got == sorted({u.split("?")[0] for u in urls if ".en." in u.split("?")[0]})


def test_resolve_fuzz_against_stdlib(spark):
    """4,000 random hrefs (dot segments, empty segments, queries, fragments,
    scheme-relative, other schemes) resolved in one job, compared with urljoin."""
    import random

    rnd = random.Random(11)
    parts = ["a", "b", "..", ".", "", "x.pdf", "y.en.html", "%20", "~z", "c;p"]

    def gen():
        kind = rnd.random()
        segs = "/".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5)))
        q = ("?" + rnd.choice(["", "q=1", "a=b&c=/d/..", "#"])) if rnd.random() < 0.3 else ""
        f = ("#" + rnd.choice(["", "top", "x/../y"])) if rnd.random() < 0.2 else ""
        prefix = rnd.choice(["/", "", "//cdn.example.net/", "https://o.example.org/", "http://o.example.org/",
                             "https:", "mailto:", "./", "../", "//", "///"])
        return prefix + segs + q + f

    rows = [(rnd.choice(ROOTS), gen()) for _ in range(4000)]
    df = spark.createDataFrame(rows, "root string, href string")
    bad = [
        (r.root, r.href, r.o)
        for r in df.select("root", "href", U.resolve_url("href", "root").alias("o")).collect()
        if r.o != urljoin(r.root, r.href)
    ]
    assert bad == []


def test_pdf_suffix_fuzz_against_urlparse(spark):
    import random

    rnd = random.Random(4)
    heads = ["https://e.com", "http://e.com:8080", "", "//cdn.e.com", "file:", "https://u@e.com"]
    paths = ["/a.pdf", "/A.PDF", "/a.pdf/", "/a.pdfx", "/dir.pdf/a", "/a.Pdf;v=1", "/a", "", "/x.pdf.html"]
    tails = ["", "?f=b.pdf", "#p.pdf", "?q=1#x", "?"]
    urls = [rnd.choice(heads) + rnd.choice(paths) + rnd.choice(tails) for _ in range(2000)]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r.u: r.p for r in df.select("u", U.path_ends_with("u", ".pdf").alias("p")).collect()}
    assert [u for u in urls if got[u] != urlparse(u).path.lower().endswith(".pdf")] == []


def test_english_only_fuzz(spark):
    import random

    rnd = random.Random(8)
    pool = ["https://e.com/a.en.pdf", "https://e.com/a.en.pdf?x=1", "https://e.com/a.de.pdf", "https://e.com/en/a",
            "https://e.com/b.en.html?v=2#f", "https://e.com/b.en.html", "https://e.com/x.EN.pdf", "?.en.", ""]
    lists = [[rnd.choice(pool) for _ in range(rnd.randint(0, 6))] for _ in range(1000)]
    df = spark.createDataFrame([(i, xs) for i, xs in enumerate(lists)], "i int, u array<string>")
    got = {r.i: r.o for r in df.select("i", U.english_only("u", ".en.").alias("o")).collect()}
    for i, xs in enumerate(lists):
        assert got[i] == sorted({x.split("?")[0] for x in xs if ".en." in x.split("?")[0]}), xs
