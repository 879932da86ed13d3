"""Feed files with malformed items, linked files, free-form JSON."""

import os

import pytest
from pyspark.sql import functions as F

from gazette.functions import variant as J
from gazette.plans import publications as PUB
from gazette.sources import feed as FD
from gazette.sources import files as FL

GOOD = '<item><title>{0}</title><link>https://e.com/{0}</link><pubDate>Mon, 01 Jan 2024 00:00:00 +0000</pubDate></item>'


def write(folder, name, data):
    os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def test_a_malformed_item_loses_only_itself(spark, scratch):
    cdata = GOOD.format("four").replace("</item>", "<description><![CDATA[</item> <item> <!-- ]]></description></item>")
    feed = "".join(
        [
            '<?xml version="1.0"?><rss><channel><title>T</title><items>no item</items>',
            GOOD.format("one"),
            GOOD.format("bad1").replace("</link>", "</lnk>"),
            "<!-- " + GOOD.format("commented") + " -->",
            GOOD.format("two & bad2"),
            GOOD.format("bad3").replace("</item>", ""),
            GOOD.format("three"),
            cdata,
            "<item/>",
            '<item rdf:about="x">\n<title>five</title></item >',
            GOOD.format("cut")[:40],
        ]
    )
    write(scratch, "a.xml", feed)
    write(scratch, "empty.xml", "<rss><channel></channel></rss>")
    write(scratch, "latin.xml", ('<?xml version="1.0" encoding="ISO-8859-1"?><rss>' + GOOD.format("caf\xe9") + "</rss>").encode("latin-1"))
    write(scratch, "broken.xml", b"<rss>" + GOOD.format("x").encode().replace(b"<title>x", b"<title>\xff\xfe") + b"</rss>")
    got = [r for r in FD.read_feeds(spark, scratch).collect()]
    a = [r for r in got if r.feed.endswith("a.xml")]
    assert {r.title for r in a if r.malformed is None} == {"one", "three", "four", "five", None}
    bad = [r for r in a if r.malformed is not None]
    assert sorted(w for w in ("bad1", "bad2", "bad3", "cut") for r in bad if f">{w}" in r.malformed or f"& {w}" in r.malformed) == ["bad1", "bad2", "bad3", "cut"]
    assert len(bad) == 4 and all(r.title is None and r.link is None for r in bad)
    assert [r.title for r in got if "latin" in r.feed] == ["caf\xe9"]
    assert [r.title for r in got if "broken" in r.feed] == ["��"]
    cands = PUB.feed_publications(FD.read_feeds(spark, scratch))
    rejects = cands.filter("array_contains(reasons, 'malformed_item')")
    assert rejects.count() == 4 and rejects.filter("malformed IS NULL").count() == 0
    # published, the reject's detail holds the text
    table = os.path.join(scratch, "t")
    PUB.publish([("feeds", cands), ("none", cands.drop("malformed").limit(0))], table)
    details = [r.detail for r in PUB.read_rejects(spark, table).collect()]
    assert sum("malformed_item" in str(d) or "<lnk>" in str(d) or "</lnk>" in str(d) for d in details) >= 1


def test_very_long_items(spark):
    text = "<rss><item><title>" + "word " * 300_000 + "</title></item>" + "<item>" * 2_000 + GOOD.format("last") + "</rss>"
    df = spark.createDataFrame([(text,)], "t string").select(F.explode(FD.feed_items("t")).alias("i"))
    sizes = [len(r.i) for r in df.collect()]
    assert sizes[0] > 1_500_000 and len(sizes) == 2_002


def test_linked_files_are_opened_only_if_wanted(spark, scratch):
    kinds = {
        "p.pdf": (b"%PDF-1.7 x", "pdf"), "z.zip": (b"PK\x03\x04..", "zip"), "i.png": (b"\x89PNG\r\n\x1a\n..", "png"),
        "j.jpg": (b"\xff\xd8\xff\xe0", "jpeg"), "g.gif": (b"GIF89a", "gif"), "h.html": (b"\n <!DOCTYPE HTML><p>", "html"),
        "b.html": (b"\xef\xbb\xbf<html>", "html"), "x.xml": (b"<?xml version='1.0'?>", "xml"), "t.txt": (b"caf\xe9 \xff", "text"),
        "n.bin": (b"ab\x00c", "binary"), "d.doc": (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "ole"),
    }
    for name, (data, _) in kinds.items():
        write(scratch, f"deep/{name}", data)
    files = FL.list_files(spark, scratch)
    assert {(r.name, r.length) for r in files.collect()} == {(n, len(d)) for n, (d, _) in kinds.items()}
    links = spark.createDataFrame([(f"https://e.com/{n}", n) for n in [*kinds, "gone.pdf"]] + [(None, None)], "url string, n string")
    found = FL.linked_files(files, links, F.col("n"))
    assert found.count() == len(kinds) + 2
    rows = FL.with_contents(found, FL.HEAD).withColumn("kind", FL.file_kind("content")).collect()
    assert {r.n: r.kind for r in rows if r.path} == {n: k for n, (_, k) in kinds.items()}
    assert all(r.kind is None and r.content is None for r in rows if r.path is None)
    # an unwanted file that is gone is not missed
    kept = spark.createDataFrame(found.collect(), found.schema)
    os.remove(os.path.join(scratch, "deep", "z.zip"))
    assert [bytes(r.content) for r in FL.with_contents(kept.filter("n = 'p.pdf'"), 4).collect()] == [b"%PDF"]


def test_the_listing_reads_no_content(spark, scratch, capsys):
    write(scratch, "a.txt", "x" * 100)
    FL.list_files(spark, scratch).explain()
    plan = capsys.readouterr().out
    assert "content" not in plan.split("ReadSchema", 1)[1]


@pytest.mark.parametrize(
    "text, k, kind",
    [
        ('{"k": 5}', 5, "object"), ('{"meta": {"k": 7}}', 7, "object"), ('{"k": "9"}', 9, "object"), ('{"k": "x", "meta": {"k": 2}}', 2, "object"),
        ('{"k": null, "meta": {"k": 3}}', 3, "object"), ('{"k": 99999999999999999999}', None, "object"), ('{"k": {"k": 1}}', None, "object"),
        ("[1, 2]", None, "array"), ('"k"', None, "string"), ("12", None, "number"), ("1e400", None, None), ("true", None, "boolean"),
        ("null", None, "null"), ('{"k": ', None, None), ("", None, None), (None, None, None), ('{"a": 1, "a": 2}', None, None),
        ('{"k": 1} x', 1, "object"),
    ],
)
def test_variant_fields(spark, text, k, kind):
    df = spark.createDataFrame([(text,)], "props string")
    row = J.decode(df, "props", {"k": (["$.k", "$.meta.k"], "bigint")}).first()
    assert row.k == k and (row.json_kind == kind or text == "1e400")
