"""Validation boundaries: the original unit cases plus edges."""

import datetime as dt

from pyspark.sql import functions as F

from gazette.operators import validate as V

NOW = dt.datetime(2025, 1, 29, 12, 0, 0)


def _reasons(spark, rows, as_of=NOW):
    df = spark.createDataFrame(
        rows, "web_title string, published_at timestamp_ntz, web_url string, related array<string>"
    )
    r = V.publication_reasons("web_title", "published_at", "web_url", "related", as_of)
    return [x.r for x in df.select(r.alias("r")).collect()]


def test_valid_publication(spark):
    assert _reasons(spark, [("Harbour dues for barges", NOW, "https://port.example.org/dues", ["https://port.example.org/dues.pdf"])]) == [[]]


def test_title_bounds(spark):
    rows = [(t, NOW, "https://example.com", []) for t in ("ab", "abc", "a" * 500, "a" * 501)]
    assert _reasons(spark, rows) == [["title_length"], [], [], ["title_length"]]


def test_date_bounds(spark):
    edge = NOW + dt.timedelta(days=5)
    rows = [
        ("Test", edge, "https://example.com", []),
        ("Test", edge + dt.timedelta(seconds=1), "https://example.com", []),
        ("Test", NOW + dt.timedelta(days=2), "https://example.com", []),  # within the 5-day window
        ("Test", dt.datetime(1974, 12, 31), "https://example.com", []),
    ]
    assert _reasons(spark, rows) == [[], ["date_in_future"], [], ["date_too_old"]]


def test_url_and_related(spark):
    rows = [
        ("Test", NOW, "invalid-url", []),
        ("Test", NOW, "https://example.com", [f"https://example.com/{i}" for i in range(50)]),
        ("Test", NOW, "https://example.com", [f"https://example.com/{i}" for i in range(51)]),
        ("Test", NOW, "https://example.com", ["https://example.com/a", "not a url"]),
        (None, None, None, None),
    ]
    assert _reasons(spark, rows) == [
        ["invalid_url"],
        [],
        ["invalid_related_urls"],
        ["invalid_related_urls"],
        ["missing:web_title", "missing:published_at", "missing:web_url"],
    ]


def test_split_keeps_every_row(spark):
    rows = [("Test", NOW, "https://example.com", []), ("ab", NOW, "bad", [])]
    df = spark.createDataFrame(rows, "web_title string, published_at timestamp_ntz, web_url string, related array<string>")
    df = df.withColumn("reasons", V.publication_reasons("web_title", "published_at", "web_url", "related", NOW))
    valid = df.filter(F.size("reasons") == 0)
    rejects = V.reject_rows(df, F.lit("t"), "web_url")
    assert valid.count() == 1
    assert sorted(r.reason for r in rejects.collect()) == ["invalid_url", "title_length"]
    assert {r.reason: r.n for r in V.reason_summary(rejects).collect()} == {"invalid_url": 1, "title_length": 1}
