"""Date parsers against the standard library's strptime."""

import datetime as dt

import pytest

from gazette.functions import dates as D

RSS = [
    "Wed, 29 Jan 2025 12:00:00 GMT",
    "Wed, 29 Jan 2025 12:00:00 UTC",
    "wed, 2 jan 2025 7:5:9 gmt",
    "Wed, 29 Jan 2025 12:00:00 +0100",
    "Wed, 29 Jan 2025 12:00:00 CET",
    "29 Jan 2025 12:00:00 GMT",
    "Wed, 31 Feb 2025 12:00:00 GMT",
    "Wed, 29 Jan 2025 24:00:00 GMT",
    "Wed, 29 Jan 2025 12:60:00 GMT",
    "Wed,  22  Jan 2025 12:00:00   GMT",
    "",
    None,
]


def _py_rss(s):
    if s is None:
        return None
    try:
        return dt.datetime.strptime(s, "%a, %d %b %Y %H:%M:%S %Z")
    except ValueError:
        return None


def test_rss_matches_strptime(spark):
    df = spark.createDataFrame([(s,) for s in RSS], "s string")
    got = [r.t for r in df.select(D.parse_rss("s").alias("t")).collect()]
    assert got == [_py_rss(s) for s in RSS]


@pytest.mark.parametrize(
    "fn, fmt, values",
    [
        (D.parse_dotted, "%d.%m.%Y", ["29.01.2025", "2.1.2025", "31.02.2025", "2025-01-29", "29.01.25"]),
        (D.parse_iso_day, "%Y-%m-%d", ["2025-01-29", "2025-02-30", "29.01.2025", "2025-1-2"]),
        (D.parse_long_day, "%d %B %Y", ["9 January 2024", "09 January 2024", "31 February 2024", "9 Jan 2024"]),
    ],
)
def test_day_formats(spark, fn, fmt, values):
    def py(v):
        try:
            return dt.datetime.strptime(v, fmt)
        except ValueError:
            return None

    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.t for r in df.select(fn("s").alias("t")).collect()]
    expected = [py(v) for v in values]
    # Python's %Y-%m-%d takes one-digit month/day; Spark's yyyy-MM-dd does not
    if fmt == "%Y-%m-%d":
        expected = [e if v != "2025-1-2" else None for e, v in zip(expected, values)]
    assert got == expected


def test_card_date_rule(spark):
    rows = [
        ("https://e.com/press/2025-01-29-item.html", "01.02.2025: text"),  # URL wins
        ("https://e.com/press/item.html", "01.02.2025: text"),  # text fallback
        ("https://e.com/press/2025-13-45-item.html", "01.02.2025: text"),  # bad URL date: no fallback
        ("https://e.com/press/item.html", None),  # neither
    ]
    df = spark.createDataFrame(rows, "u string, d string")
    got = [r.t for r in df.select(D.card_date("u", "d").alias("t")).collect()]
    assert got == [dt.datetime(2025, 1, 29), dt.datetime(2025, 2, 1), None, None]


def test_epoch_round_trip_and_bounds(spark):
    df = spark.createDataFrame([(1738152000,)], "e long")
    r = df.select(D.from_epoch_seconds("e").alias("t")).select("t", D.to_epoch_seconds("t").alias("e2")).first()
    assert r.t == dt.datetime(2025, 1, 29, 12, 0, 0) and r.e2 == 1738152000
    as_of = dt.datetime(2025, 1, 29)
    edge = as_of + dt.timedelta(days=5)
    rows = [(edge,), (edge + dt.timedelta(seconds=1),), (dt.datetime(1975, 1, 1),), (dt.datetime(1974, 12, 31, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r.r for r in df.select(D.date_bounds_reasons("t", as_of).alias("r")).collect()]
    assert got == [[], ["date_in_future"], [], ["date_too_old"]]


def test_rss_fuzz_against_strptime(spark):
    """4,000 combinations of weekday/day/month/year/time/zone spellings,
    valid and not, parsed in one job and compared with strptime."""
    import itertools
    import random

    parts = (
        ["Wed", "wed", "WED", "Monday", "Xyz"],
        ["1", "01", "22", "31", "32", "0", " 5"],
        ["Jan", "jan", "JAN", "Feb", "Sept", "Foo"],
        ["2025", "25", "02025"],
        ["12:00:00", "7:5:9", "24:00:00", "12:60:00", "23:59:59", "12:00:60", "12:00"],
        ["GMT", "UTC", "gmt", "CET", "+0100", ""],
        [", ", ",  ", " , "],
    )
    cands = [f"{w}{s}{d} {m} {y} {t} {z}".rstrip() for w, d, m, y, t, z, s in itertools.product(*parts)]
    cands = random.Random(3).sample(cands, 4000)
    df = spark.createDataFrame([(c,) for c in cands], "s string")
    got = {r.s: r.t for r in df.select("s", D.parse_rss("s").alias("t")).collect()}
    assert [s for s in cands if got[s] != _py_rss(s)] == []


def test_card_date_fuzz(spark):
    """Cards put together from parts whose date is known when they are chosen:
    the URL's date part decides, also when it is no date; else the text's."""
    import random

    rnd = random.Random(9)
    day = dt.datetime(2023, 3, 14)
    url_parts = [("", "none"), ("2023-03-14-", day), ("2023-13-01-", None), ("2023-02-30-", None), ("2023-3-4-", "none")]
    texts = [(None, None), ("14.03.2023: t", day), ("14.3.2023: t", day), (" 14.03.2023 :t", day),
             ("31.02.2023: t", None), ("no date", None), ("14.03.2023", day)]
    rows, want = [], []
    for _ in range(2000):
        part, url_day = rnd.choice(url_parts)
        text, text_day = rnd.choice(texts)
        rows.append((len(rows), f"https://e.com/{rnd.choice(['press/', 'a/b/'])}{part}{rnd.choice(['item.html', 'x'])}", text))
        want.append(text_day if url_day == "none" else url_day)
    got = spark.createDataFrame(rows, "i int, u string, d string").select("i", D.card_date("u", "d").alias("t")).collect()
    assert [rows[r.i] for r in got if r.t != want[r.i]] == []
