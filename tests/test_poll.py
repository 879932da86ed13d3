"""Polls with state, and the table of latest items that they merge into."""

import datetime as dt
import os
import random

import pytest
from fixtures import BASE, DL_PAGE
from pyspark.sql import functions as F

from gazette.operators import latest as M
from gazette.plans import publications as PUB
from gazette.streaming import poll as L
from gazette.streaming.incremental import landing_stream

AS_OF = dt.datetime(2025, 2, 10)
T0 = dt.datetime(2025, 1, 20)
CAPTURE = "url string, html string, fetched_at timestamp"


def transform(pages):
    return PUB.dl_publications(pages, BASE, "regulation", "ECB", as_of=AS_OF)


def land(spark, folder, rows, schema=CAPTURE):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


COLUMNS = ["listing_url", "item_pos", "web_title", "web_url"]


def shown(df):
    return sorted(map(str, map(tuple, df.select(*COLUMNS).collect())))


def test_polls_equal_a_batch_run(spark, scratch):
    """Late, repeated, undated, empty and unchanged captures, landed over three
    polls, the last of which starts from the checkpoint with two files."""
    landing, table, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    newer, emptied = DL_PAGE.replace("Account one", "Account one, corrected"), "<html><body><p>gone</p></body></html>"
    day = dt.timedelta(days=1)
    landings = [
        [("https://a.example.org/x", newer, T0), ("https://e.example.org/e", DL_PAGE, T0), (None, DL_PAGE, T0)],
        [("https://b.example.org/y", DL_PAGE, T0 - 10 * day), ("https://u.example.org/u", DL_PAGE, None)],
        [("https://a.example.org/x", DL_PAGE, T0 - 20 * day), ("https://c.example.org/z", DL_PAGE, T0 - 9 * day)],
        [("https://e.example.org/e", emptied, T0 + day), ("https://u.example.org/u", newer, T0 - 30 * day)],
        [("https://c.example.org/z", DL_PAGE, T0 + day), ("https://c.example.org/z", newer, T0), ("https://n.example.org/n", None, T0)],
    ]
    for polls in (landings[:1], landings[1:3], landings[3:]):
        for rows in polls:
            land(spark, landing, rows)
        stream = landing_stream(spark, landing, max_files_per_trigger=1)
        latest = L.poll_pages(spark, stream, transform, table, "t", ckpt)
    everything = spark.createDataFrame([r for rows in landings for r in rows], CAPTURE).filter("html IS NOT NULL")
    batch = transform(PUB.latest_captures(everything).drop("fetched_at"))
    got = L.latest_items(latest)
    assert shown(got) == shown(batch)
    pages = {r.listing_url for r in got.collect()}
    assert "https://e.example.org/e" not in pages or all("Account" not in (r.web_title or "") for r in got.filter("listing_url like '%e.example%'").collect())
    # nothing new: nothing is added
    before = latest.live()
    assert L.poll_pages(spark, landing_stream(spark, landing), transform, table, "t", ckpt).live() == before


def test_only_changed_pages_are_parsed(spark, scratch):
    landing, table, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    parsed = []

    def counting(pages):
        parsed.append(sorted(r.url for r in pages.select("url").collect()))
        return transform(pages)

    for i, rows in enumerate(
        [
            [("https://a/x", DL_PAGE, T0), ("https://b/x", DL_PAGE, T0)],
            [("https://a/x", DL_PAGE, T0 + dt.timedelta(days=1)), ("https://b/x", DL_PAGE + " ", T0 - dt.timedelta(days=1))],
            [("https://a/x", DL_PAGE + " ", T0 + dt.timedelta(hours=1)), ("https://b/x", DL_PAGE + " ", T0 + dt.timedelta(days=3))],
        ]
    ):
        land(spark, landing, rows)
        L.poll_pages(spark, landing_stream(spark, landing), counting, table, "t", ckpt)
    assert parsed == [["https://a/x", "https://b/x"], [], ["https://b/x"]]


def test_a_poll_that_dies_is_repeated_and_counts_once(spark, scratch):
    landing, table, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    land(spark, landing, [("https://a/x", DL_PAGE, T0)])
    L.poll_pages(spark, landing_stream(spark, landing), transform, table, "t", ckpt)
    land(spark, landing, [("https://a/x", DL_PAGE.replace("Account one", "Second"), T0 + dt.timedelta(days=1))])

    def broken(pages):
        return transform(pages).withColumn("web_title", F.raise_error(F.lit("worker lost")).cast("string"))

    with pytest.raises(Exception, match="worker lost"):
        L.poll_pages(spark, landing_stream(spark, landing), broken, table, "t", ckpt)
    latest = M.LatestTable(spark, table, **L.page_rules())
    assert latest.polls() == 0 and not any("Second" in x for x in shown(L.latest_items(latest)))
    latest = L.poll_pages(spark, landing_stream(spark, landing), transform, table, "t", ckpt)
    assert any("Second" in x for x in shown(L.latest_items(latest)))
    # the marker was made, but the stream did not get to know: the same poll comes again
    assert latest.append(latest.read(), latest.polls()) is False
    with pytest.raises(L.ForeignTable):
        L.poll_pages(spark, landing_stream(spark, landing), transform, table, "t", os.path.join(scratch, "other"))


def test_merging_deltas_is_top_n_of_all(spark, scratch, monkeypatch):
    monkeypatch.setattr(M, "COMPACT_AFTER", 3)
    rng = random.Random(3)
    rows = [(f"l{rng.choice([0, 0, 0, 1, 2, 3])}", rng.randrange(40), i) for i in range(400)] + [("l9", None, 400), (None, 5, 401)]
    rng.shuffle(rows)
    order = [F.col("at").desc_nulls_last(), F.col("id").asc()]
    table = M.LatestTable(spark, os.path.join(scratch, "t"), link="link", order=order, per_link=5, captured=None)
    assert table.read() is None and table.polls() == -1
    seen = 0
    for poll in range(8):
        part = rows[seen : seen + 51]
        seen += 51
        assert table.append(spark.createDataFrame(part, "link string, at int, id int"), poll)
        assert len(table.live()) <= 4
        best = {}
        for link, at, i in rows[:seen]:
            best.setdefault(link, []).append((at is None, -(at or 0), i))
        want = sorted(str((k, x[2])) for k, v in best.items() for x in sorted(v)[:5])
        assert sorted(str((r.link, r.id)) for r in table.read().collect()) == want
    size = sum(1 for run in table.live() for _ in open(os.path.join(scratch, "t", f"run={run}", "_SUCCESS"), "rb")) or len(table.live())
    assert size <= 4
    live, kept = table.live(), table.read().count()
    gone = table.expire()
    assert gone and not set(gone) & set(live) and table.live() == live and table.read().count() == kept


def test_a_frequent_link_is_cut_before_the_shuffle(spark, capsys):
    rows = spark.range(1000).select((F.col("id") % 3).alias("link"), F.col("id").alias("at"))
    M.merge(rows, order=[F.col("at").desc()], per_link=10, captured=None).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
