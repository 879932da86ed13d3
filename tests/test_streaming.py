"""Incremental runs over a landing folder."""

import datetime as dt
import os

from fixtures import BASE, CARD_LISTING, DL_PAGE

from gazette.plans import publications as PUB
from gazette.streaming.incremental import read_latest, run_incremental

AS_OF = dt.datetime(2025, 2, 10)


def _land(spark, folder, name, rows):
    """Write to a staging folder, then move the finished file into the
    watched folder (landing is atomic per file)."""
    staging = folder + "-staging-" + name
    df = spark.createDataFrame(rows, "url string, html string, fetched_at timestamp")
    df.coalesce(1).write.mode("overwrite").parquet(staging)
    os.makedirs(folder, exist_ok=True)
    for f in os.listdir(staging):
        if f.endswith(".parquet"):
            os.replace(os.path.join(staging, f), os.path.join(folder, f"{name}-{f}"))


def test_available_now_processes_each_file_once(spark, scratch):
    landing = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    t = dt.datetime(2025, 2, 1, 8, 0)

    def transform(pages):
        return PUB.card_publications(pages, None, BASE, AS_OF)

    _land(spark, landing, "p", [(f"{BASE}/en/press", CARD_LISTING, t)])
    run_incremental(spark, landing, transform, out, "bank-news", "cards", checkpoint=ckpt)
    first = spark.read.parquet(out)
    assert first.count() == 7
    assert {r.batch_id for r in first.select("batch_id").distinct().collect()} == {0}

    # nothing new: a second run writes nothing
    run_incremental(spark, landing, transform, out, "bank-news", "cards", checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 7

    # a new file: only it is processed, in the next batch
    _land(spark, landing, "q", [(f"{BASE}/en/press-2", CARD_LISTING, t + dt.timedelta(days=3))])
    run_incremental(spark, landing, transform, out, "bank-news", "cards", checkpoint=ckpt)
    again = spark.read.parquet(out)
    assert again.count() == 14
    ids = {r.batch_id for r in again.select("batch_id").distinct().collect()}
    assert len(ids) == 2 and 0 in ids  # epochs may skip no-data batches


def test_recaptured_url_counts_once_in_a_batch(spark, scratch):
    landing = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    t = dt.datetime(2025, 2, 1, 8, 0)

    def transform(pages):
        return PUB.dl_publications(pages, BASE, "regulation", "ECB", as_of=AS_OF)

    rows = [(f"{BASE}/press/accounts", DL_PAGE, t), (f"{BASE}/press/accounts", DL_PAGE, t + dt.timedelta(hours=1))]
    _land(spark, landing, "p1", rows)
    run_incremental(spark, landing, transform, out, "ecb-regulations", "dl", checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 3  # one page, three items


def test_late_and_repeated_captures_match_a_batch_run(spark, scratch):
    """Landings weeks older than the newest are published; a page captured
    again shows its latest capture, whatever the order of landing."""
    landing, out, ckpt = (os.path.join(scratch, x) for x in ("landing", "out", "ckpt"))
    t = dt.datetime(2025, 1, 20)

    def transform(pages):
        return PUB.dl_publications(pages, BASE, "regulation", "ECB", as_of=AS_OF)

    newer = DL_PAGE.replace("Account one", "Account one, corrected")
    landings = [
        [("https://a.example.org/x", newer, t)],
        [("https://b.example.org/y", DL_PAGE, t - dt.timedelta(days=10))],
        [("https://a.example.org/x", DL_PAGE, t - dt.timedelta(days=20)), ("https://c.example.org/z", DL_PAGE, t - dt.timedelta(days=9))],
    ]
    for i, rows in enumerate(landings):
        _land(spark, landing, f"p{i}", rows)
        run_incremental(spark, landing, transform, out, "ecb-regulations", "dl", checkpoint=ckpt)
    columns = ["listing_url", "item_pos", "web_title", "web_url"]
    everything = spark.createDataFrame([r for rows in landings for r in rows], "url string, html string, fetched_at timestamp")
    batch = transform(PUB.latest_captures(everything).drop("fetched_at"))
    want = sorted(map(tuple, batch.select(*columns).collect()), key=str)
    got = sorted(map(tuple, read_latest(spark, out).select(*columns).collect()), key=str)
    assert got == want and len({r[0] for r in got}) == 3
    assert any("corrected" in (r[2] or "") for r in got)


def test_feed_files_stream_once_each(spark, scratch):
    from fixtures import RSS_FEED

    from gazette.streaming.incremental import feed_stream

    landing = os.path.join(scratch, "feeds")
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    os.makedirs(landing)

    def transform(entries):
        return PUB.feed_publications(entries, AS_OF)

    def run():
        run_incremental(spark, None, transform, out, "bank-feed", "feed", checkpoint=ckpt,
                        stream=feed_stream(spark, landing))

    with open(os.path.join(landing, "a.xml"), "w") as f:
        f.write(RSS_FEED)
    run()
    assert spark.read.parquet(out).count() == 6
    run()  # nothing new
    assert spark.read.parquet(out).count() == 6
    with open(os.path.join(landing, "b.xml"), "w") as f:
        f.write(RSS_FEED)
    run()
    got = spark.read.parquet(out)
    assert got.count() == 12 and got.filter("status = 'valid'").count() == 2
