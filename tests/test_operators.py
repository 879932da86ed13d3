"""Operators: skew-safe ordinal and zip, top-N plan shape, fetch logs,
snapshots, dimension lookups, text helpers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gazette.operators import enrich as E
from gazette.operators import runs as R
from gazette.operators import select as S


def test_ordinal_within_matches_row_number_on_a_hot_key(spark):
    random.seed(7)
    rows = [(0 if random.random() < 0.4 else random.randint(1, 20), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k long, o long")
    got = {(r.k, r.o): r.ordinal for r in S.ordinal_within(df, ["k"], "o", "o", width=64).collect()}
    expected = {}
    for k in {r[0] for r in rows}:
        for pos, o in enumerate(sorted(o for kk, o in rows if kk == k), start=1):
            expected[(k, o)] = pos
    assert got == expected


def test_zip_pairs_stops_at_shorter_side(spark):
    left = spark.createDataFrame([(1, 0), (1, 2), (1, 4), (2, 0)], "c long, t long")
    right = spark.createDataFrame([(1, 1), (1, 3), (2, 1), (2, 3)], "c long, t long")
    out = S.zip_pairs(left.withColumnRenamed("t", "t"), right, ["c"], "t", "t")
    got = sorted((r.c, r.pair_idx) for r in out.collect())
    assert got == [(1, 1), (1, 2), (2, 1)]


def test_top_n_plans_a_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    top = S.top_n_per_group(df, ["k"], [F.col("id").desc()], 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.count() == 15


def test_fetch_resolution(spark):
    log = spark.createDataFrame(
        [
            ("u1", 1, 500, "x"), ("u1", 2, 200, "ok1"),
            ("u2", 1, 500, None), ("u2", 2, 404, None),
            ("u3", 7, 200, "too late"),
        ],
        "url string, attempt int, status int, body string",
    )
    got = {r.url: (r.status, r.attempt_used, r.body) for r in R.resolve_fetches(log).collect()}
    assert got == {"u1": ("ok", 2, "ok1"), "u2": ("failed", None, None), "u3": ("failed", None, None)}


def test_listing_fetch_rule_needs_body(spark):
    log = spark.createDataFrame(
        [("u", 1, 200, ""), ("u", 2, 200, "page")], "url string, attempt int, status int, body string"
    )
    ok = (F.col("status") < 400) & (F.length("body") > 0)
    got = R.resolve_fetches(log, success=ok, max_attempts=3).first()
    assert (got.status, got.attempt_used, got.body) == ("ok", 2, "page")


def test_snapshot_per_bucket(spark):
    t0 = dt.datetime(2025, 1, 1, 0, 0, 0)
    rows = [("k", t0 + dt.timedelta(seconds=s), i, f"v{i}") for i, s in enumerate([10, 5, 299, 300, 301])]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, v string")
    got = sorted((r.bucket, r.v) for r in R.snapshot_per_bucket(df, ["key"], "ts", "id", "v").collect())
    base = int(t0.replace(tzinfo=dt.timezone.utc).timestamp()) // 300
    assert got == [(base, "v1"), (base + 1, "v3")]


def test_all_or_nothing(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True)], "g long, ok boolean")
    assert [r.g for r in R.all_or_nothing(df, "g", F.col("ok")).collect()] == [2]


def test_regulator_dimension_case_insensitive(spark):
    dim = E.regulator_dimension(spark)
    df = spark.createDataFrame([("ecb",), ("MAS",), ("fed",)], "reg string")
    out = {r.reg: r.full_name for r in E.join_dimension(df, dim, "reg", "code", case_insensitive=True).collect()}
    assert out == {"ecb": "European Central Bank", "MAS": "Monetary Authority of Singapore", "fed": None}


def test_text_helpers(spark):
    from gazette.functions import text as T

    df = spark.createDataFrame([("   Title \t\n", "a&amp;lt;b &amp; c", "Ｆｕｌｌ")], "a string, b string, c string")
    r = df.select(T.strip_ws("a").alias("a"), T.unescape_basic("b").alias("b"), T.nfkc("c").alias("c")).first()
    assert r.a == "Title" and r.b == "a&lt;b & c" and r.c == "Full"
    assert r.a == "   Title \t\n".strip()


def test_valid_utf8_repair(spark):
    from gazette.functions import text as T

    df = spark.createDataFrame([(bytearray(b"ok \xff\xfe end"),)], "b binary")
    assert df.select(T.valid_utf8("b").alias("s")).first().s == b"ok \xff\xfe end".decode("utf-8", "replace")


def test_strip_fuzz_against_python(spark):
    from gazette.functions import text as T

    rnd = random.Random(9)
    ws = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    alpha = list("ab é✓") + ["​", "﻿", "\x00", "\x1f"]
    strs = ["".join(rnd.choice(ws + alpha) for _ in range(rnd.randint(0, 8))) for _ in range(3000)]
    got = [r.s for r in spark.createDataFrame([(x,) for x in strs], "x string").select(T.strip_ws("x").alias("s")).collect()]
    assert [a for a, b in zip(strs, got) if a.strip() != b] == []


def test_unknown_regulators_are_rejected(spark):
    rows = [("ecb", []), ("MAS", ["x"]), ("BOE", []), (None, [])]
    df = spark.createDataFrame(rows, "regulator string, reasons array<string>")
    got = {r.regulator: r.reasons for r in E.reject_unknown_regulators(df, spark).collect()}
    assert got == {"ecb": [], "MAS": ["x"], "BOE": ["unknown_regulator"], None: []}
