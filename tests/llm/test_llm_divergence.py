"""The source divergence audit against a plain re-implementation."""

import collections
import re

import pyarrow as pa
from pyspark.sql import types as T

from gazette.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, terms_kept=200):
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(UPPER))) for text, lang, source in rows]
    held = collections.Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (one, t), n in held.items() if one == lang and n >= 3]
        v = len(kept)

        def shares(wanted):
            c = collections.Counter(t for one, s, ts in docs if one == lang and wanted(s) for t in ts)
            total = sum(c[t] for t in kept)
            return {t: (c[t], 1 + 10**9 * (c[t] + 1) // (total + v)) for t in kept}

        sources = sorted({s for one, s, _ in docs if one == lang})
        p = {s: shares(lambda x, s=s: x == s) for s in sources}
        q = shares(lambda x: True)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t][1], p[o][t][1]) for t in kept)) for o in sources if o != s]
            above = [(t, f(p[s][t][1], q[t][1])) for t in kept if p[s][t][0] > 0 and p[s][t][1] > q[t][1]]
            for part, items in (("pair", pairs), ("term", above)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for i, (item, value) in enumerate(items):
                    if part == "pair" or i < terms_kept:
                        out.append((lang, s, part, item, value, i + 1))
    return sorted(out)


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "lang", "source", "term", "n", "shard", "idx", "p")])


def run(spark, rows):
    docs = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    got = divergence.audit(spark, docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in got.collect())


ROWS = [
    ("The cat and THE dog", "en", "a"),
    ("the cat, the cat; the cat 7", "en", "b"),
    ("the dog and the River", "en", "c"),
    ("the dog and the River", "en", "c"),
    (None, "en", "d"),
    ("", "en", None),
    ("der Hund", "de", "a"),
    ("der Hund und der Fluss", "de", "b"),
    ("12 34 ...", "fr", "a"),
    ("seul", "fr", "b"),
    ("zwei worte", None, "a"),
    ("zwei worte", None, None),
    ("zwei worte", "", "b"),
    ("Ünïcode Ünïcode ünïcode 日本語", "x y", "a b"),
    ("Ünïcode 日本語 İ", "x y", ""),
    ("Ünïcode 日本語", "x y", "é"),
    ("alone", "one", "a"),
    *[("zeile zeile", "a\nb", s) for s in "abc"],
    *[("zeile wort", "a%0Ab", s) for s in "abc"],
    *[("zeile", "a%", s) for s in "abc"],
    ("the " * 30_000 + "cat " * 20_000, "en", "a"),
]


def test_awkward_rows(spark):
    assert run(spark, ROWS) == brute(ROWS)
    assert run(spark, []) == []
    assert run(spark, [(None, None, None)]) == []


def test_shards_and_ranks(spark, monkeypatch):
    """Many terms over several vocabularies; ties by bytes; a bounded list of terms."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", 40)
    monkeypatch.setattr(divergence, "TERMS", 7)
    rows = []
    for i in range(120):
        words = [f"w{chr(97 + (i * k) % 26)}{chr(97 + (i + k) % 23)}" for k in range(12)]
        rows.append((" ".join(words), ("en", "de")[i % 5 == 0], f"s{i % 3 if i % 3 else 0}"))
    assert run(spark, rows) == brute(rows, 7)
    assert run(spark, ROWS) == brute(ROWS, 7)


def test_larger_group_tables_are_salted(spark, monkeypatch):
    monkeypatch.setattr("gazette.llm.common.SMALL_TABLE", 0)
    assert run(spark, ROWS) == brute(ROWS)


def test_terms_are_counted_before_they_are_transformed():
    """A document's row holds each term once; a group's rows hold a term once for each
    binary digit of its count, so that frequent terms cost no more than their digits."""
    texts = ["the cat the", "the " * 1000 + "dog", "", "the"]
    columns = [pa.array(x) for x in (["en"] * 4, ["a", "b", "b", "a"], texts, ["en"] * 4)]
    batch = pa.RecordBatch.from_arrays(columns, ["lang", "source", "text", "key"])
    found = [r for out in divergence._dealt(3)([batch]) for r in out.to_pylist()]
    documents = collections.Counter(t for r in found if not r["counted"] for t in r["terms"].split("\n"))
    assert documents == {"en the": 3, "en cat": 1, "en dog": 1}
    sums, size = collections.Counter(), 0
    for r in found:
        for term in r["terms"].split("\n") if r["counted"] else []:
            sums[r["source"], term] += r["weight"]
            size += 1
    assert sums == {("a", "en the"): 3, ("a", "en cat"): 1, ("b", "en the"): 1000, ("b", "en dog"): 1}
    assert size == sum(n.bit_count() for n in sums.values())


def test_rows_for_the_fit_do_not_grow_with_documents():
    """A block gives a language's terms up to three rows, one for each document that holds
    them, so a term has three rows over all blocks exactly if three documents hold it."""

    def batch(texts, langs):
        columns = [pa.array(x) for x in (langs, [""] * len(texts), texts, langs)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "text", "key"])

    def fitted(*batches):
        found = [r for out in divergence._dealt(1)(list(batches)) for r in out.to_pylist() if not r["counted"]]
        return found, collections.Counter(t for r in found for t in r["terms"].split("\n"))

    many = batch(["the cat"] * 500 + ["the dog"] * 2 + ["the the the"], ["en"] * 502 + ["de"])
    found, rows = fitted(many)
    assert rows == {"en the": 3, "en cat": 3, "en dog": 2, "de the": 1} and len(found) == 4
    one = [batch([x], ["en"]) for x in ("the cat cat cat", "the dog", "the dog", "", "the")]
    found, rows = fitted(*one)
    assert rows == {"en the": 4, "en cat": 1, "en dog": 2}
