"""Language ID, language-model scores, licences, URLs and search."""

import collections
import math
import pickle
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_ORACLE, SF_SMALL
from llm_tables import awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from gazette.llm import language_id as lang
from gazette.llm import licenses
from gazette.llm import lm_score as lm
from gazette.llm import topk_search as search
from gazette.llm import url_filters as urls
from gazette.llm.common import brief_shuffles, fold


def remainder(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % m


def test_language_accuracy(spark):
    got = lang.op1_language_id(spark, SF_ORACLE)
    truth = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if remainder(r.doc_id, 3) == 1}
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward(spark, awkward, nothing):
    model = lang.train(spark, awkward)
    rows = awkward.select("doc_id", "text", lang.predictor(model)(F.col("text")).alias("p")).collect()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.p.lang_pred, r.p.score) == ("und", 0.0)
        else:
            assert r.p.lang_pred in {"en", "de", "fr", "es"}
    none = lang.train(spark, nothing)
    assert awkward.select(lang.predictor(none)(F.col("text")).alias("p")).filter("p.lang_pred <> 'und'").count() == 0
    one = lang.train(spark, awkward.filter("lang = 'de'"))
    assert {r.p.lang_pred for r in awkward.select(lang.predictor(one)(F.col("text")).alias("p")).collect()} == {"de", "und"}


def test_gram_vector_does_not_depend_on_blocks(monkeypatch):
    text = "Größe und Länge der Wörter " * 50
    whole = lang.gram_vector(text)
    blocks = lang.blocks
    for size in (7, 50, 500):
        monkeypatch.setattr(lang, "blocks", lambda data, overlap, size=size: blocks(data, size, overlap))
        assert np.allclose(whole, lang.gram_vector(text))
    assert math.isclose(float(np.linalg.norm(whole)), 1, rel_tol=1e-9)


def brute_base(rows, m, out):
    counts = collections.Counter()
    docs = []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        held = remainder(doc_id, m) == out
        docs.append((doc_id, words, held))
        if not held:
            counts.update(words)
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for doc_id, words, held in docs:
        tokens = [*words, None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((doc_id, held, len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return want


def check_scores(got, want):
    order = lambda r: tuple((x is None, x) for x in r)
    got = sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=order)
    want = sorted(((*w[:5], round(w[5], 6)) for w in want), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-6, abs_tol=1e-5) for g, w in zip(got, want))


def test_lm_scores_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = lm.lm_score(spark, docs, lambda i: fold(i, 7) == 2).collect()
    check_scores(got, brute_base([(r.doc_id, r.text) for r in docs.collect()], 7, 2))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_awkward(spark, awkward, nothing):
    got = lm.lm_score(spark, awkward, lambda i: fold(i, 7) == 2).collect()
    check_scores(got, brute_base([(r.doc_id, r.text) for r in awkward.collect()], 7, 2))
    assert lm.lm_score(spark, nothing, lambda i: fold(i, 7) == 2).count() == 0
    blind = lm.lm_score(spark, awkward, lambda i: F.lit(True)).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in blind)


def test_lm_asks_in_packed_rows():
    """A block asks each section of the table in one row, which says for every document
    what it asks; a section's answer is what looking up each key alone gives."""
    rng = np.random.default_rng(1)
    d = np.repeat(rng.integers(-(2**62), 2**62, 40), 25)
    keys = rng.integers(0, 2**64, len(d), np.uint64)
    tf = rng.integers(1, 100_000, len(d))
    rows = lm._questions(d, keys, tf, 5)
    assert len(rows) == 32 and lm._questions(d[:0], keys[:0], tf[:0], 5) == []
    table = np.concatenate([keys[::3], rng.integers(0, 2**64, 500, np.uint64)])
    adds, count = rng.normal(size=len(table)), rng.integers(0, 3, len(table))
    own = {"id": [7], "d": [int(d[0])], "held_out": [True], "n_tokens": [4], "n_known": [1], "base": [-2.0], "score": [-1.0]}
    score, known, base = collections.Counter(), collections.Counter(), collections.Counter()
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    for row in rows:
        asked = pa.table(
            [*(pa.array([*own[c], None], k) for c, k in zip(lm._NAMES, kinds)), pa.array([row[0]] * 2, pa.int32()),
             *(pa.array([None, x], pa.binary()) for x in row[1:])],
            [*lm._NAMES, *lm._ASKS],
        )
        here = table >> np.uint64(59) == row[0]
        tail = pa.table({"key": table[here].view(np.int64), "adds": adds[here], "count": count[here]})
        first, *answers = lm._answer(asked, tail).to_pylist()
        assert first == {k: v[0] for k, v in own.items()}
        for a in answers:
            assert a["n_tokens"] is None
            score[a["d"]] += a["score"]
            known[a["d"]] += a["n_known"]
            base[a["d"]] += a["base"]
    at = {k: i for i, k in enumerate(table.tolist())}
    want = [(x, n, at[k]) for x, k, n in zip(d.tolist(), keys.tolist(), tf.tolist()) if k in at]
    for x in set(d.tolist()):
        mine = [(n, i) for y, n, i in want if y == x]
        assert math.isclose(score[x], sum(n * adds[i] for n, i in mine), rel_tol=1e-9, abs_tol=1e-6)
        assert known[x] == sum(n for n, i in mine if count[i] > 0)
        assert math.isclose(base[x], sum(n * math.log10(count[i] + 1) for n, i in mine), rel_tol=1e-9)


def test_broadcast_bitmaps_travel_compressed():
    bits = np.zeros(1 << 22, np.uint64)
    bits[::1000] = np.uint64(1) << np.uint64(63)
    data = pickle.dumps(lm.Bitmap(bits))
    assert len(data) < bits.nbytes / 50 and (pickle.loads(data).bits == bits).all()


def test_shuffle_files_end_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with brief_shuffles(spark):
        assert spark.conf.get(key) == "true"
        assert spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert spark.conf.get(key, None) == before


def test_tree_sums_to_one(spark):
    """In any context the chances of all tokens, the unknown included, add up to 1."""
    texts = ["red sky at night " * 3 + "sailor delight", "red sky at dawn sailor warn " * 4, "blue sea at night", "x y z"] * 6
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = docs.mapInArrow(lm._count_words, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    tree, n, v, ends = lm.train_tree(spark, docs, counted)
    assert len(tree.levels) == 2 and any(level.retained.any() for level in tree.levels)
    tokens = {w: i for w, i in tree.number.items()}
    for before in ([], ["at"], ["sky", "at"], ["zebra", "sky"], ["red", "zebra"]):
        ids = [tokens.get(w.encode(), -1) for w in before]
        known = sum(10 ** tree.logs(np.array([*ids, i]))[-1] for i in tokens.values())
        rest = 10 ** tree.logs(np.array([*ids, -1]))[-1] * tree.unknown / n
        assert math.isclose(known + rest, 1, rel_tol=1e-9)


def test_licences(spark, awkward, nothing):
    texts = {
        1: "Released under the MIT License. Under the MIT license! under-the-mit-license",
        2: "Licensed under the Apache License, Version 2.0.",
        3: "CC BY-NC 4.0, then cc by nd",
        4: "This work is licensed under the GNU General Public License, version 3.",
        5: "This very long winded collected work is licensed under the GNU General Public License, version 3.",
        6: None,
        7: "under the mit licenses; undér the mit license; under the  MIT\nlicense",
        8: licenses.TEMPLATES["mit-text"].replace("[[", "").replace("]]", ""),
        9: licenses.TEMPLATES["mit-text"].replace('[[(the "Software")]]', "").replace("[[", "").replace("]]", "").upper(),
        10: licenses.TEMPLATES["mit-text"].replace("sublicense", "not sublicense"),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: (r.n_words, {(m.label, m.first_word, m.template) for m in r.matches}) for r in licenses.license_scan(docs).collect()}
    assert got[1] == (13, {("mit", 1, False), ("mit", 5, False), ("mit", 9, False), ("mit-notice", 0, True)})
    assert got[2][1] == {("apache-2", 3, False), ("apache-2-notice", 0, True)}
    assert got[3][1] == {("cc-by-nc", 0, False)}
    assert got[4][1] == {("gpl-notice", 0, True)} and got[5][1] == set()
    assert got[6] == (0, set())
    assert got[7][1] == {("mit", 8, False)}
    assert {m[0] for m in got[8][1]} == {m[0] for m in got[9][1]} == {"mit-text"}
    assert got[10][1] == set()
    assert licenses.license_scan(awkward).count() == awkward.count() and licenses.license_scan(nothing).count() == 0


def test_template_automaton():
    machine = licenses.compile_template("one two [[three [four]]] {{x:1-2}} five")
    accept = lambda text: machine.accept(iter(text.encode().split()))
    assert accept("one two w five") == 4 and accept("one two w w five") == 5
    assert accept("one two three four w five") == 6
    assert accept("one two five") == 0 and accept("one two w w w five") == 0 and accept("one") == 0
    with pytest.raises(ValueError):
        licenses.compile_template("{{x:1-1}} five")


def test_licence_query_against_brute_force(spark):
    import re

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in licenses.op8_license_scan(spark, SF_SMALL).collect():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", docs[r.doc_id].encode().lower())
        places = [
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.encode().split()
        ]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (
            min((p[0] for p in places), default=None),
            max((p[0] for p in places), default=None),
        )
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def page_rows(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_url_rules_and_parts(spark):
    cases = {
        "HTTP://A.Example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/1": ("example.org", "/en/1", "example.org/en/1", "block"),
        "https://x.org/es/": ("x.org", "/es/", "org/", "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "https://x.com/fr/a": ("x.com", "/fr/a", "com/fr/", "allow"),
        "https://com/de/": ("com", "/de/", "com/de/", "block"),
        "https://x.org": ("x.org", "", None, "allow"),
        "https://x.net?a=/org/": ("x.net", "", None, "allow"),
        "no host here/es/": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(cases)]
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(spark, page_rows(spark, rows)).collect()}
    assert got == dict(enumerate(cases.values()))


def brute_ranks(seeds, edges, rounds):
    out_w, in_w = collections.Counter(), collections.Counter()
    for (a, b), w in edges.items():
        out_w[a] += w
        in_w[b] += w
    hosts = {*seeds, *(x for e in edges for x in e)}
    seed = {h: seeds.get(h, (0.0, 0.0)) for h in hosts}
    rank = dict(seed)
    for _ in range(rounds):
        new = {h: [(1 - urls.DAMPING) * s for s in seed[h]] for h in hosts}
        for (a, b), w in edges.items():
            new[b][0] += urls.DAMPING * rank[a][0] * w / out_w[a]
            new[a][1] += urls.DAMPING * rank[b][1] * w / in_w[b]
        rank = {h: tuple(x) for h, x in new.items()}
    return rank


def test_propagation_matches_brute_force(spark):
    seeds = {"good.org": (1.0, 0.0), "bad.com": (0.0, 1.0), "mixed.com": (0.5, 0.5)}
    edges = {("good.org", "a.net"): 3.0, ("good.org", "b.net"): 1.0, ("a.net", "b.net"): 2.0, ("c.net", "bad.com"): 5.0,
             ("b.net", "bad.com"): 1.0, ("d.net", "c.net"): 1.0, ("bad.com", "bad2.net"): 1.0}
    got = urls.propagate(
        spark,
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"),
        spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, w double"),
    )
    want = brute_ranks(seeds, edges, 600)
    rows = {r.host: (r.trust, r.distrust) for r in got.collect()}
    assert rows.keys() == want.keys()
    for host, pair in want.items():
        assert rows[host] == pytest.approx(pair, rel=1e-3, abs=1e-12)


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    """Thirty links from the only blocked seed, and a ring that settles slowly."""
    edges = {(f"h{i + 1}", f"h{i}"): 1.0 for i in range(30)}
    edges |= {("r0", "r1"): 1.0, ("r1", "r0"): 1.0, ("r1", "h30"): 1.0}
    seeds = {"h0": (0.0, 1.0), "r0": (0.2, 0.0)}
    got = urls.propagate(
        spark,
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"),
        spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, w double"),
    )
    want = brute_ranks(seeds, edges, 600)
    rows = {r.host: (r.trust, r.distrust) for r in got.collect()}
    assert rows["h29"][1] > 0 and rows["r1"][1] > 0
    for host, pair in want.items():
        assert rows[host] == pytest.approx(pair, rel=1e-3, abs=1e-12)


def test_links_decide_hosts_without_rules(spark):
    link = lambda *hosts: " ".join(f"<p><A class=x HREF='https://{h}/x'>y</a>" for h in hosts) + '<a href="/home">z</a>'
    rows = [
        (1, "https://good.org/a", link("friend.net")),
        (2, "https://bad.com/de/a", ""),
        (3, "https://spammer.net/", link("bad.com", "bad.com") + '<a href="//bad.com/q">'),
        (4, "https://friend.net/", link("good.org")),
        (5, "https://alone.net/", "<a href=relative>"),
        (5, "https://alone.net/", None),
        (None, "https://spammer.net/en", None),
    ]
    got = collections.defaultdict(set)
    for r in urls.judge_urls(spark, page_rows(spark, rows)).collect():
        got[r.host].add(r.verdict)
    assert got == {"good.org": {"allow"}, "bad.com": {"block"}, "spammer.net": {"block"}, "friend.net": {"allow"}, "alone.net": {"allow"}}
    assert urls.judge_urls(spark, page_rows(spark, [])).count() == 0


def test_url_query_has_no_python(spark):
    df = urls.op3_url_filters(spark, SF_SMALL)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_topk(rows, k=5):
    out = {}
    for i, q in rows:
        if i is not None and i % 50 == 0 and i not in out:
            mine = min(v for j, v in rows if j == i)
            dot = lambda a, b: sum(x * y for x, y in zip(a, b))
            out[i] = sorted(((-dot(mine, v), j) for j, v in rows if j is not None and j != i))[:k]
    return {(i, n, j, -s) for i, best in out.items() for n, (s, j) in enumerate(best, 1)}


@pytest.mark.parametrize("group", [32_768, 40])
def test_search_matches_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(search, "CANDIDATES", group)
    monkeypatch.setattr(search, "QUERIES", 3)
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = np.random.default_rng(group)
    rows = [(i, rng.integers(-300, 300, 8).tolist()) for i in range(260)]
    rows += [(300 + i, [5, 5, 5]) for i in range(40)]  # ties, short vectors
    rows += [(50, [0] * 8), (50, [1] * 8), (7, rows[7][1]), (400, []), (None, [900] * 8), (450, [10**9] * 8)]
    table = spark.createDataFrame(rows, "id long, q array<long>")
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in search.topk(spark, table, F.col("id") % 50 == 0).collect()}
    assert got == brute_topk(rows)


def test_search_awkward(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [float("inf"), 1.0]), (5, [0.25, -0.001])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = table.filter(search.usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), search.quantised(F.col("embedding")).alias("q")
    )
    got = search.topk(spark, table, F.col("id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 5, 256 * 64 - 128)]
    assert search.topk(spark, table.limit(0), F.col("id") % 50 == 0).count() == 0
    assert search.topk(spark, table, F.lit(False)).count() == 0
