"""Exact and near duplicates against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_tables import awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from gazette.llm import exact_dedup as exact
from gazette.llm import near_dedup as near
from gazette.llm.components import components
from gazette.llm.shingles import shingle_set


def lower(text):
    return (text or "").encode().lower()


def test_exact_awkward(spark, awkward):
    got = exact.exact_dedup(spark, awkward, carry=tuple(awkward.columns)).collect()
    rows = awkward.collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lower(r.text)].append(r.doc_id)
    kept = collections.Counter()
    for g in got:
        text = lower(g.row.text)
        ids = groups[text]
        assert g.group_size == len(ids)
        assert g.keep_id == max((i for i in ids if i is not None), default=None)
        assert g.text_sha256 == hashlib.sha256(text).hexdigest()
        assert not g.kept or g.row.doc_id == g.keep_id
        kept[text] += g.kept
    assert set(kept.values()) == {1}


def test_exact_splits_late(spark, monkeypatch):
    """Texts of one length that part only after several levels."""
    monkeypatch.setattr(exact, "FIRST", 2)
    monkeypatch.setattr(exact, "WIDTHS", (2, 4, 8))
    stem = "same beginning for all of them, "
    texts = [stem + x for x in ("a", "b", "A", "c", "a")] + [stem, stem.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_dedup(spark, docs).select("row.doc_id", "*").collect()}
    assert got == {0: (4, 3), 1: (1, 1), 2: (4, 3), 3: (3, 1), 4: (4, 3), 5: (6, 2), 6: (6, 2)}


def brute_components(texts):
    """Smallest id that each id reaches over links, and set sizes."""
    sets = {}
    for i, text in texts.items():
        words = lower(text).split()
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_result(spark, docs):
    rows = near.near_dedup(spark, docs).select("row.doc_id", "n_shingles", "component_id", "kept").collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}, rows


def family_texts(seed, base_words=120, members=60, change=0.03):
    """Near copies of one text, unrelated texts around a shared passage, and short ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(base_words)]
    out = []
    for _ in range(members):
        out.append(" ".join(w if rng.random() > change else word() for w in base))
    passage = [word() for _ in range(60)]
    for _ in range(members):
        size = rng.choice([4, 8, 12, 20, 60])
        out.append(" ".join(passage + [word() for _ in range(size)]))
    out += ["one two", "ONE two", "one two three", "", " ", "a b c d e", "a b c d e f"]
    rng.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("long_list", [64, 8])
def test_near_matches_brute_force(spark, monkeypatch, long_list):
    """With short limits most lists are long, so the prefix join does the work."""
    monkeypatch.setattr(near, "LONG_LIST", long_list)
    texts = family_texts(long_list)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got, rows = near_result(spark, docs)
    assert got == brute_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert near_result(spark, docs)[0] == brute_components(texts)


def test_near_awkward(spark, awkward):
    rows = near.near_dedup(spark, awkward, carry=tuple(awkward.columns)).collect()
    assert len(rows) == awkward.count()
    by = [(r.row.doc_id, r.row.text, r.n_shingles, r.component_id, r.kept) for r in rows]
    assert {(c, k) for i, t, n, c, k in by if not (t or "").split()} <= {(i, True) for i in (4, 5, 6, None)}
    cats = [(i, c, k) for i, t, n, c, k in by if t and t.lower().startswith("the cat")]
    assert sorted(cats) == [(1, 1, True), (2, 1, False)]
    twice = [k for i, t, n, c, k in by if t and t.startswith("el perro")]
    assert sorted(twice) == [False, True]


def test_empty_tables(spark, nothing):
    assert exact.exact_dedup(spark, nothing).count() == 0
    assert near.near_dedup(spark, nothing).count() == 0


def test_shingles_do_not_depend_on_blocks(monkeypatch):
    from gazette.llm import shingles

    data = " ".join(str(i % 97) for i in range(2000)).encode()
    whole = shingle_set(data)
    monkeypatch.setattr(shingles, "_BLOCK", 50)
    assert np.array_equal(whole, shingle_set(data))
    assert len(whole) == len({tuple(data.split()[i : i + 5]) for i in range(1996)})


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    root = {i: i for pair in links for i in pair}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {i for a, b in links if a != b for i in (a, b)}
    assert got == {i: find(i) for i in touched}


def test_no_text_in_a_shuffle_of_singletons(spark):
    """Only the first split moves texts; later levels see survivors."""
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    assert exact.exact_dedup(spark, docs).filter("kept AND group_size = 1").count() == 50


def test_extend_equals_components_of_all_links(spark):
    """Links added in steps, also between new nodes, give the roots of all together."""
    from gazette.llm.common import materialise
    from gazette.llm.components import components, extend

    rng = np.random.default_rng(12)
    steps = [[(int(a), int(b)) for a, b in rng.integers(0, 60, (n, 2))] for n in (14, 9, 0, 12)]
    schema = "a long, b long"
    roots = materialise(spark, components(spark, spark.createDataFrame(steps[0], schema)), "r")
    for i, links in enumerate(steps[1:], 2):
        roots = materialise(spark, extend(spark, roots, spark.createDataFrame(links, schema)), "r")
        whole = components(spark, spark.createDataFrame(sum(steps[:i], []), schema))
        assert sorted(map(tuple, roots.collect())) == sorted(map(tuple, whole.collect()))
