"""Operators do the whole job: what grows with the corpus is not cut."""

import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from gazette.llm import lm_score as lm


def brute_tree(texts):
    """A function text -> score, of dictionaries with every entry that occurs LEAST times."""
    docs = [[*t.encode().lower().split(), lm.END] for t in texts]
    one, two, three = (collections.Counter(tuple(d[i : i + k]) for d in docs for i in range(len(d) - k + 1)) for k in (1, 2, 3))
    n, v = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    discount = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))
    root = lambda w: max(one[w] - discount, 0) / n if one[w] else discount * v / n

    def level(entries, size, shorter):
        contexts = collections.defaultdict(dict)
        for gram, c in entries.items():
            if c >= lm.LEAST:
                contexts[gram[:-1]][gram[-1]] = c
        kept = {}
        for context, followers in contexts.items():
            total = size[context]
            low = {w: shorter((*context, w)) for w in followers}
            high = {w: (c + lm.PRIOR * low[w]) / (total + lm.PRIOR) for w, c in followers.items()}
            rest, rest_low = max(1 - sum(high.values()), 1e-12), max(1 - sum(low.values()), 1e-12)
            left = total - sum(followers.values())
            ratio = 2 * sum(c * math.log(c / total / low[w]) for w, c in followers.items())
            ratio += 2 * left * math.log(max(left / total, 1e-12) / rest_low)
            if ratio > len(followers) + lm.SIGMAS * math.sqrt(2 * len(followers)):
                kept[context] = (high, rest / rest_low)
        return kept

    def chance(kept, shorter, gram):
        if gram[:-1] not in kept:
            return shorter(gram)
        high, rest = kept[gram[:-1]]
        return high[gram[-1]] if gram[-1] in high else rest * shorter(gram)

    first = level(two, one, lambda g: root(g[-1:]))
    of_two = lambda g: chance(first, lambda h: root(h[-1:]), g[-2:])
    second = level(three, two, of_two)

    def score(text):
        tokens = [*(text or "").encode().lower().split(), lm.END]
        out = math.log10(root((tokens[0],)))
        for i in range(1, len(tokens)):
            gram = tuple(tokens[max(0, i - 2) : i + 1])
            out += math.log10(chance(second, of_two, gram) if len(gram) == 3 else of_two(gram))
        return out

    return score


def test_lm_table_matches_brute_force_whatever_is_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, 30, p=np.arange(60, 0, -1) / 1830)) for _ in range(60)]
    texts += ["a seldom phrase of five " + t for t in texts[:4]] + ["", "w1", texts[0], None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    held = lambda i: i % 5 == 4
    score = brute_tree([t or "" for i, t in enumerate(texts) if i % 5 != 4])
    for keys, share in ((lm.HEAD_KEYS, lm.COMMON_SHARE), (40, 0.02), (0, 1.0)):
        monkeypatch.setattr(lm, "HEAD_KEYS", keys)
        monkeypatch.setattr(lm, "COMMON_SHARE", share)
        got = {r.id: r.score for r in lm.lm_score(spark, docs, held).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert math.isclose(got[i], score(t), rel_tol=1e-9), (keys, i)


def test_lm_learns_a_phrase_at_any_size(spark):
    """Three occurrences teach a phrase, also among half a million tokens."""
    filler = spark.range(500).select(
        F.concat(F.lit("n"), "id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.concat(F.lit("f"), F.pmod(F.xxhash64(i, "id"), F.lit(5000))))).alias("text"),
    )
    phrase = spark.createDataFrame([(f"p{i}", "quark gluon plasma") for i in range(4)], "doc_id string, text string")
    got = lm.lm_score(spark, filler.unionByName(phrase), lambda i: i == "p3").filter("id = 'p3'").first()
    assert got.train_tokens > 500_000
    # without contexts, each of the four tokens would cost its share of all tokens
    assert got.score > got.base_score / 2


def test_lm_runs_repeat_what_contexts_need(monkeypatch):
    from gazette.llm import shingles

    text = b" ".join(b"w%d" % (i % 17) for i in range(400))
    whole = [w for w in np.concatenate([h for h, _ in lm.runs(text)])]
    monkeypatch.setattr(shingles, "_BLOCK", 50)
    parts = list(lm.runs(text))
    assert len(parts) > 10 and [lead for _, lead in parts][:2] == [0, 2]
    assert [x for h, lead in parts for x in h[lead:]] == whole
    tokens = [t for t in lm.pieces([text, b"", b"a b"], 100)]
    assert sum(int(t.new.sum()) for t in tokens) == 401 + 1 + 3
    assert sum(len(t.at(2)) for t in tokens) == 399 + 0 + 1


def test_fingerprints_find_every_repeated_gram(spark):
    """Every pair and triple that occurs twice is in the bitmap, within one
    block or over many; of those that occur once hardly any is."""
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 60))) for _ in range(400)] + [""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    every = np.full(1 << (lm.BITS - 6), ~np.uint64(0), np.uint64)
    bits = lm.often_grams(spark, rows.select(F.col("text")), every, 20_000)
    counts = collections.Counter()
    for tokens in lm.pieces([t.encode() for t in texts], 1 << 40):
        for depth in (1, 2):
            counts.update(lm.key_of(lm.ENTRY, *lm._grams(tokens, depth)).tolist())
    keys = np.array(list(counts), np.uint64)
    twice = np.array(list(counts.values())) >= lm.LEAST
    found = lm.in_bitmap(bits, keys)
    assert twice.sum() > 500 and found[twice].all()
    assert found[~twice].mean() < 0.01
    for sizes in ([], [0], [0, 0, 5], sorted(rng.randrange(1 << lm.PRINT) for _ in range(1000))):
        assert lm._unpacked(lm._packed(np.array(sizes, np.uint64))).tolist() == sizes
