"""Importance resampling against a plain re-implementation."""

import collections
import hashlib
import math
import re
import zlib

from llm_tables import LONG, awkward, nothing  # noqa: F401

from gazette.llm import importance, words

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, target):
    def runs(text):
        w = WORD.findall((text or "").encode().lower())
        return len(w), [b" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    def bags(texts):
        return collections.Counter(zlib.crc32(f) % 10_000 for t in texts for f in runs(t)[1])

    s, t = bags(x for _, x in rows), bags(target)
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (size_s + 10_000) / ((s[b] + 1) * (size_t + 10_000))))
    out = []
    for doc_id, text in rows:
        n, fs = runs(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(zlib.crc32(f) % 10_000) for f in fs)
        out.append([doc_id, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    drawn = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for i, r in enumerate(drawn[: 5 * len(drawn) // 100]):
        r[5] = i + 1
    return sorted(map(str, out))


def run(spark, docs, target):
    return sorted(str(list(r)) for r in importance.resample(spark, docs, target).collect())


TARGET = ["the river and the old mill", "der Hund", None, "", "El perro y el gato, 3 gatos"]


def test_awkward_rows(spark, awkward):
    target = spark.createDataFrame([(t, "x") for t in TARGET], "text string, n string")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert run(spark, awkward, target) == brute(rows, TARGET)


def test_ranks_ties_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(importance, "ORDERED_ROWS", 100)
    text = "one two three four five six seven eight nine ten " * 2
    rows = [(i, text + ("gatos " * (i % 7))) for i in range(500)] + [(3, text)] * 5 + [(600, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = run(spark, docs, target)
    assert got == brute(rows, TARGET)
    assert sum("None" not in r for r in got) == 5 * 505 // 100


def test_empty_tables(spark, awkward, nothing):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert run(spark, nothing, target) == []
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert run(spark, awkward, nothing.select("text")) == brute(rows, [])


def test_segments_do_not_change_words(monkeypatch):
    import pyarrow as pa

    texts = [LONG, "a b", "x" * 500 + " " + "é" * 300, "", None, " . " * 400, "Last ONE 1x"]
    monkeypatch.setattr(words, "SEGMENT", 100)
    monkeypatch.setattr(words, "CHUNK", 300)
    got = collections.defaultdict(list)
    for w in words.words_of(pa.array(texts), words.NOT_ALPHANUMERIC, 2):
        place = collections.Counter()
        for i, s in zip(w.index, w.segment):
            if place[s] >= w.lead[s]:
                got[w.owner[s]].append(w.dictionary[i])
            place[s] += 1
    for n, t in enumerate(texts):
        assert got[n] == WORD.findall((t or "").encode().lower())
