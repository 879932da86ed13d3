"""Op 6 asks once for each n-gram and counts n-grams in packed rows."""

import collections
import random

import numpy as np
import pyarrow as pa

from gazette.llm import lm_score as lm
from gazette.llm.shingles import word_array

ODD = "a  b\tc\x0b\x0cd\r\n e\x1c\x1d\x1e\x1f\x85f \x00 g h İ K "


def texts(n, rng):
    return [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 50))) for _ in range(n)] + ["", ODD, ODD]


def batches(found, size):
    return [pa.record_batch({"text": pa.array(found[i : i + size], pa.string())}) for i in range(0, len(found), size)]


def test_words_are_those_of_split():
    rng = random.Random(5)
    some = [0, 8, 9, 10, 11, 12, 13, 14, 28, 31, 32, 65, 97, 133, 160, 195]
    for _ in range(500):
        data = bytes(rng.choice(some) for _ in range(rng.randrange(12)))
        assert word_array(data).to_pylist() == data.split()


def test_words_are_counted_whatever_is_held(monkeypatch):
    found = [*texts(200, random.Random(6)), None, "A a"]
    want = collections.Counter(w for t in found for w in [*(t or "").encode().lower().split(), lm.END])
    for held in (10, lm.HELD_WORDS):
        monkeypatch.setattr(lm, "HELD_WORDS", held)
        got = collections.Counter()
        for rows in lm._count_words(iter(batches(found, 40))):
            for word, c in zip(rows["word"].to_pylist(), rows["c"].to_pylist()):
                got[word] += c
        assert got == want
    assert sum(x.num_rows for x in lm._count_words(iter([]))) == 0


def test_a_token_asks_one_key_for_each_length():
    """A context's back-off stands in the row of its own n-gram."""
    tree = lm.SuffixTree(1, 1.0, 0.5, *[np.empty(0)] * 5)
    for tokens in lm.pieces([t.encode() for t in texts(50, random.Random(7))], 1 << 30):
        keys, where = tree.grams(tokens)
        assert len(keys) == len(where) == sum(len(tokens.at(k)) for k in range(lm.DEPTH + 1))
        assert np.bincount(where).max() == lm.DEPTH + 1


def test_grams_travel_packed_and_are_counted(monkeypatch):
    """A block hands on one row for each section and depth; sections count exactly the n-grams that occur twice."""

    class Every:
        class value:
            bits = np.full(1 << (lm.BITS - 6), ~np.uint64(0), np.uint64)

    found = texts(300, random.Random(8))
    monkeypatch.setattr(lm, "HELD_GRAMS", 2000)
    rows = [r for r in lm._count_grams(Every, 3)(iter(batches(found, 50))) if r.num_rows]
    assert len(rows) > 4 and all(r.num_rows <= 8 and len(set(r["depth"].to_pylist())) == 1 for r in rows)
    table = pa.Table.from_batches(rows)
    got = {}
    for part in range(8):
        here = table.filter(pa.compute.equal(table["part"], part))
        for r in lm._sum_grams((pa.scalar(part),), here).to_pylist():
            assert (r["key"], r["depth"]) not in got and r["key"] >> 61 & 7 == part
            got[r["key"], r["depth"]] = r["context"], r["suffix"], r["c"]
    want = collections.Counter()
    for tokens in lm.pieces([t.encode() for t in found], 1 << 30):
        for depth in (1, 2):
            words = lm._grams(tokens, depth)
            short = [words[0], words[1]] if depth == 1 else [lm.key_of(lm.ENTRY, *w) for w in (words[:2], words[1:])]
            columns = [lm.key_of(lm.ENTRY, *words), *short]
            want.update((*row, depth) for row in zip(*(x.view(np.int64).tolist() for x in columns)))
    want = {(k, depth): (context, suffix, c) for (k, context, suffix, depth), c in want.items() if c >= lm.LEAST}
    assert len(want) > 300 and got == want
