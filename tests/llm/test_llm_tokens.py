"""Tokenizers: counts, packing and pieces against the public libraries."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from llm_tables import awkward, nothing  # noqa: F401
from tokenizers import Tokenizer

from gazette.llm import packing, pretokens
from gazette.llm import token_counts as counts
from gazette.llm.sentence_pieces import Pieces, op2_sentence_pieces, sentence_pieces

SCRAPS = [
    "a", "B", "'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "\u00a0", "é", "ñ", "日本", "😀", "1", "²", "٣", "!",
    "--", "\x1c", "\x85", "'d", "don't", "\u0301", "ß", "Ⅷ", "<|endoftext|>", "the", "ing", " " * 17, "<s>", "<0x0A>",
]


def scraps(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def machine():
    return counts.Transducer(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_of_scraps(library, machine):
    for text in scraps(1500, 1):
        assert counts.count_tokens(text, machine) == len(library.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("size", [1, 7, 40])
def test_chunk_maps_compose(library, machine, monkeypatch, size):
    monkeypatch.setattr(counts, "CHUNK", size)
    for text in scraps(300, size):
        assert counts.count_tokens(text, machine) == len(library.encode(text, add_special_tokens=False).ids), text


def test_bounded_tables(library, machine, monkeypatch):
    for name in ("MAX_TRANSITIONS", "MAX_PAIRS", "MAX_WORDS"):
        monkeypatch.setattr(counts, name, 50)
    for text in scraps(200, 9):
        assert counts.count_tokens(text, machine) == len(library.encode(text, add_special_tokens=False).ids), text


def test_pretokens_join_to_the_text():
    for text in scraps(500, 2):
        assert b"".join(pretokens.split(text)) == text.encode()


def test_count_query(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in counts.op10_token_counts(spark, SF_SMALL).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_awkward(spark, awkward, nothing, library):
    want = sorted(
        (len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in awkward.collect()
    )
    assert sorted((r.n_bytes, r.n_tokens) for r in counts.token_counts(awkward).collect()) == want
    assert counts.token_counts(nothing).count() == 0
    assert packing.pack(spark, nothing).count() == 0
    assert sentence_pieces(nothing).count() == 0
    coded = sentence_pieces(awkward).collect()
    assert len(coded) == awkward.count() and all(r.decoded == r.text for r in coded)


def check_packing(rows, texts, library):
    """Every id once, sequences gapless, no padding but none at powers of two."""
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    covered, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(piece.tobytes()) and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        at = 0
        for start, length in sorted(covered[i]):
            assert start == at
            at += length
        assert at == len(x)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: no padding at all
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_query(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_packing(packing.op7_packing(spark, SF_SMALL).collect(), {r.doc_id: r.text for r in docs.collect()}, library)


def test_packing_awkward(spark, awkward, library):
    rows = packing.pack(spark, awkward).collect()
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in awkward.collect())
    assert sum(r.length for r in rows) == total
    assert {(r.doc_tokens, r.length) for r in rows if r.id == 4} == {(1, 1)}


def test_texts_are_encoded_in_one_call(library, monkeypatch):
    """Texts of usual length need one call each; pretoken by pretoken gives the same ids."""
    encoder = packing._encoder(None, None)
    texts = [*scraps(500, 3), "", " ", "it's  \n\t x\u2003y", "new words " + " ".join(f"w{i}q" for i in range(300))]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    calls, pieces = [], encoder.pieces

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return pieces.encode_ordinary(text)

    monkeypatch.setattr(encoder, "pieces", Counted())
    assert [encoder(t) for t in texts] == want
    assert calls == [t for t in texts if "<|endoftext|>" not in t]  # those go through the library
    monkeypatch.setattr(packing, "WHOLE", -1)
    assert [encoder(t) for t in texts] == want


def test_tail_is_cut_into_powers_of_two():
    assert packing.tail_starts(2048 * 3, 2048) == []
    assert packing.tail_starts(2048 + 13, 2048) == [2048, 2056, 2060]


def test_hilbert_neighbours():
    points = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    order = np.argsort(packing.hilbert_index(points, 3))
    assert sorted(packing.hilbert_index(points, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(points[order], axis=0)).sum(1) == 1).all()


def test_curve_groups_alike_texts(spark):
    """Along the curve, texts of two kinds lie in a few runs."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    kinds = [["house", "river", "the", "hill", "and"], ["zqx", "vvk", "kjj", "wwz", "xqv"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(300))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", packing.curve_key(F.col("text")).alias("key"))
    order = [r.doc_id % 2 for r in df.orderBy("key").collect()]
    assert sum(a != b for a, b in zip(order, order[1:])) <= 6


def test_pieces_match_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in scraps(1200, 3):
        ids = model.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert model.decode(ids) == text


def test_pieces_do_not_depend_on_blocks(monkeypatch):
    from gazette.llm import sentence_pieces as sp

    for name, value in (("BLOCK", 5), ("MAX_WORDS", 20), ("MAX_MOVES", 50), ("MAX_PAIRS", 50)):
        monkeypatch.setattr(sp, name, value)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in scraps(200, 4):
        assert model.encode(text).tolist() == library.encode(text), text


def test_window_commits_early():
    """A long run without spaces is committed while it streams."""
    model = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    seen = []

    def stream():
        for i, c in enumerate("abcdefghinternationalization" * 20):
            seen.append(i)
            yield c

    first = next(model.viterbi(stream()))
    assert first >= 0 and len(seen) < 3 * model.longest


def test_pieces_query(spark):
    rows = op2_sentence_pieces(spark, SF_SMALL).collect()
    assert rows and all(r.round_trip for r in rows)
