"""Packing token sequences in space-filling-curve order.

Every document's hashed byte-bigram vector is projected to three dimensions;
documents are range-sorted by the Hilbert key of that point, tokenised once,
and the stream of their ids along the curve is cut every 2,048 tokens, so
neighbours on the curve share sequences.  The last, incomplete sequence is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import bigram_counts, bounded_batches, each, materialise, name_of, slices
from gazette.llm.pretokens import split

SEQUENCE = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Texts of so many characters at most are encoded in one call, longer ones pretoken by pretoken.
WHOLE = 100_000
#: Pretokens that a worker remembers, twice over (the younger and the older ones).
MAX_WORDS = 80_000

DIMENSIONS = 3
BITS = 16


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows), by Skilling's
    transposition (AIP Conf. Proc. 707, 2004)."""
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    one, top = np.uint64(1), np.uint64(1 << (bits - 1))
    q = top
    while q > one:
        low = q - one
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= one
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, q = np.zeros(len(points), np.uint64), top
    while q > one:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - one), turn)
        q >>= one
    out = np.zeros(len(points), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << one) | (((axis ^ turn) >> np.uint64(bit)) & one)
    return out.astype(np.int64)


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(SEQUENCE).standard_normal((len(bigram_counts(b"")), DIMENSIONS))


@F.arrow_udf(T.LongType())
def curve_key(texts: pa.Array) -> pa.Array:
    """Hilbert key of each whole text; null reads as empty."""
    vectors = np.array([np.sqrt(bigram_counts((t or "").encode())) for t in each(texts)])
    if not len(vectors):
        return pa.array([], pa.int64())
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = (vectors / np.maximum(length, 1)) @ _projection()
    cells = np.clip((points + 4) / 8, 0, 1) * ((1 << BITS) - 1)
    return pa.array(hilbert_index(cells.astype(np.int64)))


class Encoder:
    """Ids of the byte-level vocabulary as little-endian 16-bit bytes.  Long texts
    are cut into pretokens, with a bounded memory of them, so that no run of
    characters is too long for the pattern.  Texts that hold a special string go
    through the tokenizer itself."""

    def __init__(self, vocabulary: str, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.vocabulary, self.tokenizer = vocabulary, None
        with open(vocabulary, encoding="utf-8") as f:
            self.specials = [t["content"] for t in json.load(f)["added_tokens"]]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.vocabulary)
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u2").tobytes()
        if len(text) <= WHOLE:
            return np.array(self.pieces.encode_ordinary(text), "<u2").tobytes()
        words = split(text)
        found = list(map(self.known.get, words))
        try:
            return b"".join(found)
        except TypeError:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._new(words[i])
            return b"".join(found)

    def _new(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = np.array(self.pieces.encode_ordinary(word.decode()), "<u2").tobytes()
        if len(word) <= 64:
            if len(self.known) >= MAX_WORDS:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids


@lru_cache(maxsize=1)
def _encoder(vocabulary: str | None, ranks: str | None) -> Encoder:
    import public_tokenizers as tokenizer_files

    return Encoder(vocabulary or tokenizer_files.path(VOCABULARY), ranks or tokenizer_files.path(RANKS))


def _encode(vocabulary: str | None, ranks: str | None):
    """(id, part, start, n, ids): ``start`` counts tokens within the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(vocabulary, ranks), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids, starts, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                data = encoder(text or "") + END_ID.to_bytes(2, "little")
                ids.append(data)
                starts.append(at)
                sizes.append(len(data) // 2)
                at += sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["id", "part", "start", "n", "ids"],
            )

    return run


def tail_starts(total: int, sequence: int) -> list[int]:
    """Where the sequences after the last full one begin: powers of two, falling."""
    at, out = total - total % sequence, []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return out


def _cut(base: dict[int, int], total: int, sequence: int):
    tails = tail_starts(total, sequence)
    full = total - total % sequence

    def where(at: int) -> tuple[int, int, int]:
        """Number, start and end of the sequence that holds a position."""
        if at < full:
            number = at // sequence
            return number, number * sequence, (number + 1) * sequence
        i = bisect_right(tails, at) - 1
        return full // sequence + i, tails[i], [*tails, total][i + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], [], []]
            origin: list[int] = []
            columns = [batch.column(c).to_pylist() for c in ("part", "start", "n", "ids")]
            for i, (part, start, n, data) in enumerate(zip(*columns)):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                begin = base[part] + start
                at = begin
                while at < begin + n:
                    number, left, right = where(at)
                    end = min(right, begin + n)
                    for column, value in zip(
                        rows, (at - begin, end - at, ids[at - begin : end - begin].tobytes(), n, number, at - left)
                    ):
                        column.append(value)
                    origin.append(i)
                    at = end
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(origin, pa.int64())),
                    *[pa.array(r, k) for r, k in zip(rows, kinds)],
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    vocabulary: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    Null text is empty: such a document is its end id alone.  Equal texts
    share a key and are told apart by id (null first); repeated rows are
    packed once each.  An empty table gives no rows; other columns are not
    read.
    """
    bounded_batches(spark)
    rows = docs.select(docs[name_of(id_col)].alias("id"), docs[name_of(text_col)].alias("text"))
    kind = dict(rows.dtypes)["id"]
    along = rows.withColumn("key", curve_key("text")).repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    encoded = materialise(
        spark,
        along.select("id", "text").mapInArrow(
            _encode(vocabulary, ranks), f"id {kind}, part bigint, start bigint, n bigint, ids binary"
        ),
        "packed-ids",
    )
    # one row for each range partition, a number that the session sets
    sizes = encoded.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    base, total = {}, 0
    for r in sizes:
        base[r["part"]] = total
        total += r["n"]
    return encoded.mapInArrow(
        _cut(base, total, sequence),
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def pieces(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digest form of ``pack``."""
    return pack(spark, docs).select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 2,048 tokens."""
    return pieces(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
