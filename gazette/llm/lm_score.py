"""Language-model scores from a probabilistic suffix tree over tokens.

A token is a word, or the end that closes every document.  The tree's root
holds the counts of all training tokens, absolutely discounted; the discount
is the chance of an unknown token, one class as in the base score.  A longer
context (one or two tokens back, ``DEPTH``) is a candidate if some next token
follows it ``LEAST`` times, whatever the size of the corpus, and it is retained
if a likelihood-ratio test tells its next-token distribution from that of its
suffix.  Distributions are smoothed towards the suffix's; a token scores in
the longest retained suffix of what stands before it.

The tree is a written table that grows with the corpus.  The log of a token's
chance is a sum over n-grams that end at it or before it: that of an unknown
token, what the word adds, what its retained contexts' back-offs add, and what
entries (context, token) add.  Every n-gram but the end is a context of the token
after it, so the table has one row for each n-gram: what it adds as an entry
and, as a back-off, to the next token.  The ``HEAD_KEYS`` most frequent n-grams are
broadcast; all others meet their numbers in sections of the keys, which no
frequent n-gram can skew: a block of documents asks each section in one packed row.
A bitmap, which only ever saves rows, tells which n-grams are surely in no table.

Every training document counts.  Words and n-grams are told apart by 64-bit
hashes (a hundred million of them share one with a chance of about 3e-4).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, brief_shuffles, byte_list, fold, hashed_joins, materialise, name_of, release, slices
from gazette.llm.shingles import _scramble, byte_blocks, word_array, word_hashes, word_places

DEPTH = 2
#: Occurrences that make an entry (context, next token); the same for any corpus.
LEAST = 2
#: Bound of the broadcast part of the table, in n-grams.
HEAD_KEYS = 1_000_000
#: Words with this share of the training tokens (at most 1 / COMMON_SHARE) are joined by broadcast.
COMMON_SHARE = 2e-6
#: Bits of a bitmap of hashes, as a power of two.
BITS = 28
#: Bits of the parts in which a bitmap is put together, as a power of two.
PART = 18
#: Bits that tell n-grams of one section apart until they are counted, and n-grams of a section.
PRINT, SECTION = 32, 1 << 21
#: Training tokens for each section of the table that documents ask, and its bits at least and at most.
ASKED, ASKED_BITS = 1 << 22, (5, 16)
#: Training tokens for each group of documents whose answers are summed, and its bits at least and at most.
SUMMED, SUMMED_BITS = 1 << 20, (6, 16)
#: Tokens that a task looks up at a time.
PIECE = 200_000
#: Bytes that a token takes, about, and bytes of a text that is read run by run.
TOKEN_BYTES, LONG = 6, 1 << 20
#: Weight of the suffix's distribution, in observations.
PRIOR = 4.0
#: Standard deviations by which a likelihood ratio must exceed chance.
SIGMAS = 4.0
#: Tokens that a task looks at together, and words and n-grams that it counts before it hands them on.
HELD, HELD_WORDS, HELD_GRAMS = 400_000, 3_000_000, 1_500_000
#: MB of a shuffled partition that may be joined through a hash table, without sorts.
HASHED_MB = 64

#: Stands for the end among words; no word holds a space.
END = b" "


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial token counts."""

    def rows(held: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        found = pa.chunked_array(held, pa.binary()).value_counts()
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])

    held: list[pa.Array] = []
    n = 0
    for batch in slices(batches):
        texts = byte_list(batch.column("text"))
        for block in byte_blocks(b" ".join(texts).lower()):
            held.append(word_array(block))
            n += len(held[-1])
            if n > HELD_WORDS:
                yield from rows(held)
                held, n = [], 0
        held.append(pa.array([END] * len(texts), pa.binary()))
    yield from rows(held)


_LAST = word_hashes(pa.array([END], pa.binary()))

# FIXED VALUES: odd multipliers that tell the kinds of n-grams and their positions apart.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
ENTRY = 2


def key_of(kind: int, *words: np.ndarray) -> np.ndarray:
    """Key of n-grams of word hashes; a word alone is its own key."""
    out = np.uint64(kind * 8 + len(words))
    for word, mix in zip(words, _MIX):
        out = _scramble(out ^ (word.view(np.uint64) * mix))
    return out


def runs(text: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """Word hashes of a text, block by block, the end included; the second
    number says how many at the start only repeat what stood before."""
    tail = np.empty(0, np.uint64)
    parts = map(word_array, byte_blocks(text.lower()))
    words = next(parts, pa.array([], pa.binary()))
    while words is not None:
        after = next(parts, None)
        found = word_hashes(words)
        whole = np.concatenate([tail, found] if after is not None else [tail, found, _LAST])
        yield whole, len(tail)
        tail = whole[-DEPTH:]
        words = after


@dataclass
class Tokens:
    """Tokens of several runs: hash, number of the text, and place in the run
    (so many tokens before it are known), without those that repeat."""

    words: np.ndarray
    text: np.ndarray
    place: np.ndarray
    new: np.ndarray

    def at(self, depth: int) -> np.ndarray:
        """Tokens that have ``depth`` tokens before them."""
        return np.flatnonzero(self.new & (self.place >= depth))


def _together(texts: list[bytes], numbers: list[int]) -> Tokens:
    """The tokens of whole texts, which are hashed at once."""
    words, starts = word_places(b" ".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    n = np.diff(np.searchsorted(starts, ends), prepend=0) + 1
    last = np.cumsum(n) - 1
    word = np.ones(n.sum(), bool)
    word[last] = False
    out = np.full(len(word), _LAST[0])
    out[word] = word_hashes(words)
    place = np.arange(len(word)) - np.repeat(last + 1 - n, n)
    return Tokens(out, np.repeat(numbers, n), place, np.ones(len(word), bool))


def _in_runs(text: bytes, number: int) -> Iterator[Tokens]:
    """The tokens of a long text, run by run."""
    for words, lead in runs(text):
        place = np.arange(len(words))
        yield Tokens(words, np.full(len(words), number), place, place >= lead)


def pieces(texts: list[bytes], size: int) -> Iterator[Tokens]:
    """The tokens of texts, about ``size`` of them at a time."""
    held, n = [], 0
    for i, text in enumerate(texts):
        if len(text) > LONG:
            yield from _in_runs(text, i)
            continue
        held.append(i)
        n += len(text)
        if n >= TOKEN_BYTES * size:
            yield _together([texts[i] for i in held], held)
            held, n = [], 0
    if held:
        yield _together([texts[i] for i in held], held)


def _packed_places(place: np.ndarray) -> pa.RecordBatch:
    """Ascending distinct places of set bits as one packed row for each part of the bitmap."""
    parts = place >> np.uint64(PART)
    starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]][: len(parts)])
    held = [_packed(x) for x in np.split(place & np.uint64((1 << PART) - 1), starts[1:])] if len(parts) else []
    return pa.RecordBatch.from_arrays([pa.array(parts[starts].astype(np.int64)), pa.array(held, pa.binary())], ["part", "places"])


def bitmap(rows: DataFrame, key: str) -> np.ndarray:
    """One bit for the top ``BITS`` bits of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITS))
            n += len(held[-1])
            if n > HELD_GRAMS:
                yield _packed_places(np.unique(np.concatenate(held)))
                held, n = [], 0
        if held:
            yield _packed_places(np.unique(np.concatenate(held)))

    return gather(rows.select(key).mapInArrow(run, "part bigint, places binary"))


def gather(places: DataFrame) -> np.ndarray:
    """The bitmap of (part, places), packed places of set bits."""

    def section(key: tuple, found: pa.Table) -> pa.Table:
        out = np.zeros(1 << PART, bool)
        for x in found["places"]:
            out[_unpacked(x.as_buffer()).astype(np.int64)] = True
        return pa.table({"part": [key[0].as_py()], "section": [np.packbits(out, bitorder="little").tobytes()]})

    each = 1 << (PART - 6)
    out = np.zeros(1 << (BITS - 6), np.uint64)
    found = places.groupBy("part").applyInArrow(section, "part bigint, section binary").toArrow()
    for part, row in zip(found["part"].to_pylist(), found["section"]):
        out[part * each : (part + 1) * each] = np.frombuffer(row.as_buffer(), np.uint64)
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


class Stowed:
    """Arrays and numbers that travel compressed: what is broadcast lies as a file
    on the driver and on every executor, and most of a bitmap is zero."""

    def __getstate__(self) -> dict:
        stow = lambda x: (x.dtype.str, x.nbytes, pa.compress(pa.py_buffer(np.ascontiguousarray(x)), "zstd", asbytes=True))
        return {k: stow(v) if isinstance(v, np.ndarray) else v for k, v in self.__dict__.items()}

    def __setstate__(self, state: dict) -> None:
        for k, v in state.items():
            if isinstance(v, tuple):
                kind, size, data = v
                v = np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), kind)
            self.__dict__[k] = v


class Bitmap(Stowed):
    """A bitmap to broadcast."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in an ascending table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Level:
    """The candidate contexts of one depth that are in the head."""

    retained: np.ndarray


@dataclass
class SuffixTree(Stowed):
    """The head of the table (keys ascending, what each adds to its own and to the
    next token, word counts) and a bitmap of the keys of the rest, ``tail``
    (key, what it adds to both, count)."""

    total: int
    unknown: float
    discount: float
    keys: np.ndarray
    adds: np.ndarray
    back: np.ndarray
    counts: np.ndarray
    bits: np.ndarray
    levels: list[Level] = field(default_factory=list)
    tail: DataFrame | None = None
    frequent: DataFrame | None = None

    @cached_property
    def number(self) -> dict[bytes, int]:
        """Numbers of the ``frequent`` words, of which scoring needs none."""
        rows = sorted(self.frequent.collect(), key=lambda r: (-r["c"], bytes(r["word"])))
        return {bytes(r["word"]): i for i, r in enumerate(rows)}

    def __getstate__(self) -> dict:
        state = super().__getstate__() | {"tail": None, "frequent": None, "levels": []}
        state.pop("number", None)
        return state

    @property
    def unknown_log(self) -> float:
        return float(np.log10(max(self.unknown, 1e-9) / self.total)) if self.total else 0.0

    def grams(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all n-grams that add to the tokens' logs, and the tokens."""
        keys, where = [tokens.words[tokens.new]], [np.flatnonzero(tokens.new)]
        for depth in range(1, DEPTH + 1):
            at = tokens.at(depth)
            keys.append(key_of(ENTRY, *_grams(tokens, depth)))
            where.append(at)
        return np.concatenate(keys), np.concatenate(where)

    def logs(self, numbers: np.ndarray) -> np.ndarray:
        """log10 P of each of consecutive tokens, given by ``number``, as far as
        the head tells; of tokens without a number (-1), the back-off alone."""
        names = np.append(word_hashes(pa.array([*self.number], pa.binary())), np.uint64(1))
        size = len(numbers)
        place = np.arange(size)
        keys, where = self.grams(Tokens(names[numbers], np.zeros(size, int), place, place >= 0))
        at, seen = _find(self.keys, keys)
        at, where = at[seen], where[seen]
        out = np.bincount(where, self.adds[at], size) + np.bincount(where + 1, self.back[at], size + 1)[:size]
        return out + np.where(numbers >= 0, self.unknown_log, 0.0)


def _grams(tokens: Tokens, depth: int) -> list[np.ndarray]:
    """Columns of the n-grams of ``depth`` tokens and the next one."""
    at = tokens.at(depth)
    return [tokens.words[at - k] for k in range(depth, -1, -1)]


LOW = np.uint64((1 << PRINT) - 1)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as their bytes, place by place: most high bytes are
    zero, which the shuffle's compression takes."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _packed(keys: np.ndarray) -> bytes:
    """Ascending numbers below 2^``PRINT`` as their gaps."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


def _keys_seen(bits, split: int):
    """For every section of the keys' top ``split`` bits the next ``PRINT``
    bits of the n-grams in it, in blocks; a key that a block holds more often
    comes up to ``LEAST`` times.  N-grams of a word that is surely seldom are
    left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = bits.value.bits
        for batch in batches:
            for tokens in pieces(byte_list(batch.column("text")), HELD):
                usable = in_bitmap(often, tokens.words)
                found = []
                for depth in range(1, DEPTH + 1):
                    at = tokens.at(depth)
                    at = at[np.logical_and.reduce([usable[at - k] for k in range(depth + 1)])]
                    found.append(key_of(ENTRY, *(tokens.words[at - k] for k in range(depth, -1, -1))))
                keys, c = np.unique(np.concatenate(found) >> np.uint64(64 - split - PRINT), return_counts=True)
                keys = np.repeat(keys, np.minimum(c, LEAST))
                parts = keys >> np.uint64(PRINT)
                starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(keys) else np.empty(0, int)
                held = [_packed(x) for x in np.split(keys & LOW, starts[1:])] if len(keys) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts[starts].astype(np.int64)), pa.array(held, pa.binary())], ["part", "keys"]
                )
        pa.default_memory_pool().release_unused()

    return run


def _keys_often(split: int):
    """Of one section, the bits of the keys that come ``LEAST`` times."""

    def run(key: tuple, found: pa.Table) -> pa.Table:
        keys = np.sort(np.concatenate([_unpacked(x) for x in found["keys"].to_pylist()]))
        keys = keys[LEAST - 1 :][keys[LEAST - 1 :] == keys[: len(keys) - LEAST + 1]]
        whole = keys | np.uint64(key[0].as_py() << PRINT)
        return pa.Table.from_batches([_packed_places(np.unique(whole >> np.uint64(split + PRINT - BITS)))])

    return run


def _splits(total: int) -> int:
    """Top bits of a key that say in which section it is counted."""
    return min(max(6, int(np.ceil(np.log2(max(DEPTH * total, 1) / SECTION)))), 64 - PRINT)


def often_grams(spark: SparkSession, texts: DataFrame, words: np.ndarray, total: int) -> np.ndarray:
    """A bitmap of the n-grams that occur ``LEAST`` times, and of few others.

    Most n-grams of a corpus occur once.  To find the others, ``PRINT`` bits of
    each travel, in sections of about ``SECTION`` keys at any size of the corpus;
    only n-grams in the bitmap are counted with all their words.
    """
    split = _splits(total)
    bits = spark.sparkContext.broadcast(Bitmap(words))
    seen = texts.mapInArrow(_keys_seen(bits, split), "part bigint, keys binary")
    found = gather(seen.groupBy("part").applyInArrow(_keys_often(split), "part bigint, places binary"))
    bits.destroy()
    return found


def _count_grams(bits, split: int):
    """For every section of the keys' top ``split`` bits the (context, next token)
    of each depth in it with partial counts, packed: the words' hashes, word by
    word, and the counts.  N-grams that are surely not frequent enough are in no ``bits``."""

    def rows(held: dict[int, list[list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for depth, found in held.items():
            keys, *words = map(np.concatenate, zip(*found))
            order = np.argsort(keys)
            keys = keys[order]
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
            c = np.diff(np.r_[new, len(keys)])
            keys, first = keys[new], order[new]
            # by section and, there, by context: equal words side by side take little room
            half = np.uint64(32 - split // 2)
            near = (words[0][first] >> half << half | words[1][first] >> (np.uint64(64) - half)) >> np.uint64(split)
            order = np.argsort(keys >> np.uint64(64 - split) << np.uint64(64 - split) | near)
            keys, c, words = keys[order], c[order], np.stack([w[first[order]] for w in words])
            parts = keys >> np.uint64(64 - split)
            starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]][: len(parts)])
            ends = [*starts[1:], len(parts)]
            packed = [(words[:, a:b].tobytes(), _planes(c[a:b])) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[starts].astype(np.int64)), pa.array([depth] * len(starts), pa.int32()),
                 pa.array([w for w, _ in packed], pa.binary()), pa.array([c for _, c in packed], pa.binary())],
                ["part", "depth", "words", "c"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = bits.value.bits
        held: dict[int, list[list[np.ndarray]]] = {}
        n = 0
        for batch in batches:
            for tokens in pieces(byte_list(batch.column("text")), HELD):
                for depth in range(1, DEPTH + 1):
                    words = _grams(tokens, depth)
                    keys = key_of(ENTRY, *words)
                    use = np.flatnonzero(in_bitmap(often, keys))
                    held.setdefault(depth, []).append([keys[use], *(w[use] for w in words)])
                    n += len(use)
                if n >= HELD_GRAMS:
                    yield from rows(held)
                    held, n = {}, 0
        yield from rows(held)
        pa.default_memory_pool().release_unused()

    return run


def _sum_grams(_: tuple, found: pa.Table) -> pa.Table:
    """Of one section, the n-grams that occur ``LEAST`` times: depth, key, the key
    of the context, that of the n-gram without its first word, and count."""
    tables = []
    for depth in range(1, DEPTH + 1):
        packed = found.filter(pc.equal(found["depth"], depth))
        if not packed.num_rows:
            continue
        blocks = [np.frombuffer(x.as_buffer(), np.uint64).reshape(depth + 1, -1) for x in packed["words"]]
        words = [np.concatenate([b[i] for b in blocks]) for i in range(depth + 1)]
        c = np.concatenate([_numbers(x.as_buffer()) for x in packed["c"]]).astype(np.int64)
        keys = key_of(ENTRY, *words)
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        c = np.add.reduceat(c[order], new) if len(new) else c
        some = c >= LEAST
        words = [w[order[new[some]]] for w in words]
        context, suffix = (x[0] if depth == 1 else key_of(ENTRY, *x) for x in (words[:-1], words[1:]))
        columns = [x.view(np.int64) for x in (keys[new[some]], context, suffix)]
        tables.append(
            pa.table([pa.array(np.full(some.sum(), depth, np.int32)), *map(pa.array, columns), pa.array(c[some])], _GRAM)
        )
    return pa.concat_tables(tables)


_GRAM = ["depth", "key", "context", "suffix", "c"]


def _hashed(counted: DataFrame) -> DataFrame:
    """(w, c) of the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = word_hashes(batch.column("word").cast(pa.binary())).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column("c")], ["w", "c"])

    return counted.select("word", "c").mapInArrow(run, "w bigint, c bigint")


def _meet(rows: DataFrame, column: str, table: DataFrame, often: Column, values: list[str]) -> DataFrame:
    """Rows with ``values`` of the table's row whose ``w`` is ``column``.  The
    few frequent ones are broadcast; rows that met them are dealt by all they hold."""
    few = table.filter(often).select(F.col("w").alias(column), *[F.col(v).alias(f"few_{v}") for v in values])
    rest = table.filter(~often).select(F.col("w").alias("rest_w"), *[F.col(v).alias(f"rest_{v}") for v in values])
    rest = rest.withColumn("rest_met", F.lit(False))
    both = rows.join(F.broadcast(few), column, "left").withColumn("met", F.col(f"few_{values[0]}").isNotNull())
    both = both.withColumn("deal", F.when(F.col("met"), F.xxhash64(*rows.columns)).otherwise(F.col(column)))
    both = both.join(rest, (F.col("deal") == F.col("rest_w")) & (F.col("met") == F.col("rest_met")), "left")
    return both.select(*rows.columns, *[F.coalesce(f"few_{v}", f"rest_{v}").alias(v) for v in values])


def _contexts(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """``sizes`` (key, n, more) with ``retained`` and ``back_off``, null for those that
    are no context of entries with ``c`` and ``shorter``, the chance in the suffix context."""
    seen, n, low, free = F.col("seen"), F.col("n"), F.col("low"), F.col("free")
    sums = entries.groupBy("context").agg(
        F.sum("c").alias("seen"),
        F.sum("shorter").alias("low"),
        F.sum(F.col("c") * F.log(F.col("c") / F.col("shorter"))).alias("gain"),
        F.count(F.lit(1)).cast("double").alias("free"),
    )
    rest = F.greatest(1 - (seen + PRIOR * low) / (n + PRIOR), F.lit(1e-12))
    rest_low = F.greatest(1 - low, F.lit(1e-12))
    left = F.greatest(n - seen, F.lit(0))
    ratio = 2 * (F.col("gain") - seen * F.log(n)) + 2 * left * F.log(F.greatest(left / n, F.lit(1e-12)) / rest_low)
    return sizes.join(sums, F.col("key") == F.col("context"), "left").select(
        *sizes.columns,
        (ratio > free + SIGMAS * F.sqrt(2 * free)).alias("retained"),
        F.when(seen.isNotNull(), F.log10(rest / rest_low)).alias("back_off"),
    )


def train_tree(spark: SparkSession, texts: DataFrame, counted: DataFrame) -> tuple[SuffixTree, int, int, int]:
    """The tree, N, V and the number of training documents, from the training
    texts and their (word, c) table."""
    n, v, ends, once, twice = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("c"))), F.lit(0)),
        F.count_if(F.col("c") == 1),
        F.count_if(F.col("c") == 2),
    ).first()
    discount = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))
    unknown, total = discount * v, float(max(n, 1))
    common = F.col("c") >= max(1.0, COMMON_SHARE * n)
    words = materialise(spark, _hashed(counted), "word-hashes")
    chance = (F.col("c") - discount) / total

    often = often_grams(spark, texts, bitmap(words.filter(F.col("c") >= LEAST), "w"), int(n))
    bits = spark.sparkContext.broadcast(Bitmap(often))
    del often
    grams = texts.mapInArrow(_count_grams(bits, _splits(int(n))), "part bigint, depth int, words binary, c binary")
    grams = grams.groupBy("part").applyInArrow(_sum_grams, "depth int, key bigint, context bigint, suffix bigint, c bigint")
    grams = materialise(spark, grams, "grams")
    bits.destroy()

    smooth = F.log10((F.col("c") + PRIOR * F.col("shorter")) / (F.col("n") + PRIOR))
    longer = F.log10("shorter")

    # first level: contexts of one token
    pairs = grams.filter("depth = 1").select("key", "context", "suffix", "c")
    entries = _meet(pairs, "suffix", words.select("w", chance.alias("shorter"), "c"), common, ["shorter"]).drop("suffix")
    entries = materialise(spark, entries, "entries-1")
    first = materialise(spark, _contexts(entries, words.select(F.col("w").alias("key"), F.col("c").alias("n"))), "contexts-1")
    known = first.filter("retained IS NOT NULL").select(F.col("key").alias("w"), F.col("n").alias("c"), "n", "retained", "back_off")
    full = _meet(entries, "context", known, common, ["n", "retained", "back_off"])
    log = F.when(F.col("retained"), smooth).otherwise(longer)
    full = full.select("key", F.col("c").alias("n"), log.alias("log"), F.when(F.col("retained"), log - longer - F.col("back_off")).alias("adds"))
    pairs = materialise(spark, full, "pairs")
    release(spark, words, entries)

    # second level: contexts of two tokens
    suffix = pairs.select(F.col("key").alias("suffix"), F.pow(F.lit(10.0), "log").alias("shorter"))
    entries = grams.filter("depth = 2").select("key", "context", "suffix", "c").join(suffix, "suffix").drop("suffix")
    entries = materialise(spark, entries, "entries-2")
    release(spark, grams)
    second = materialise(spark, _contexts(entries, pairs.select("key", "n", "adds")), "contexts-2")
    release(spark, pairs)
    contexts = second.filter("retained").select(F.col("key").alias("context"), "n", "back_off")
    triples = entries.join(contexts, "context").select("key", "c", (smooth - longer - F.col("back_off")).alias("adds"))

    # one table: key, how often it occurs, what it adds to its own and to the next token, and the count of a word
    unknown_log = float(np.log10(max(unknown, 1e-9) / total))
    zero, nothing = F.lit(0).cast("bigint").alias("count"), F.lit(0.0)
    back = F.when(F.col("retained"), F.col("back_off")).otherwise(nothing).alias("back")
    c = F.col("n").alias("c")
    own = (F.log10((F.col("n") - discount) / total) - unknown_log).alias("adds")
    table = first.select("key", c, own, back, F.col("n").alias("count"))
    some = second.filter("retained OR adds IS NOT NULL")
    table = table.unionByName(some.select("key", c, F.coalesce("adds", nothing).alias("adds"), back, zero))
    table = table.unionByName(triples.select("key", "c", "adds", nothing.alias("back"), zero))
    step = F.floor(8 * F.log2("c")).cast("int")
    table = materialise(spark, table.withColumn("step", step).drop("c"), "suffix-tree")
    release(spark, entries)
    least, held = 1 << 30, 0
    for row in sorted(table.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        held += row["count"]
        if held > HEAD_KEYS:
            break
        least = row["step"]
    head = table.filter(F.col("step") >= least).select("key", "adds", "back", "count").toArrow()
    keys = head["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    tail = table.filter(F.col("step") < least).select("key", (F.col("adds") + F.col("back")).alias("adds"), "count")
    tree = SuffixTree(
        int(n),
        unknown,
        discount,
        keys[order],
        head["adds"].to_numpy()[order],
        head["back"].to_numpy()[order],
        head["count"].to_numpy()[order],
        bitmap(tail, "key"),
        tail=tail,
        frequent=counted.filter(common | (F.col("word") == END)).select("word", "c"),
    )
    del head, keys, order
    for contexts in (first, second):
        some = contexts.filter((F.floor(8 * F.log2("n")) >= least) & F.col("retained").isNotNull()).select("retained").toArrow()
        tree.levels.append(Level(some["retained"].to_numpy()))
    release(spark, first, second)
    pa.default_memory_pool().release_unused()
    return tree, int(n), int(v), int(ends)


_NAMES = ["id", "d", "held_out", "n_tokens", "n_known", "base", "score"]
_SUMS = "id {kind}, d bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
_PARTIALS = f"{_SUMS}, bundle int, ds binary, n_knowns binary, bases binary, scores binary"
_ROWS = f"{_SUMS}, part int, asking binary, sizes binary, keys binary, tf binary"


def _sections(total: int, each: int = ASKED, bits: tuple[int, int] = ASKED_BITS) -> int:
    """Top bits of a key that say which section of the table it is in."""
    return min(max(bits[0], int(np.ceil(np.log2(max(total, 1) / each)))), bits[1])


def _by_top(numbers: np.ndarray, split: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The order by the ``split`` top bits, what these are, and where each begins, and the end."""
    part = (numbers.view(np.uint64) >> np.uint64(64 - split)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
    return order, part[order][starts].astype(np.int32), [*starts.tolist(), len(part)]


def _sectioned(split: int):
    """The table's n-grams as one packed row for each section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in _TAIL]
            order, parts, at = _by_top(columns[0], split)
            columns = [x[order] for x in columns]
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()) for x in columns]
            yield pa.RecordBatch.from_arrays([pa.array(parts), *packed], ["part", *_TAIL])

    return run


_TAIL = ["key", "adds", "count"]


def _unpack(packed: pa.Table, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """Columns of numbers that stand packed in rows."""
    return {c: np.concatenate([np.empty(0, k), *(np.frombuffer(x.as_buffer(), k) for x in packed[c])]) for c, k in kinds.items()}


_PARTIAL = {"d": np.int64, "n_known": np.int64, "base": np.float64, "score": np.float64}


def _met(bits: int):
    """Of one section, the documents' own rows and, packed for each group of documents,
    what the section adds to them."""

    def run(asked: pa.Table, packed: pa.Table) -> pa.Table:
        table = _unpack(packed, dict(zip(_TAIL, (np.int64, np.float64, np.int64))))
        found = _answer(asked, pa.table({c: pa.array(x) for c, x in table.items()}))
        mine = pc.is_valid(found["n_tokens"])
        own = found.filter(mine)
        added = found.filter(pc.invert(mine))
        columns = {c: added[c].to_numpy() for c in _PARTIAL}
        order, parts, at = _by_top(columns["d"], bits)
        columns = {c: x[order] for c, x in columns.items()}
        own = own.append_column("bundle", pa.array((own["d"].to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32)))
        for c in _PARTIAL:
            own = own.append_column(f"{c}s", pa.nulls(len(own), pa.binary()))
        rest = {c: pa.nulls(len(parts), own[c].type) for c in _NAMES} | {"bundle": pa.array(parts)}
        rest |= {f"{c}s": pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()) for c, x in columns.items()}
        return pa.concat_tables([own, pa.table(rest)])

    return run


def _summed(_: tuple, found: pa.Table) -> pa.Table:
    """The rows of a group of documents, with what all sections add to them."""
    mine = pc.is_valid(found["n_tokens"])
    own = found.filter(mine)
    added = _unpack(found.filter(pc.invert(mine)), {f"{c}s": k for c, k in _PARTIAL.items()})
    # equal rows have the same number, and share what all of them asked
    numbers, at, times = np.unique(own["d"].to_numpy(), return_inverse=True, return_counts=True)
    to = np.searchsorted(numbers, added["ds"])
    out = {c: own[c] for c in ("id", "held_out", "n_tokens")}
    for c in ("n_known", "base", "score"):
        more = np.bincount(to, added[f"{c}s"], len(numbers)) / times
        out[c] = pa.array((own[c].to_numpy() + more[at]).astype(_PARTIAL[c]))
    return pa.table(out)


def _questions(d: np.ndarray, keys: np.ndarray, tf: np.ndarray, split: int) -> list[tuple]:
    """For each section (part, asking, sizes, keys, tf): the documents that ask it,
    how many keys each asks, and all keys with their counts.  A document's keys
    stand together in ``keys``."""
    part = (keys >> np.uint64(64 - split)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    part, d, keys, tf = part[order], d[order], keys[order], tf[order]
    new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (d[1:] != d[:-1])][: len(part)])
    starts = np.flatnonzero(np.diff(part[new].astype(np.int64), prepend=-1))
    asking, sizes = np.split(d[new], starts[1:]), np.split(np.diff(np.r_[new, len(part)]), starts[1:])
    keys, tf = np.split(keys, new[starts][1:]), np.split(tf, new[starts][1:])
    return [
        (int(p), asking[i].tobytes(), _planes(sizes[i]), keys[i].tobytes(), _planes(tf[i]))
        for i, p in enumerate(part[new[starts]])
    ]


def _score(tree, split: int):
    """For every document one row with what is known here, and for a block of them
    and each section of the table one with the distinct n-grams that may be there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tree.value
        for batch in slices(batches):
            size = batch.num_rows
            d = batch.column("d").to_numpy(zero_copy_only=False)
            sums = {k: np.zeros(size) for k in ("n_tokens", "n_known", "base", "score")}
            far: list[tuple] = []
            for tokens in pieces(byte_list(batch.column("text")), PIECE):
                sums["n_tokens"] += np.bincount(tokens.text[tokens.new], minlength=size)
                keys, where = model.grams(tokens)
                order = np.argsort(keys)
                keys, text = keys[order], tokens.text[where[order]]
                new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                one, n = keys[new], np.diff(np.r_[new, len(keys)])
                at, seen = _find(model.keys, one)
                here, n_here, found = at[seen], n[seen], text[np.repeat(seen, n)]
                c = model.counts[here]
                sums["score"] += np.bincount(found, np.repeat(model.adds[here] + model.back[here], n_here), size)
                sums["base"] += np.bincount(found, np.repeat(np.log10(c + 1.0), n_here), size)
                sums["n_known"] += np.bincount(found, np.repeat(c > 0, n_here), size)
                asks = ~seen
                asks[asks] = in_bitmap(model.bits, one[asks])
                asks = np.repeat(asks, n)
                keys, text = keys[asks], text[asks]
                # by section and text, so that a text's equal keys stand together
                top = keys >> np.uint64(64 - split) << np.uint64(64 - split)
                order = np.argsort(top | text.astype(np.uint64) << np.uint64(48 - split) | keys << np.uint64(split) >> np.uint64(split + 16))
                keys, text = keys[order], text[order]
                new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])][: len(keys)])
                far += _questions(d[text[new]], keys[new], np.diff(np.r_[new, len(keys)]), split)
            sums["score"] += sums["n_tokens"] * model.unknown_log
            home = (d.view(np.uint64) >> np.uint64(64 - split)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("d"), batch.column("held_out"),
                 *(pa.array(sums[k].astype(np.int64)) for k in ("n_tokens", "n_known")),
                 *(pa.array(sums[k]) for k in ("base", "score")),
                 pa.array(home), *[pa.nulls(size, pa.binary())] * 4],
                [*_NAMES, *_ASKS],
            )
            kinds = [batch.column("id").type, pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            columns = [pa.array(x, k) for x, k in zip(zip(*far), [pa.int32(), *[pa.binary()] * 4])]
            if far:
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(far), k) for k in kinds), *columns], [*_NAMES, *_ASKS])

    return run


_ASKS = ["part", "asking", "sizes", "keys", "tf"]


def _answer(asked: pa.Table, tail: pa.Table) -> pa.Table:
    """One section: the documents' own rows as they are, and what the table's
    n-grams there add to the documents that ask for them."""
    order = np.argsort(tail["key"].to_numpy().view(np.uint64))
    table = tail["key"].to_numpy().view(np.uint64)[order]
    adds, count = tail["adds"].to_numpy()[order], tail["count"].to_numpy()[order]
    own = asked.filter(pc.is_null(asked["keys"])).select(_NAMES)
    found = [own]
    for row in asked.filter(pc.is_valid(asked["keys"])).select(_ASKS).to_batches(max_chunksize=64):
        read = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in row.column(c)])
        count_of = lambda c: np.concatenate([_numbers(x.as_buffer()) for x in row.column(c)])
        d, keys, tf = read("asking", np.int64), read("keys", np.uint64), count_of("tf")
        order = np.argsort(keys)
        at, seen = _find(table, keys[order])
        at, order = at[seen], order[seen]
        text, tf = np.repeat(np.arange(len(d)), count_of("sizes"))[order], tf[order]
        sums = {
            "n_known": np.bincount(text, tf * (count[at] > 0), len(d)).astype(np.int64),
            "base": np.bincount(text, tf * np.log10(count[at] + 1.0), len(d)),
            "score": np.bincount(text, tf * adds[at], len(d)),
        }
        some = np.bincount(text, minlength=len(d)) > 0
        columns = {"d": d} | sums
        found.append(
            pa.table([pa.array(columns[c][some]) if c in columns else pa.nulls(some.sum(), own[c].type) for c in _NAMES], _NAMES)
        )
    return pa.concat_tables(found)


def lm_score(
    spark: SparkSession, docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` of every row; rows where ``held_out`` (a function
    of the id column) is true teach nothing.

    Null text is empty: one token, the end.  Null ids and repeated rows keep
    one result each; an empty table gives no rows; without training documents
    all tokens are unknown, for certain (score 0); other columns are not read.
    """
    bounded_batches(spark)
    rows = docs.select(docs[name_of(id_col)].alias("id"), docs[name_of(text_col)].alias("text")).withColumn(
        "held_out", held_out(F.col("id"))
    )
    texts = rows.filter("NOT held_out").select("text")
    words = texts.mapInArrow(_count_words, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    with brief_shuffles(spark), hashed_joins(spark, HASHED_MB):
        counted = materialise(spark, words, "word-counts")
        tree, n, v, ends = train_tree(spark, texts, counted)
    release(spark, counted)
    split = _sections(n)
    # equal rows have the same number, and so the same results
    asked = rows.withColumn(
        "d", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNull(), F.coalesce("text", F.lit("")))
    )
    kind = dict(rows.dtypes)["id"]
    scored = asked.mapInArrow(_score(spark.sparkContext.broadcast(tree), split), _ROWS.format(kind=kind))
    tail = tree.tail.mapInArrow(_sectioned(split), "part int, key binary, adds binary, count binary")
    bits = _sections(n, SUMMED, SUMMED_BITS)
    met = scored.groupBy("part").cogroup(tail.groupBy("part")).applyInArrow(_met(bits), _PARTIALS.format(kind=kind))
    whole = met.groupBy("bundle").applyInArrow(
        _summed, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
    )
    return whole.select(
        "id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        "score",
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return lm_score(spark, docs, lambda doc_id: fold(doc_id, 7) == 2).withColumnRenamed("id", "doc_id")
