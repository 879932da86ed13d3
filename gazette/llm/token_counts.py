"""Token counts by finite-state tokenizer compilation.

A byte-pair vocabulary becomes a deterministic transducer over bytes.  BPE has
one encoding for every prefix, and a token may follow another exactly if the
two, encoded together, stay apart; so a state holds the starts that a token
can still grow from (trie node, token before it, tokens so far), and the
tokens that no open start can undo any more are the count on the transition.
States are compiled when first reached and the table is bounded.

A text is cut into chunks.  Each chunk alone gives a state map: what stands
before its first certain boundary, the count between, what stands after the
last.  Maps compose associatively, so a balanced scan yields the whole count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import bounded_batches, name_of, slices
from gazette.llm.pretokens import certain_cuts, split

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 1 << 16
MAX_TRANSITIONS = 500_000
MAX_PAIRS = 300_000
MAX_WORDS = 200_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Byte transducer of a byte-level BPE vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        ids = {raw(token): i for token, i in spec["model"]["vocab"].items() if all(c in letters for c in token)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.text = {i: token for token, i in ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> rank and parts of its merge
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            whole = ids[left + right]
            self.merges[ids[left], ids[right]] = rank, whole
            self.made.setdefault(whole, (rank, ids[left], ids[right]))
        self.single = [ids[bytes([b])] for b in range(256)]
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        self.token = [-1]
        self.inner = [True]
        for token, i in ids.items():
            node = 0
            for b in token:
                self.inner[node] = True
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, int] = {}
        self._forget()

    def _forget(self) -> None:
        """Start the compiled table anew."""
        self.states = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        self.next: dict[int, tuple[int, int]] = {}  # state << 8 | byte -> state, emitted

    def encode(self, data: bytes) -> list[int]:
        """BPE by its definition: merge the best-ranked pair until none is left."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min(
                (self.merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges
            ) if any(p in self.merges for p in zip(ids, ids[1:])) else None
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [self.merges[ids[i], ids[i + 1]][1]]
        return ids

    def follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand after ``before`` (-1: at the start)."""
        key = before, token
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.encode(self.text[token]) == [token] if before < 0 else self._stay_apart(before, token)
            self.pairs[key] = found
        return found

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo the two tokens' merges, latest first, and ask at every step
        whether the symbols that then met at the border would have merged
        before either was used up.  Of equal ranks the leftmost goes first."""
        none = (-1, left, right)
        left_end = right_end = len(self.merges)  # ranks at which the symbols are used up
        while True:
            met = self.merges.get((left, right))
            if met is not None and met[0] < left_end and met[0] <= right_end:
                return False
            left_made, right_made = self.made.get(left, none), self.made.get(right, none)
            if left_made[0] < 0 and right_made[0] < 0:
                return True
            if left_made[0] > right_made[0]:
                left_end, _, left = left_made
            else:
                right_end, right, _ = right_made

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition from a state: open starts grow by the byte, one of
        them ends in the only token that may end here."""
        grown, done = [], None
        for node, before, count in self.states[state]:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            token = self.token[to]
            if done is None and token >= 0 and self.follows(before, token):
                done = token, count + 1
            if self.inner[to]:
                grown.append((to, before, count))
        grown.append((0, *done))
        sure = min(count for _, _, count in grown)
        new = tuple((node, before, count - sure) for node, before, count in grown)
        number = self.number.setdefault(new, len(self.states))
        if number == len(self.states):
            self.states.append(new)
        return number, sure

    def count(self, word: bytes) -> int:
        """Tokens of one pretoken: transitions' counts, then the end state's."""
        if len(self.next) >= MAX_TRANSITIONS:
            self._forget()
        state, total, table = 0, 0, self.next
        for byte in word:
            key = state << 8 | byte
            step = table.get(key)
            if step is None:
                step = table[key] = self._compile(state, byte)
            state = step[0]
            total += step[1]
        return total + self.states[state][-1][2]

    def count_words(self, words: list[bytes]) -> int:
        known = self.words
        found = list(map(known.get, words))
        try:
            return sum(found)
        except TypeError:
            total = 0
            for word, n in zip(words, found):
                if n is None:
                    n = known.get(word)
                    if n is None:
                        n = self.count(word)
                        if len(known) >= MAX_WORDS:
                            known.clear()
                        if len(word) <= 64:
                            known[word] = n
                total += n
            return total

    def plain(self, text: str) -> int:
        return self.count_words(split(text))


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the count: ``head`` and ``tail`` await their
    neighbours; without a certain boundary (``count`` None) all is head."""

    head: str
    count: int | None = None
    tail: str = ""

    def then(self, other: ChunkMap, machine: Transducer) -> ChunkMap:
        if self.count is None:
            return ChunkMap(self.head + other.head, other.count, other.tail)
        if other.count is None:
            return ChunkMap(self.head, self.count, self.tail + other.head)
        middle = machine.plain(self.tail + other.head)
        return ChunkMap(self.head, self.count + middle + other.count, other.tail)

    def total(self, machine: Transducer) -> int:
        return machine.plain(self.head) + (self.count or 0) + machine.plain(self.tail)


def chunk_map(text: str, machine: Transducer) -> ChunkMap:
    first, last = certain_cuts(text)
    if first < 0:
        return ChunkMap(text)
    return ChunkMap(text[:first], machine.plain(text[first:last]), text[last:])


def scan(maps: list[ChunkMap], machine: Transducer) -> ChunkMap:
    """Compose neighbouring maps, level by level."""
    while len(maps) > 1:
        maps = [
            maps[i].then(maps[i + 1], machine) if i + 1 < len(maps) else maps[i]
            for i in range(0, len(maps), 2)
        ]
    return maps[0]


def count_tokens(text: str, machine: Transducer) -> int:
    """Tokens of a whole text; special strings inside it count as one each."""
    total, parts = 0, [text]
    for special in machine.specials:
        if special in text:
            pieces = [p.split(special) for p in parts]
            total += sum(len(p) - 1 for p in pieces)
            parts = [x for p in pieces for x in p]
    for part in parts:
        if len(part) <= CHUNK:
            total += machine.plain(part)
        else:
            maps = [chunk_map(part[i : i + CHUNK], machine) for i in range(0, len(part), CHUNK)]
            total += scan(maps, machine).total(machine)
    return total


@lru_cache(maxsize=2)
def _machine(path: str) -> Transducer:
    return Transducer(path)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens`` of every row.

    Null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows
    pass through, one result each; an empty table gives no rows; other columns
    are not read.  ``path`` names the vocabulary file on the workers.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs[name_of(id_col)].alias("id"), docs[name_of(text_col)].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(path or vocabulary_path())
        for batch in slices(batches):
            counts = [count_tokens(t, machine) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    sized = rows.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return sized.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_bytes bigint, n_tokens bigint")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )
