"""SentencePiece encoding and decoding by streaming Viterbi.

The model is a byte-pair one, so the best path is the one that its merges
leave: every prefix has one, and a piece may follow another exactly if the
two, encoded together, stay apart.  The search keeps the best path to each of
the last positions that a piece can still start from (at most the longest
piece back) and, when that window is full, commits the ids up to the boundary
that the paths to all of them run through.  Characters without a piece fall back to their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import bounded_batches, each, name_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MAX_WORDS = 250_000
MAX_PAIRS = 300_000
MAX_MOVES = 400_000
#: Characters of a text that are taken up at a time.
BLOCK = 1 << 18


class Pieces:
    """Vocabulary of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.unknown = model.unk_id()
        # what an id decodes to
        self.bytes = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b, i in self.byte.items():
            self.bytes[i] = bytes([b])
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i):
                self.bytes[i] = b""
        self.longest = max(map(len, self.ids), default=1)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for piece in self.ids:
            node = 0
            for c in piece:
                to = self.children[node].setdefault(c, len(self.ends))
                if to == len(self.ends):
                    self.children.append({})
                    self.ends.append(None)
                node = to
            self.ends[node] = piece
        # characters of longer pieces by number, and which stand side by side in a piece
        letters = sorted({c for piece in self.ids if len(piece) > 1 for c in piece})
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1,) * 2, bool)
        for piece in self.ids:
            for x, y in zip(piece, piece[1:]):
                self.beside[self.kind[ord(x)], self.kind[ord(y)]] = True
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.made: dict[str, tuple[float, str, str] | None] = {}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self._forget()

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging by its definition: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            options = [
                (-self.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score
            ]
            if not options:
                break
            i = min(options)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, before: str | None, piece: str) -> bool:
        """Whether a piece may stand after another (None: nothing that merges)."""
        key = before, piece
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            if before is None:
                found = self._last_merge(piece) is not None
            elif SPACE * 2 in (before[:2], piece[:2]):  # runs of spaces share one score
                found = self.merged(before + piece) == [before, piece]
            else:
                found = self._last_merge(piece) is not None and self._stay_apart(before, piece)
            self.pairs[key] = found
        return found

    def _last_merge(self, piece: str) -> tuple[float, str, str] | None:
        """Rank and parts of the merge that completes a piece (a character
        ranks before all); None if merging never yields it."""
        found = self.made.get(piece, ())
        if found == ():
            if len(piece) == 1:
                found = -1.0, piece, piece
            else:
                found = None
                for cut in range(1, len(piece)):
                    left, right = piece[:cut], piece[cut:]
                    if left in self.score and right in self.score and self._last_merge(left) and self._last_merge(right):
                        if self._stay_apart(left, right, -self.score[piece]):
                            found = -self.score[piece], left, right
                            break
            self.made[piece] = found
        return found

    def _stay_apart(self, left: str, right: str, until: float = float("inf")) -> bool:
        """Undo the merges of two pieces, latest first: they stay apart (until
        a rank) if at no step the symbols that met at the border would have
        merged before either was used up.  Of equal ranks the left goes first."""
        left_end = right_end = until
        while True:
            met = self.score.get(left + right)
            if met is not None and -met < left_end and -met <= right_end and -met < until:
                return False
            of_left, of_right = self._last_merge(left), self._last_merge(right)
            if of_left[0] < 0 and of_right[0] < 0:
                return True
            if of_left[0] > of_right[0]:
                left_end, _, left = of_left
            else:
                right_end, right, _ = of_right

    def fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte.get(b, self.unknown) for b in char.encode())

    def _move(self, state: int, char: str) -> tuple[int, tuple[int, ...], int, str | None]:
        """What a character does to the open starts of a state (each a trie
        node and the piece before it): the next state, which starts stay open,
        and the start and piece of the best path to here (-1: bytes)."""
        grown, kept, best, piece = [], [], -1, None
        for i, (node, before) in enumerate(self.states[state]):
            to = self.children[node].get(char)
            if to is None:
                continue
            ended = self.ends[to]
            if best < 0 and ended is not None and self.follows(before, ended):
                best, piece = i, ended
            if self.children[to]:
                grown.append((to, before))
                kept.append(i)
        if best < 0:  # no piece holds this character
            grown, kept = [], []
        new = (*grown, (0, piece))
        number = self.number.setdefault(new, len(self.states))
        if number == len(self.states):
            self.states.append(new)
        found = self.moves[state, char] = number, tuple(kept), best, piece
        return found

    def viterbi(self, stream: Iterator[str]) -> Iterator[int]:
        """Ids of a stream of characters, committed as early as they are sure.
        What a character does depends on the open starts' nodes and pieces
        alone and is remembered."""
        if len(self.moves) >= MAX_MOVES:
            self._forget()
        before: dict[int, int] = {}  # where the best path to a position comes from
        last: dict[int, tuple[int, ...]] = {}  # and its last ids
        moves, ids, longest = self.moves, self.ids, self.longest
        done, state, starts, at = 0, 0, [0], 0
        for char in stream:
            at += 1
            state, kept, best, piece = moves.get((state, char)) or self._move(state, char)
            if best < 0:
                before[at], last[at], starts = at - 1, self.fallback(char), [at]
            else:
                before[at], last[at] = starts[best], (ids[piece],)
                starts = [starts[i] for i in kept]
                starts.append(at)
            if at - done > longest and starts[0] > done:
                # the window is full: the boundary that all open paths run through
                sure = at
                for start in starts:
                    while sure != start:
                        if sure > start:
                            sure = before[sure]
                        else:
                            start = before[start]
                if sure > done:
                    yield from self._path(before, last, sure, done)
                    for old in range(done, sure):  # no open path needs them
                        before.pop(old, None)
                        last.pop(old, None)
                    done = sure
        yield from self._path(before, last, at, done)

    @staticmethod
    def _path(before: dict[int, int], last: dict[int, tuple[int, ...]], end: int, done: int) -> list[int]:
        out: list[tuple[int, ...]] = []
        while end != done:
            out.append(last[end])
            end = before[end]
        return [i for ids in reversed(out) for i in ids]

    def _forget(self) -> None:
        """Start the remembered moves anew."""
        self.states: list[tuple[tuple[int, str | None], ...]] = [((0, None),)]
        self.number = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], tuple[int, tuple[int, ...], int, str | None]] = {}

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text.  Spaces become ``SPACE`` and one goes in front.
        Two characters that stand side by side in no piece are parted for
        certain, so the stream is fed unit by unit and frequent units are
        remembered."""
        out = []
        for units in self._units(text):
            found = list(map(self.words.get, units))
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._new(units[i])
            out += found
        return np.frombuffer(b"".join(out), "<u4")

    def _new(self, unit: bytes) -> bytes:
        """Ids of a unit that the younger memory lacks; when that is full it
        becomes the older one, so frequent units stay known."""
        ids = self.older.get(unit)
        if ids is None:
            ids = np.array(list(self.viterbi(unit.decode())), "<u4").tobytes()
        if len(unit) <= 64:
            if len(self.words) >= MAX_WORDS:
                self.words, self.older = {}, self.words
            self.words[unit] = ids
        return ids

    def _units(self, text: str) -> Iterator[list[bytes]]:
        """The parts of a text between certain cuts, block by block."""
        rest = SPACE if text else ""
        for at in range(0, len(text), BLOCK):
            part = rest + text[at : at + BLOCK].replace(" ", SPACE)
            data = part.encode()
            view = np.frombuffer(data, np.uint8)
            kind = self.kind[np.frombuffer(part.encode("utf-32-le"), "<u4")]
            mark = np.zeros(len(view), bool)
            mark[(view & 0xC0) != 0x80] = np.concatenate([[False], ~self.beside[kind[:-1], kind[1:]]])
            # a byte that UTF-8 never holds goes before each cut, then one split cuts all
            place = np.cumsum(mark)
            out = np.full(len(view) + int(place[-1]), 0xFF, np.uint8)
            place += np.arange(len(view))
            out[place] = view
            units = out.tobytes().split(b"\xff")
            rest = units.pop().decode()
            yield units
        if rest:
            yield [rest.encode()]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the space in front goes."""
        table = self.bytes
        data = b"".join([table[i] for i in ids.tolist()])
        return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _pieces(path: str | None) -> Pieces:
    import public_tokenizers

    return Pieces(path or public_tokenizers.path(MODEL))


def encoder(path: str | None = None):
    """Arrow UDF: text -> ids as little-endian unsigned 32-bit bytes."""

    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        model = _pieces(path)
        return pa.array(
            [model.encode(t).tobytes() if t else b"" for t in each(texts)], pa.binary()
        )

    return encode


def decoder(path: str | None = None):
    """Arrow UDF: ids as bytes -> text."""

    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        model = _pieces(path)
        return pa.array([model.decode(np.frombuffer(x or b"", "<u4")) for x in each(ids)], pa.string())

    return decode


def sentence_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id``, ``text``, ``ids`` and ``decoded`` of every row.

    Null text is empty: no ids, decoded as empty.  Null ids and repeated rows
    pass through, one result each; an empty table gives no rows; other columns
    are not read.  A ``SPACE`` character in a text decodes as a space.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        docs[name_of(id_col)].alias("id"), F.coalesce(docs[name_of(text_col)], F.lit("")).alias("text")
    )
    coded = rows.withColumn("ids", encoder(path)("text"))
    return coded.withColumn("decoded", decoder(path)("ids"))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents``, and whether they decode to it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sentence_pieces(docs).select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
