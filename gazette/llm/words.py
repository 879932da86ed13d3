"""Words of whole texts by Arrow kernels, long texts in segments."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters that end a word; whatever else there is makes words.
NOT_ALPHANUMERIC = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of text that the kernels hold at once, and of a segment of a long text.
CHUNK, SEGMENT = 4 << 20, 1 << 20


@dataclass
class Words:
    """Words of some texts in their order.

    ``segment`` numbers each word's segment, ``owner`` maps segments to rows,
    ``lead`` counts the words that a segment repeats from the one before.
    """

    dictionary: list[bytes]
    index: np.ndarray
    segment: np.ndarray
    owner: np.ndarray
    lead: np.ndarray


def _segments(text: bytes, ends: re.Pattern, inside: re.Pattern, repeat: int) -> Iterator[tuple[bytes, int]]:
    """A text cut between words; each segment begins with the last ``repeat``
    words before it.  A word longer than a segment stays whole."""
    at, carry = 0, []
    while at < len(text) or not at:
        stop = ends.search(text, min(at + SEGMENT, len(text)))
        end = stop.start() + 1 if stop else len(text)
        piece = text[at:end]
        yield b" ".join([*carry, piece]) if carry else piece, len(carry)
        if end >= len(text):
            return
        at = end
        if repeat:
            carry = (carry + inside.findall(piece)[-repeat:])[-repeat:]


def words_of(texts: pa.Array, separators: str, repeat: int = 0) -> Iterator[Words]:
    """Words of lower-cased (A-Z) texts, in chunks of about ``CHUNK`` bytes;
    null has none.  Rows keep their order."""
    ends = re.compile(separators.encode())
    inside = re.compile(separators.replace("[", "[^", 1).encode())
    folded = pc.ascii_lower(pc.fill_null(texts, ""))
    lengths = pc.binary_length(folded).to_numpy(zero_copy_only=False).astype(np.int64)
    row = 0
    while row < len(lengths):
        if lengths[row] > SEGMENT:
            for piece, lead in _segments(folded[row].as_py().encode(), ends, inside, repeat):
                yield _encode(pa.array([piece]).cast(pa.string()), separators, np.array([row]), np.array([lead]))
            row += 1
            continue
        long = np.nonzero(lengths[row:] > SEGMENT)[0]
        room = int(np.searchsorted(np.cumsum(lengths[row:]), CHUNK, "right"))
        n = max(1, min(room, int(long[0]) if len(long) else room))
        yield _encode(folded.slice(row, n), separators, np.arange(row, row + n), np.zeros(n, np.int64))
        row += n


def _encode(folded: pa.Array, separators: str, owner: np.ndarray, lead: np.ndarray) -> Words:
    parts = pc.split_pattern_regex(folded, separators)
    flat, segment = pc.list_flatten(parts), pc.list_parent_indices(parts)
    filled = pc.not_equal(flat, "")
    flat, segment = flat.filter(filled), segment.filter(filled)
    coded = flat.dictionary_encode()
    return Words(
        [w.encode() for w in coded.dictionary.to_pylist()],
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        segment.to_numpy(zero_copy_only=False).astype(np.int64),
        owner,
        lead,
    )
