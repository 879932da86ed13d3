"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20

# FIXED VALUES: odd 64-bit multipliers that mix the word hashes of a shingle by position.
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    np.uint64,
)


def byte_blocks(data: bytes) -> Iterator[bytes]:
    """A text, block by block, cut where words end."""
    at = 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[at:end]
        at = end


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, block by block; ``bytes.split`` splits at exactly
    space and 0x09-0x0D."""
    for block in byte_blocks(data):
        yield block.split()


def word_places(block: bytes) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of ``bytes.split`` as an Arrow array, and where they start."""
    data = np.frombuffer(block, np.uint8)
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    ends = np.cumsum(edges[1::2] - edges[::2])
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, edges[::2]


def word_array(block: bytes) -> pa.BinaryArray:
    """The words of ``bytes.split`` as an Arrow array."""
    return word_places(block)[0]


#: Longest word, in bytes, that is hashed lane by lane.
_LANES = 64


def word_hashes(words: pa.BinaryArray) -> np.ndarray:
    """64-bit hashes of words: of a word's length and its lanes of 8 bytes, each mixed
    in reversibly; long words by xxhash."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    at, size = offsets[:-1], np.diff(offsets)
    data = (words.buffers()[2] or pa.py_buffer(b"")).to_pybytes() + bytes(8)
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = size.astype(np.uint64) * _MIX[1]
    here = np.arange(len(words))
    for lane in range(0, _LANES, 8):
        left = size[here] - lane
        empty = np.maximum(8 - left, 0).astype(np.uint64) << np.uint64(3)
        value = lanes[at[here] + lane] << empty
        out[here] = _scramble(out[here] ^ (value * _MIX[0]))
        here = here[left > 8]
        if not len(here):
            return out
    long = np.flatnonzero(size > _LANES)
    out[long] = [xxhash.xxh3_64_intdigest(w) for w in words.take(pa.array(long)).to_pylist()]
    return out


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(data: bytes, width: int = 5) -> np.ndarray:
    """Distinct hashes of ``width`` consecutive words, ascending; a text with
    fewer words has one shingle, its whole word sequence; one without words
    has none."""
    parts, tail = [], np.empty(0, np.uint64)
    for words in word_blocks(data):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        tail = np.concatenate([tail, hashes])
        n = len(tail) - width + 1
        if n > 0:
            h = tail[:n] * _MIX[0]
            for i in range(1, width):
                h = _scramble(h) + tail[i : i + n] * _MIX[i % len(_MIX)]
            parts.append(np.unique(_scramble(h)))
            tail = tail[n:]
    if not parts:
        if not len(tail):
            return tail
        whole = tail[:1] * _MIX[:1]
        for i in range(1, len(tail)):
            whole = _scramble(whole) + tail[i : i + 1] * _MIX[i % len(_MIX)]
        return _scramble(whole) ^ np.uint64(len(tail))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
