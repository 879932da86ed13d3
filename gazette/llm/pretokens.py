"""Where byte-level BPE may not merge: the pretoken boundaries of a text.

The published pattern is
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Whether a pretoken starts at a character depends on the classes of at most
four neighbours, so all boundaries of a text come from a few array operations.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, OTHER, SPACE, BLANK = range(5)
_APOSTROPHE = 39


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        kind = unicodedata.category(c)[0]
        if kind == "L":
            out[code] = LETTER
        elif kind == "N":
            out[code] = NUMBER
        elif c.isspace() and not 0x1C <= code <= 0x1F:
            out[code] = BLANK
    out[32] = SPACE
    return out


@lru_cache(maxsize=1)
def _ascii_classes() -> bytes:
    return char_classes()[:256].tobytes()


def starts(cls: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Boolean per code point (with its class): a pretoken starts here."""
    n = len(cls)
    out = np.ones(n, bool)
    if n < 2:
        return out
    blank = cls >= SPACE
    follows_blank, here = blank[:-1], blank[1:]
    last = np.zeros(n - 1, bool)
    last[:-1] = ~blank[2:]
    out[1:] = (here & (~follows_blank | last)) | (~here & (cls[1:] != cls[:-1]) & (cls[:-1] != SPACE))
    at = np.flatnonzero((codes == _APOSTROPHE) & out)
    at = at[at + 1 < n]
    if len(at):
        one = codes[at + 1]
        two = np.where(at + 2 < n, codes[np.minimum(at + 2, n - 1)], 0)
        short = np.isin(one, [ord(x) for x in "stmd"])
        pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        pairs |= (one == ord("l")) & (two == ord("l"))
        for hit, size in ((at[short], 2), (at[pairs], 3)):
            out[hit + 1] = False
            out[(hit + size)[hit + size < n]] = True
    return out


def split(text: str) -> list[bytes]:
    """The pretokens of a text as UTF-8."""
    if not text:
        return []
    data = text.encode()
    view = np.frombuffer(data, np.uint8)
    if len(data) == len(text):
        mark = starts(np.frombuffer(data.translate(_ascii_classes()), np.uint8), view)
    else:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        mark = np.zeros(len(view), bool)
        mark[(view & 0xC0) != 0x80] = starts(char_classes()[codes], codes)
    mark[0] = False
    # a byte that UTF-8 never holds goes before each start, then one split cuts all
    place = np.cumsum(mark)
    out = np.full(len(view) + int(place[-1]), 0xFF, np.uint8)
    place += np.arange(len(view))
    out[place] = view
    return out.tobytes().split(b"\xff")


def certain_cuts(text: str) -> tuple[int, int]:
    """First and last position where a pretoken starts whatever surrounds the
    text: white space after anything else.  (-1, -1) if there is none."""
    if len(text) < 2:
        return -1, -1
    blank = char_classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")] >= SPACE
    at = np.flatnonzero(blank[1:] & ~blank[:-1])
    return (int(at[0]) + 1, int(at[-1]) + 1) if len(at) else (-1, -1)
