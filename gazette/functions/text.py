"""Text columns: strip, split-and-pick, entity decode, UTF-8 repair, NFKC.

All JVM-side except ``nfkc`` — Spark has no Unicode normaliser, so that one is
an Arrow-batched pandas UDF which leaves ASCII values untouched.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gazette.constants import BASIC_ENTITIES, WS_CHARS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: drop Unicode whitespace at both ends.
    (Plain ``trim`` only removes U+0020; ``btrim`` with the character set
    touches only the ends, so it costs nothing on long texts.)"""
    return F.btrim(col(c), F.lit(WS_CHARS))


def nullif_empty(c: Column | str) -> Column:
    """Empty string → NULL.  The built-in ``nullif`` evaluates its argument
    once; a ``CASE`` would evaluate an expensive argument twice."""
    return F.nullif(col(c), F.lit(""))


def first_line(c: Column | str) -> Column:
    return F.substring_index(col(c), "\n", 1)


def split_pick(c: Column | str, sep: str, index: int) -> Column:
    """``s.split(sep)[index]`` with 1-based ``index``; NULL when absent
    (never an error under ANSI mode)."""
    return nullif_empty(F.split_part(col(c), F.lit(sep), F.lit(index)))


def unescape_basic(c: Column | str) -> Column:
    """Decode the common character references; ``&amp;`` last so that
    ``&amp;lt;`` becomes ``&lt;`` as with a full decoder."""
    out = col(c)
    for entity, char in BASIC_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def unescape_json_quotes(c: Column | str) -> Column:
    """The chunk database writes inner quotes as ``\\"``."""
    return F.replace(col(c), F.lit('\\"'), F.lit('"'))


def valid_utf8(c: Column | str) -> Column:
    """Bytes → text with every invalid sequence replaced by U+FFFD."""
    return F.make_valid_utf8(col(c).cast("string"))


def _nfkc_series(s: pd.Series) -> pd.Series:
    return s.map(lambda v: v if v is None else unicodedata.normalize("NFKC", v))


_nfkc_udf = F.pandas_udf(_nfkc_series, StringType())


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC normalisation.  Only values with a character beyond ASCII
    reach Python (Arrow batches); the others stay as they are."""
    c = col(c)
    beyond = c.rlike("[^\\x00-\\x7F]")
    return F.when(beyond, _nfkc_udf(F.when(beyond, c))).otherwise(c)


def int_div(a: Column | str, b: Column | int) -> Column:
    """Integer division, exact beyond 2^53 (``a`` not negative)."""
    return F.call_function("div", col(a).cast("bigint"), b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def display_line(regulator, update_type, day, title, url) -> Column:
    """``{REG} {type} from {yyyy-MM-dd}: {title} ({url})``; ``day`` is the
    formatted date column."""
    return F.format_string("%s %s from %s: %s (%s)", col(regulator), col(update_type), col(day), col(title), col(url))
