"""Date columns.  Every parser returns TIMESTAMP_NTZ (naive wall-clock time,
as the sources publish it) and never depends on the session time zone:
day-level formats go through ``try_to_date``; times are assembled with
``try_make_timestamp_ntz``.  Bad input gives NULL, never an error.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import constants as K
from gazette.functions.text import col, int_div, nullif_empty, strip_ws



def ntz_lit(value: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (a Python datetime literal would pass through
    the driver's local zone)."""
    return F.expr(f"TIMESTAMP_NTZ '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'")


def _epoch() -> Column:
    return ntz_lit(_dt.datetime(1970, 1, 1))

# strptime-compatible shapes of the RSS date, weekday and zone included; the
# leading "#" is a marker the caller prepends (see parse_rss)
_RSS_RE = (
    r"^#(?i)(?:mon|tue|wed|thu|fri|sat|sun),\s+"
    r"(3[01]|[12][0-9]|0[1-9]|[1-9])\s+([a-z]{3})\s+([0-9]{4})\s+"
    r"(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])\s+(?:gmt|utc)$"
)


def ntz(c: Column | str) -> Column:
    return col(c).cast("timestamp_ntz")


def parse_day(c: Column | str, pattern: str) -> Column:
    """A day-level format → midnight TIMESTAMP_NTZ, NULL when invalid."""
    return F.try_to_date(col(c), pattern).cast("timestamp_ntz")


# FIXED VALUES — English month abbreviations, in calendar order
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def parse_rss(c: Column | str) -> Column:
    """``Wed, 29 Jan 2025 12:00:00 GMT`` → TIMESTAMP_NTZ (zone must be GMT/UTC).

    One full-match regex rewrites the value to ``yyyy-mon-d H:m:s``; month
    names become numbers with plain ``replace``; ``try_cast`` to
    TIMESTAMP_NTZ validates the calendar (31 Feb → NULL) without any session
    zone.  The value is prefixed with a ``#`` marker that only a full match
    consumes, so a non-matching value keeps it and the cast gives NULL — no
    ``CASE`` (a branch would re-run the regex), one regex per row."""
    c = col(c)
    canon = F.lower(F.regexp_replace(F.concat(F.lit("#"), c), _RSS_RE, "$3-$2-$1 $4:$5:$6"))
    for i, m in enumerate(_MONTHS, start=1):
        canon = F.replace(canon, F.lit(f"-{m}-"), F.lit(f"-{i}-"))
    return canon.try_cast("timestamp_ntz")


def parse_dotted(c: Column | str) -> Column:
    return parse_day(c, K.DOTTED_PATTERN)


def parse_iso_day(c: Column | str) -> Column:
    return parse_day(c, K.ISO_DAY_PATTERN)


def parse_long_day(c: Column | str) -> Column:
    return parse_day(c, K.LONG_DAY_PATTERN)


def url_date_text(url: Column | str) -> Column:
    """The ``/yyyy-mm-dd-`` token of a URL, NULL when there is none."""
    return nullif_empty(F.regexp_extract(col(url), K.URL_DATE_REGEX, 1))


def card_date(url: Column | str, description: Column | str) -> Column:
    """Date of an article card: the URL date when the URL carries one (an
    invalid URL date is *not* replaced by the text date), otherwise the text
    before the first ``:`` of the description as ``d.m.yyyy``."""
    url_text = url_date_text(url)
    desc_text = strip_ws(F.split_part(col(description), F.lit(":"), F.lit(1)))
    return F.when(url_text.isNotNull(), parse_iso_day(url_text)).otherwise(parse_dotted(desc_text))


def listing_date(text: Column | str, prefix: str | None = None) -> Column:
    """``9 January 2024`` (optionally after ``prefix``, e.g. ``Date: ``)."""
    c = strip_ws(col(text))
    if prefix is not None:
        c = F.split_part(c, F.lit(prefix), F.lit(2))
    return parse_long_day(c)


def from_epoch_seconds(c: Column | str) -> Column:
    """Epoch seconds → TIMESTAMP_NTZ (UTC wall clock), zone independent."""
    return F.timestamp_add("SECOND", col(c).cast("bigint"), _epoch())


def to_epoch_seconds(c: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), ntz(c))


def time_bucket(c: Column | str, seconds: int) -> Column:
    """``int(epoch / seconds)`` — the snapshot bucket of a time."""
    epoch = to_epoch_seconds(c)
    return int_div(epoch - F.pmod(epoch, F.lit(seconds)), seconds)


def display_day(c: Column | str) -> Column:
    return F.date_format(col(c), K.DISPLAY_DAY_PATTERN)


def rss_format(c: Column | str) -> Column:
    """Format a time as an RSS (RFC 822) date in GMT."""
    return F.concat(F.date_format(col(c), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def date_bounds_reasons(c: Column | str, as_of: _dt.datetime) -> Column:
    """Reason strings for a publication time outside [1975-01-01, as_of + 5 d]."""
    c = ntz(c)
    latest = ntz_lit(as_of + _dt.timedelta(days=K.FUTURE_TOLERANCE_DAYS))
    earliest = ntz_lit(K.EARLIEST_PUBLICATION)
    return F.array_compact(
        F.array(
            F.when(c > latest, F.lit("date_in_future")),
            F.when(c < earliest, F.lit("date_too_old")),
        )
    )
