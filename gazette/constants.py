"""Fixed values that must equal the behaviour being matched.

Everything in this module is a constant of the publications model: limits,
formats, namespaces and the regulator dimension.  They are stated plainly
and together so they can be audited in one place.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES — validation limits of a publication record
# ---------------------------------------------------------------------------
MIN_TITLE_LENGTH = 3
MAX_TITLE_LENGTH = 500
MAX_RELATED_URLS = 50
FUTURE_TOLERANCE_DAYS = 5
EARLIEST_PUBLICATION = _dt.datetime(1975, 1, 1)

# ---------------------------------------------------------------------------
# FIXED VALUES — fetch-log outcome rules (attempts per URL)
# ---------------------------------------------------------------------------
FEED_MAX_ATTEMPTS = 6  # first try + 5 retries, success = status 200
LISTING_MAX_ATTEMPTS = 3  # success = OK status and a non-empty body
SNAPSHOT_MAX_AGE_SECONDS = 300  # database snapshot reuse window

# ---------------------------------------------------------------------------
# FIXED VALUES — listing sizes
# ---------------------------------------------------------------------------
PER_LINK_LATEST = 10  # publications kept per listing link
SHORT_PAGE_ROWS = 10  # a listing with fewer rows is reported as short
DB_FETCH_REQUESTED = 5000  # records requested from the chunk database

# ---------------------------------------------------------------------------
# FIXED VALUES — date formats (Spark datetime patterns for the source formats)
#   RSS         "Wed, 29 Jan 2025 12:00:00 GMT"   weekday dropped before parsing
#   card text   "29.01.2025: ..."                 day.month.year
#   card URL    ".../2025-01-29-..."              year-month-day
#   listings    "9 January 2024"                  day full-month year
# ---------------------------------------------------------------------------
RSS_PATTERN = "d MMM yyyy HH:mm:ss"
RSS_ZONES = ("GMT", "UTC")
DOTTED_PATTERN = "d.M.yyyy"
ISO_DAY_PATTERN = "yyyy-MM-dd"
LONG_DAY_PATTERN = "d MMMM yyyy"
DISPLAY_DAY_PATTERN = "yyyy-MM-dd"
URL_DATE_REGEX = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})-"

# ---------------------------------------------------------------------------
# FIXED VALUES — database type codes
# ---------------------------------------------------------------------------
DB_TYPE_CODE_REGULATION = 18  # letters to parliament members
DB_TYPE_CODE_NEWS = 1  # press releases
ENGLISH_MARKER = ".en."

# ---------------------------------------------------------------------------
# FIXED VALUES — regulator dimension (code, full_name, language, base_url)
# ---------------------------------------------------------------------------
REGULATORS = (
    ("MAS", "Monetary Authority of Singapore", "English", "https://www.mas.gov.sg"),
    ("ECB", "European Central Bank", "English", "https://www.ecb.europa.eu"),
)

# ---------------------------------------------------------------------------
# FIXED VALUES — Python's str.strip() whitespace set (code points).
#   tab, LF, VT, FF, CR, the four information separators (1C-1F), space,
#   NEL (85), no-break space (A0), ogham space (1680), en quad .. hair space
#   (2000-200A), line/paragraph separators (2028, 2029), narrow no-break space
#   (202F), medium math space (205F), ideographic space (3000).
# ---------------------------------------------------------------------------
WS_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WS_CHARS = "".join(chr(c) for c in WS_CODEPOINTS)

# ---------------------------------------------------------------------------
# FIXED VALUES — HTML character references decoded by the JVM fast path.
# (The parser path in sources/extract.py decodes every reference.)
# ---------------------------------------------------------------------------
BASIC_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&amp;", "&"),
)
