"""URL columns: parts, validity, prefixes, suffixes and resolution.

Resolution follows RFC 3986 against a *site root* (``scheme://host``), which is
the only base the publication sources use.  It is a pure Catalyst expression:
dot segments are removed with ``aggregate`` over the split path, so no Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.functions.text import col

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY_RE = r"^[^?#]*\?([^#]*)"
_FRAGMENT_RE = r"^[^#]*#(.*)"
VALID_URL_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"
_ROOT_RE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def scheme(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(c), SCHEME_RE, 1))


def netloc(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _NETLOC_RE, 1)


def host(c: Column | str) -> Column:
    """netloc without credentials and port, lower-cased."""
    return F.lower(F.regexp_extract(netloc(c), r"^(?:[^@]*@)?([^:]*)", 1))


def path(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _PATH_RE, 1)


def query(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _QUERY_RE, 1)


def fragment(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _FRAGMENT_RE, 1)


def site_root(c: Column | str) -> Column:
    return F.regexp_extract(col(c), _ROOT_RE, 1)


def is_valid_url(c: Column | str) -> Column:
    """Has a scheme and a host (``scheme://host...``); NULL input → false."""
    return F.coalesce(col(c).rlike(VALID_URL_RE), F.lit(False))


def has_http_prefix(c: Column | str) -> Column:
    c = col(c)
    return F.coalesce(c.startswith("http://") | c.startswith("https://"), F.lit(False))


def path_ends_with(c: Column | str, ext: str) -> Column:
    """Path (query, fragment and — for the schemes that use them —
    ``;params`` of the last segment ignored, as ``urlparse(url).path``) ends
    with ``ext``, case-insensitive."""
    from urllib.parse import uses_params  # schemes whose last segment carries ;params

    p = path(c)
    bare = F.when(scheme(c).isin(*uses_params), F.regexp_replace(p, r";[^/]*$", "")).otherwise(p)
    return F.coalesce(F.lower(bare).endswith(ext.lower()), F.lit(False))


def strip_query(c: Column | str) -> Column:
    return F.split_part(col(c), F.lit("?"), F.lit(1))


def _remove_dot_segments(p: Column, was_relative: Column) -> Column:
    """RFC 3986 §5.2.4 on an absolute path, as Python's urljoin does it
    (for a relative reference, empty inner segments are dropped too)."""
    segs = F.split(p, "/", -1)
    n = F.size(segs)
    inner = F.filter(segs, lambda s, i: (i == 0) | (i == n - 1) | (s != F.lit("")) | ~was_relative)

    def step(acc, s):
        return (
            F.when(s == F.lit(".."), F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
            .when(s == F.lit("."), acc)
            .otherwise(F.array_append(acc, s))
        )

    folded = F.aggregate(inner, F.array().cast("array<string>"), step)
    last = F.try_element_at(inner, F.lit(-1))
    folded = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    joined = F.array_join(folded, "/")
    return (
        F.when(joined == F.lit(""), F.lit("/"))
        .when(joined.startswith("/"), joined)
        .otherwise(F.concat(F.lit("/"), joined))
    )


def resolve_url(href: Column | str, root: Column | str) -> Column:
    """``urljoin(root, href)`` for a site root ``scheme://host``.

    * another scheme, or same scheme with a host: returned (re-assembled)
    * ``//host/...``: takes the root's scheme (``//`` with no host keeps the
      root's host and reads the rest as a path)
    * empty: the root itself
    * anything else: path resolved against ``/`` with dot segments removed
    """
    href, root = col(href), col(root)
    h_scheme = scheme(href)
    r_scheme = scheme(root)
    has_scheme = h_scheme != F.lit("")
    rest = F.when(has_scheme, F.substring(href, F.length(h_scheme) + 2, 1 << 30)).otherwise(href)
    q = F.regexp_extract(rest, _QUERY_RE, 1)
    frag = F.regexp_extract(rest, _FRAGMENT_RE, 1)
    tail = F.concat(
        F.when(q != F.lit(""), F.concat(F.lit("?"), q)).otherwise(F.lit("")),
        F.when(frag != F.lit(""), F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
    )
    rest_path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    rest_netloc = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    use_scheme = F.when(has_scheme, h_scheme).otherwise(r_scheme)
    relative_path = F.when(rest_path.startswith("/"), rest_path).otherwise(F.concat(F.lit("/"), rest_path))
    resolved_relative = F.concat(root, _remove_dot_segments(relative_path, ~rest_path.startswith("/")), tail)
    no_path_no_query = F.concat(
        root, F.when(frag != F.lit(""), F.concat(F.lit("#"), frag)).otherwise(F.lit(""))
    )
    # Fast paths first: CASE stops at the first true branch, so the common
    # shapes cost a few prefix/substring tests and never reach the regexes.
    plain_path = (
        href.startswith("/")
        & ~href.startswith("//")
        & ~href.contains("/.")
        & ~href.endswith("?")
        & ~href.endswith("#")
        & ~href.contains("?#")
    )
    plain_absolute = (
        (href.startswith("https://") & root.startswith("https://"))
        | (href.startswith("http://") & root.startswith("http://"))
    ) & ~href.endswith("?") & ~href.endswith("#") & ~href.contains("?#")
    other_web_scheme = (href.startswith("https://") & root.startswith("http://")) | (
        href.startswith("http://") & root.startswith("https://")
    )
    return (
        F.when(href.isNull() | root.isNull(), F.lit(None).cast("string"))
        .when(plain_path, F.concat(root, href))
        .when(plain_absolute, href)
        .when(other_web_scheme, href)
        .when(href == F.lit(""), root)
        .when(has_scheme & (h_scheme != r_scheme), href)
        .when(rest.startswith("//") & (rest_netloc != F.lit("")), F.concat(use_scheme, F.lit("://"), rest_netloc, rest_path, tail))
        .when((rest_path == F.lit("")) & (q == F.lit("")), no_path_no_query)
        .when(rest_path == F.lit(""), F.concat(root, tail))
        .otherwise(resolved_relative)
    )


def resolve_all(hrefs: Column | str, root: Column | str) -> Column:
    """Resolve every href of an array: strip in one ``transform``, resolve in
    a second, so the lambda's many uses of its argument read a plain value
    (lambdas are evaluated without common-subexpression sharing)."""
    from gazette.functions.text import strip_ws

    stripped = F.transform(col(hrefs), lambda h: strip_ws(h))
    return F.transform(stripped, lambda h: resolve_url(h, root))


def english_only(urls: Column | str, marker: str) -> Column:
    """Strip queries, keep URLs containing ``marker``, de-duplicate; sorted
    so the result does not depend on input order."""
    stripped = F.transform(col(urls), lambda u: F.split_part(u, F.lit("?"), F.lit(1)))
    kept = F.filter(stripped, lambda u: u.contains(marker))
    return F.array_sort(F.array_distinct(kept))
