"""SQL twins of the registered queries, written for DuckDB over the same
tables (views named after the tables).  Regexes use ASCII classes only so
Java regex and RE2 agree; times are TIMESTAMP (naive) like Spark's NTZ.
"""

from __future__ import annotations

# FIXED VALUES — Python str.strip() whitespace set (see constants.WS_CODEPOINTS)
_WS_CHARS_SQL = " || ".join(
    f"chr({c})"
    for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
              0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def _bare_path(url: str) -> str:
    """``urlparse(url).path``: the path without query/fragment and, for the
    schemes that use them, without the last segment's ``;params``."""
    from urllib.parse import uses_params

    schemes = ", ".join(f"'{x}'" for x in uses_params)
    p = f"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    sch = f"lower(regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    return f"CASE WHEN {sch} IN ({schemes}) THEN regexp_replace({p}, ';[^/]*$', '') ELSE {p} END"


def _strip(expr: str) -> str:
    return f"trim({expr}, {_WS_CHARS_SQL})"


def _unescape(expr: str) -> str:
    out = expr
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&apos;", "''"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        out = f"replace({out}, '{entity}', '{char}')"
    return out


def _root(url: str) -> str:
    return f"regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def _resolve(href: str, root: str) -> str:
    """Site-root resolution for the href shapes present in the tables
    (absolute, scheme-relative, absolute path, relative path)."""
    return (
        f"CASE WHEN {href} = '' THEN {root} "
        f"WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {href} "
        f"WHEN starts_with({href}, '//') THEN regexp_extract({root}, '^([^:]*):', 1) || ':' || {href} "
        f"WHEN starts_with({href}, '/') THEN {root} || {href} "
        f"ELSE {root} || '/' || {href} END"
    )


def _heading(html: str) -> str:
    raw = f"regexp_extract({html}, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
    return f"nullif({_strip(_unescape(f'regexp_replace({raw}, {chr(39)}<[^>]*>{chr(39)}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})'))}, '')"


_HREFS = "regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1)"
_VALID_URL = "regexp_matches({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')"


def _valid(x: str) -> str:
    return f"coalesce({_VALID_URL.format(x=x)}, false)"


_PAGE_FIELDS = f"""
  SELECT page_id, url, {_root('url')} AS root, {_heading('html')} AS title,
         list_transform({_HREFS}, lambda h: {_resolve(_strip('h'), _root('url'))}) AS related
  FROM pages
"""

ORACLES: dict[str, str] = {}

ORACLES["q_page_publications"] = f"""
SELECT page_id, title AS web_title, url AS web_url,
       lower(regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^(?:[^@]*@)?([^:]*)', 1)) AS host,
       regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '^/([A-Za-z]{{2}})/', 1) AS lang,
       '' AS category,
       CAST(len(related) AS BIGINT) AS n_related,
       related[1] AS first_related,
       coalesce(length(title) BETWEEN 3 AND 500, false) AS title_ok,
       {_valid('url')} AS url_ok,
       (len(related) <= 50 AND coalesce(list_bool_and(list_transform(related, lambda u: {_valid('u')})), true)) AS related_ok,
       (coalesce(length(title) BETWEEN 3 AND 500, false) AND {_valid('url')}
        AND len(related) <= 50 AND coalesce(list_bool_and(list_transform(related, lambda u: {_valid('u')})), true)) AS is_valid
FROM ({_PAGE_FIELDS}) p
"""

_HREF_ANCHOR = "'<a\\s[^>]*?href=\"([^\"]*)\"[^>]*>([^<]*)</a>'"

ORACLES["q_page_links"] = f"""
SELECT page_id, CAST(pos AS BIGINT) AS pos, href, link_text FROM (
  SELECT page_id, unnest(range(1, len(h) + 1)) AS pos, unnest(h) AS href,
         unnest(list_transform(t, lambda x: {_unescape('x')})) AS link_text
  FROM (SELECT page_id, regexp_extract_all(html, {_HREF_ANCHOR}, 1) AS h,
               regexp_extract_all(html, {_HREF_ANCHOR}, 2) AS t FROM pages))
"""

ORACLES["q_first_link"] = f"SELECT page_id, related[1] AS first_link FROM ({_PAGE_FIELDS})"

ORACLES["q_collect_links"] = f"""
SELECT page_id, array_to_string(links, '|') AS links, CAST(len(links) AS BIGINT) AS n_links
FROM (SELECT page_id, list_filter(related, lambda u: {_valid('u')}) AS links FROM ({_PAGE_FIELDS}))
WHERE len(links) > 0
"""

ORACLES["q_resolve_url"] = f"""
SELECT page_id, CAST(pos AS BIGINT) AS pos, href, {_resolve(_strip('href'), 'root')} AS resolved_url FROM (
  SELECT page_id, {_root('url')} AS root, unnest(range(1, len(h) + 1)) AS pos, unnest(h) AS href
  FROM (SELECT page_id, url, {_HREFS} AS h FROM pages))
"""

ORACLES["q_url_parts"] = """
SELECT page_id,
       lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
       regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS netloc,
       regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
       regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query,
       regexp_extract(url, '^[^#]*#(.*)', 1) AS fragment
FROM pages
"""

ORACLES["q_url_valid"] = f"""
SELECT page_id, {_valid('url')} AS url_ok,
       CAST(len(list_filter(h, lambda x: {_valid('x')})) AS BIGINT) AS n_valid_raw,
       CAST(len(list_filter(related, lambda x: {_valid('x')})) AS BIGINT) AS n_valid_resolved
FROM (SELECT p.*, {_HREFS} AS h FROM ({_PAGE_FIELDS.replace('FROM pages', ', html FROM pages')}) p)
"""

ORACLES["q_http_prefix"] = f"""
SELECT page_id,
       coalesce(starts_with(url, 'http://') OR starts_with(url, 'https://'), false) AS link_ok,
       CAST(len(list_filter(h, lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://'))) AS BIGINT) AS n_http_raw,
       CAST(len(list_filter(related, lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://'))) AS BIGINT) AS n_http_resolved
FROM (SELECT p.*, {_HREFS} AS h FROM ({_PAGE_FIELDS.replace('FROM pages', ', html FROM pages')}) p)
"""

ORACLES["q_path_suffix"] = f"""
SELECT page_id,
       coalesce(ends_with(lower({_bare_path('url')}), '.html'), false) AS path_ends_html,
       contains(url, '.html') AS contains_html,
       page_id % 4 <> 2 AS link_ends_html,
       page_id % 4 <> 1 AS link_contains_html
FROM pages
"""

_HOST = "lower(regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^(?:[^@]*@)?([^:]*)', 1))"

ORACLES["q_english_dedupe"] = f"""
SELECT DISTINCT {_HOST} AS host, split_part(url, '?', 1) AS clean_url
FROM pages WHERE contains(split_part(url, '?', 1), '/en/')
"""

ORACLES["q_related_capped"] = """
WITH p AS (SELECT l_suppkey, l_orderkey * 8 + l_linenumber AS k,
                  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 8 + l_linenumber) - 1 AS r FROM lineitem),
     n AS (SELECT l_suppkey, r // 60 AS page_no, k,
                  row_number() OVER (PARTITION BY l_suppkey, r // 60 ORDER BY k) AS pos FROM p WHERE k % 7 <> 0)
SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(page_no AS BIGINT) AS page_no, CAST(pos AS BIGINT) AS pos,
       CASE WHEN k % 3 = 0 THEN 'https://files.example.net/' ELSE 'https://www.example.com/files/' END || k || '.pdf' AS related_url
FROM n WHERE pos <= 50
"""

ORACLES["q_related_concat"] = """
WITH p AS (SELECT o_custkey, o_orderkey AS k,
                  (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 10 AS page_no FROM orders)
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(page_no AS BIGINT) AS page_no,
       CAST(row_number() OVER (PARTITION BY o_custkey, page_no ORDER BY k % 3, k) AS BIGINT) AS pos,
       'https://www.example.com' || CASE k % 3 WHEN 0 THEN '/f/' || k || '.pdf?v=1' ELSE '/r/' || k END AS url
FROM p WHERE k % 3 < 2
"""

ORACLES["q_related_valid"] = f"""
SELECT page_id, CAST(len(related) AS BIGINT) AS n_related,
       coalesce(list_bool_and(list_transform(related, lambda u: {_valid('u')})), true) AS all_valid,
       (len(related) <= 5 AND coalesce(list_bool_and(list_transform(related, lambda u: {_valid('u')})), true)) AS related_ok
FROM ({_PAGE_FIELDS})
"""

ORACLES["q_manifest_join"] = """
SELECT p.page_id, p.url, m.lazy FROM pages p JOIN (
  SELECT url, page_id % 2 = 0 AS lazy FROM pages WHERE page_id % 3 = 0
  UNION SELECT url || '/gone', true FROM pages WHERE page_id % 5 = 0) m ON p.url = m.url
"""

# --------------------------------------------------------------------------
# documents / labels
# --------------------------------------------------------------------------
_FIRST_LINE = "split_part(text, chr(10), 1)"
_TITLE_OK = "coalesce(length(title) BETWEEN 3 AND 500, false)"
_DOC_TITLES = f"""
  SELECT doc_id, lang, source, nullif({_strip(_FIRST_LINE)}, '') AS title,
         CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines
  FROM documents
"""

ORACLES["q_title_bounds"] = f"""
SELECT doc_id, CAST(coalesce(length(title), 0) AS BIGINT) AS title_len, {_TITLE_OK} AS title_ok
FROM ({_DOC_TITLES})
"""

ORACLES["q_clean_text"] = f"""
SELECT doc_id, title,
       nullif(split_part(title, ' ', 1), '') AS first_word,
       nullif(split_part(title, ' ', 2), '') AS second_word,
       lower(title) AS title_lower,
       replace(title, '\\"', '"') AS title_unquoted,
       text_len
FROM (SELECT doc_id, {_strip(_FIRST_LINE)} AS title, CAST(length({_strip('text')}) AS BIGINT) AS text_len FROM documents)
"""

_DOC_CANDIDATES = f"""
  SELECT d.*, l.quality, l.toxic,
         list_filter([CASE WHEN title IS NULL THEN 'empty_title' END,
                      CASE WHEN title IS NOT NULL AND NOT {_TITLE_OK} THEN 'title_length' END,
                      CASE WHEN l.quality IS NULL THEN 'missing:quality' END], lambda x: x IS NOT NULL) AS reasons
  FROM ({_DOC_TITLES}) d LEFT JOIN labels l USING (doc_id)
"""

ORACLES["q_reject_summary"] = f"""
SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({_DOC_CANDIDATES}))
GROUP BY reason
"""

ORACLES["q_source_health"] = f"""
WITH c AS ({_DOC_CANDIDATES}),
     e AS (SELECT source FROM c UNION SELECT {_HOST} AS source FROM pages)
SELECT e.source, count(c.doc_id) AS n_rows, count(c.doc_id) FILTER (WHERE len(reasons) = 0) AS n_valid,
       CASE WHEN count(c.doc_id) = 0 THEN 'empty'
            WHEN count(c.doc_id) FILTER (WHERE len(reasons) = 0) = 0 THEN 'no_valid' ELSE 'ok' END AS status
FROM e LEFT JOIN c ON e.source = c.source GROUP BY e.source
"""

ORACLES["q_nfkc"] = """
SELECT p_partkey, p_name AS name_nfkc, p_type || ' 1 fi' AS type_nfkc, p_name AS name_plain FROM part
"""

ORACLES["q_lookup_enrich"] = """
SELECT d.doc_id, d.lang, l.quality, l.toxic, l.doc_id IS NOT NULL AS enriched
FROM documents d LEFT JOIN labels l
  ON d.lang = 'en' AND d.doc_id % 6 NOT IN (0, 2) AND d.doc_id = l.doc_id
"""

ORACLES["q_run_report"] = f"""
SELECT source, lang, count(*) AS n_rows,
       count(*) FILTER (WHERE NOT {_TITLE_OK}) AS n_errors,
       CAST(sum(n_lines) AS BIGINT) AS n_related
FROM ({_DOC_TITLES}) GROUP BY source, lang
"""

ORACLES["q_flatten_children"] = """
SELECT doc_id, CAST(len(children) AS BIGINT) AS n_children, CAST(len(flat) AS BIGINT) AS n_flat,
       flat[1] AS first_flat, flat[-1] AS last_flat
FROM (SELECT doc_id, children,
             flatten(list_transform(children, lambda l: list_filter(string_split(l, ' '), lambda w: w <> ''))) AS flat
      FROM (SELECT doc_id, string_split(text, chr(10)) AS children FROM documents))
"""

ORACLES["q_union_namespaces"] = """
SELECT namespace, count(*) AS n_rows FROM (
  SELECT 'events-' || event_type AS namespace FROM events
  UNION ALL
  SELECT 'documents-' || lang AS namespace FROM documents)
GROUP BY namespace
"""

# --------------------------------------------------------------------------
# conversations
# --------------------------------------------------------------------------
ORACLES["q_short_pages"] = """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) < 10
"""

ORACLES["q_page_atomic"] = f"""
SELECT conv_id, turn FROM conversations WHERE conv_id IN (
  SELECT conv_id FROM conversations GROUP BY conv_id
  HAVING bool_and(coalesce(length({_strip('text')}), 0) > 0 AND role IN ('user', 'assistant')))
"""

ORACLES["q_zip_pairs"] = """
WITH u AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i
           FROM conversations WHERE role = 'user'),
     a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i
           FROM conversations WHERE role = 'assistant')
SELECT u.conv_id, u.i AS pair_idx, u.turn AS user_turn, a.turn AS assistant_turn
FROM u JOIN a ON u.conv_id = a.conv_id AND u.i = a.i
"""

# --------------------------------------------------------------------------
# events
# --------------------------------------------------------------------------
_EPOCH_S = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts)"

ORACLES["q_type_topn"] = """
SELECT event_type, rn, event_id, ts FROM (
  SELECT event_type, event_id, ts,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn <= 10
"""

ORACLES["q_latest_per_link"] = """
SELECT user_id, rn, event_id FROM (
  SELECT user_id, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id ASC) AS rn
  FROM events) WHERE rn <= 10
"""

ORACLES["q_json_props"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
"""

ORACLES["q_epoch"] = f"""
SELECT event_id, {_EPOCH_S} AS epoch_s,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds({_EPOCH_S}) AS ts_back
FROM events
"""

ORACLES["q_time_bucket"] = f"""
SELECT user_id, CAST(floor({_EPOCH_S} / 300) AS BIGINT) AS bucket,
       first(event_id ORDER BY ts, event_id) AS first_event
FROM events GROUP BY user_id, CAST(floor({_EPOCH_S} / 300) AS BIGINT)
"""

ORACLES["q_fetch_resolution"] = """
WITH a AS (
  SELECT user_id, event_id, coalesce(event_type <> 'error', false) AS ok,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt
  FROM events QUALIFY attempt <= 6)
SELECT user_id,
       CAST(min(attempt) FILTER (WHERE ok) AS BIGINT) AS attempt_used,
       arg_min(event_id, attempt) FILTER (WHERE ok) AS first_ok_event,
       count(*) AS attempts_seen,
       CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN 'ok' ELSE 'failed' END AS status
FROM a GROUP BY user_id
"""

ORACLES["q_date_bounds"] = """
SELECT event_id,
       NOT (ts > TIMESTAMP '2024-01-20 00:00:00' OR ts < TIMESTAMP '1975-01-01 00:00:00') AS date_ok,
       concat_ws(',', CASE WHEN ts > TIMESTAMP '2024-01-20 00:00:00' THEN 'date_in_future' END,
                      CASE WHEN ts < TIMESTAMP '1975-01-01 00:00:00' THEN 'date_too_old' END) AS reasons
FROM events
"""

ORACLES["q_display"] = """
SELECT event_id,
       upper(substr(event_type, 1, 3)) || ' ' || event_type || ' from ' || strftime(ts, '%Y-%m-%d')
       || ': Event ' || CAST(event_id AS VARCHAR) || ' (https://events.example.com/e/' || CAST(event_id AS VARCHAR) || ')' AS display
FROM events
"""

# --------------------------------------------------------------------------
# orders
# --------------------------------------------------------------------------
ORACLES["q_first_version"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS version,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS hash
FROM orders
"""

ORACLES["q_parse_dates"] = """
SELECT o_orderkey,
       date_trunc('second', o_orderdate) AS rss_parsed,
       date_trunc('day', o_orderdate) AS dotted_parsed,
       date_trunc('day', o_orderdate) AS iso_parsed,
       date_trunc('day', o_orderdate) AS long_parsed,
       date_trunc('day', o_orderdate) AS card_url_parsed,
       date_trunc('day', o_orderdate) AS card_text_parsed
FROM orders
"""

ORACLES["q_year_manifest"] = """
WITH y AS (SELECT year(o_orderdate) AS year FROM orders),
     span AS (SELECT unnest(generate_series(min(year), max(year))) AS year FROM y),
     c AS (SELECT year, count(*) AS n FROM y GROUP BY year)
SELECT CAST(span.year AS BIGINT) AS year,
       'https://www.example.com/press/accounts/' || span.year || '/html/index_include.en.html' AS url,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_orders
FROM span LEFT JOIN c USING (year)
"""

ORACLES["q_dimension_join"] = """
SELECT s.s_suppkey, n.n_name, r.r_name, n.n_name IS NOT NULL AS matched
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLES["q_dictionary_decode"] = """
SELECT c.c_custkey, c.c_nationkey, n.n_name AS decoded
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

# --------------------------------------------------------------------------
# chunk database (events written as chunks of 100, groups of 10)
# --------------------------------------------------------------------------
_K = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"

ORACLES["q_chunk_decode"] = f"""
SELECT event_id AS record_id, event_id, user_id, event_type, {_K} AS k FROM events
"""

_INDEX_STATS = """
  SELECT event_type, CAST(floor((rn - 1) / 100) AS BIGINT) AS index_chunk,
         min(event_id) AS first_sort_id, max(event_id) AS last_sort_id, count(*) AS n_records
  FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
  GROUP BY 1, 2
"""

ORACLES["q_index_stats"] = _INDEX_STATS

ORACLES["q_index_prune"] = """
SELECT event_id AS record_id, event_id, user_id,
       (SELECT count(DISTINCT event_id // 100) FROM events WHERE event_id // 250 = 3) AS n_chunks
FROM events WHERE event_id // 250 = 3
"""

ORACLES["q_chunk_locator"] = f"""
SELECT 'data' AS kind, CAST(NULL AS VARCHAR) AS key, chunk_id AS item,
       'https://db.example.com/dbs/publications.en/1/0f0f/data/' || (chunk_id // 10) || '/chunk_' || chunk_id || '.json' AS url
FROM (SELECT DISTINCT CAST(event_id // 100 AS BIGINT) AS chunk_id FROM events)
UNION ALL
SELECT 'index_chunk' AS kind, s.event_type AS key, s.index_chunk AS item,
       'https://db.example.com/dbs/publications.en/1/0f0f/indexes/event_type/' || v.value_id || '/chunk_' || s.index_chunk || '.json' AS url
FROM ({_INDEX_STATS}) s
JOIN (SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS value_id
      FROM (SELECT DISTINCT event_type FROM events)) v ON s.event_type = v.event_type
"""

ORACLES["q_chunk_count"] = """
SELECT event_type, count(*) AS total_records,
       CAST(ceil(count(*) / 100) AS BIGINT) AS n_chunks,
       CAST(round_even(count(*) / 100, 0) AS BIGINT) AS n_chunks_rounded,
       least(5000, count(*)) AS fetch_bound
FROM events GROUP BY event_type
"""

ORACLES["q_record_to_publication"] = f"""
SELECT event_id,
       'Event ' || event_id || ' ' || event_type AS web_title,
       date_trunc('second', ts) AS published_at,
       'https://www.ecb.europa.eu/e/' || event_id || '.html' AS web_url,
       CASE WHEN event_type <> 'error' THEN event_type ELSE '' END AS category,
       CAST(coalesce(k % 3, 0) AS BIGINT) AS n_related,
       CASE WHEN coalesce(k % 3, 0) >= 1 THEN 'https://www.ecb.europa.eu/pdf/' || event_id || '-1.pdf' END AS first_related
FROM (SELECT *, {_K} AS k FROM events)
"""

ORACLES["q_type_latest_db"] = """
SELECT * FROM (SELECT 'regulation' AS update_type, event_id FROM events
               WHERE event_type = 'purchase' ORDER BY event_id LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'news' AS update_type, event_id FROM events
               WHERE event_type IS DISTINCT FROM 'purchase' ORDER BY event_id LIMIT 10)
"""

ORACLES["q_child_decode"] = """
SELECT p_partkey, 'P' || p_partkey AS pub_id, '2024' AS year,
       lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') AS month, '15' AS day,
       CAST(CASE WHEN p_size % 4 = 3 THEN 2 ELSE 0 END AS BIGINT) AS n_pdfs,
       CASE WHEN p_size % 4 = 3 THEN '/pdf/' || p_partkey || '-a.pdf' END AS first_pdf,
       CASE WHEN p_size % 4 IN (1, 3) THEN p_brand END AS meta_brand
FROM part WHERE p_size % 4 <> 0
"""

# --------------------------------------------------------------------------
# formats
# --------------------------------------------------------------------------
def _title(html: str) -> str:
    raw = f"regexp_extract({html}, '(?s)<title[^>]*>(.*?)</title>', 1)"
    return f"nullif({_strip(_unescape(f'regexp_replace({raw}, {chr(39)}<[^>]*>{chr(39)}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})'))}, '')"


ORACLES["q_rss_decode"] = f"""
SELECT page_id, web_title, web_url, published_at, n_enclosures,
       (coalesce(length(web_title) BETWEEN 3 AND 500, false) AND {_valid('web_url')}
        AND n_enclosures <= 50
        AND published_at <= TIMESTAMP '2024-01-20 00:00:00'
        AND published_at >= TIMESTAMP '1975-01-01 00:00:00') AS is_valid
FROM (SELECT page_id, {_title('html')} AS web_title, url AS web_url,
             TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id) AS published_at,
             CAST(len({_HREFS}) AS BIGINT) AS n_enclosures
      FROM pages)
"""

ORACLES["q_dl_listing"] = """
SELECT o_custkey, CAST((rn - 1) // 10 AS BIGINT) AS page_no, CAST((rn - 1) % 10 + 1 AS BIGINT) AS item_pos,
       o_orderkey, 'Order ' || o_orderkey || ' ' || o_orderpriority AS web_title,
       date_trunc('day', o_orderdate) AS published_at,
       'https://www.example.com/orders/' || o_orderkey || '.en.html' AS web_url,
       CAST(1 AS BIGINT) AS n_related,
       'https://www.example.com/pdf/' || o_orderkey || '.en.pdf' AS first_related
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
"""

ORACLES["q_csv_roundtrip"] = """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
"""

ORACLES["q_card_listing"] = """
SELECT o_custkey, CAST((rn - 1) // 10 AS BIGINT) AS page_no, CAST((rn - 1) % 10 + 1 AS BIGINT) AS item_pos,
       o_orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'Order ' || o_orderkey END AS web_title,
       CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 THEN NULL ELSE date_trunc('day', o_orderdate) END AS published_at,
       CASE WHEN o_orderkey % 2 = 0
            THEN 'https://www.example.com/en/press/' || strftime(o_orderdate, '%Y-%m-%d') || '-order-' || o_orderkey || '.html'
            ELSE 'https://www.example.com/en/press/order-' || o_orderkey || '.html' END AS web_url,
       concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'missing:title' END,
                      CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 THEN 'invalid_date' END) AS reasons
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
"""

ORACLES["q_search_listing"] = """
SELECT user_id, CAST((rn - 1) // 10 AS BIGINT) AS page_no, CAST((rn - 1) % 10 + 1 AS BIGINT) AS item_pos,
       event_id, 'Event ' || event_id AS web_title,
       date_trunc('day', ts) AS published_at,
       CASE WHEN event_type <> 'error' THEN event_type END AS category,
       CASE WHEN event_type = 'error' THEN 'missing:category' ELSE '' END AS reasons
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
"""

def _branches() -> str:
    """What the standard library makes of each href, with the root left open."""
    from urllib.parse import urljoin

    from gazette.plans.catalog import HREF_BRANCHES

    cases = []
    for i, href in enumerate(HREF_BRANCHES):
        value = []
        for scheme in ("https", "http"):
            out, root = urljoin(f"{scheme}://h.example", href), f"{scheme}://h.example"
            value.append(f"root || '{out.removeprefix(root)}'" if out.startswith(root) else f"'{out}'")
        value = f"CASE WHEN starts_with(root, 'https:') THEN {value[0]} ELSE {value[1]} END"
        cases.append(f"WHEN {i} THEN {value}")
    return f"CASE page_id % {len(HREF_BRANCHES)} {' '.join(cases)} END"


def _hrefs() -> str:
    from gazette.plans.catalog import HREF_BRANCHES

    return ", ".join(f"'{h}'" for h in HREF_BRANCHES)


ORACLES["q_resolve_branches"] = f"""
SELECT page_id, [{_hrefs()}][page_id % len([{_hrefs()}]) + 1] AS href, {_branches()} AS resolved_url
FROM (SELECT page_id, {_root('url')} AS root FROM pages)
"""

ORACLES["q_regulator_lookup"] = """
SELECT doc_id, ['ECB', 'ecb', 'MAS', 'Mas', 'BOE', '', NULL][doc_id % 7 + 1] AS regulator,
       array_to_string(list_filter([CASE WHEN doc_id % 2 = 0 THEN 'title_length' END,
                                    CASE WHEN doc_id % 7 IN (4, 5) THEN 'unknown_regulator' END],
                                   lambda x: x IS NOT NULL), ',') AS reasons
FROM documents
"""

ORACLES["q_fetch_listing"] = """
WITH a AS (SELECT user_id, event_id, event_type NOT IN ('error', 'view') AS ok,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM events),
     b AS (SELECT * FROM a WHERE attempt <= 3)
SELECT user_id, CAST(min(attempt) FILTER (WHERE ok) AS BIGINT) AS attempt_used,
       first(event_id ORDER BY attempt) FILTER (WHERE ok) AS first_ok_event,
       count(*) AS attempts_seen,
       CASE WHEN bool_or(ok) THEN 'ok' ELSE 'failed' END AS status
FROM b GROUP BY user_id
"""

ORACLES["q_index_document"] = """
SELECT event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS BIGINT) AS index_value_id,
       count(*) AS total_records, CAST(ceil(count(*) / 100) AS BIGINT) AS number_of_chunks,
       min(event_id) AS first_sort_id, max(event_id) AS last_sort_id
FROM events GROUP BY event_type
"""

_ORDER_PAGES = """
  SELECT o_custkey, o_orderkey AS k, o_orderdate, o_orderpriority,
         (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 10 AS page_no,
         (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 10 AS r
  FROM orders
"""

ORACLES["q_dl_descendants"] = f"""
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(page_no AS BIGINT) AS page_no, CAST(2 * r + 1 AS BIGINT) AS item_pos,
       'Order ' || k || ' ' || o_orderpriority AS web_title, CAST(o_orderdate AS TIMESTAMP) AS published_at,
       'https://www.example.com/orders/' || k || '.en.html' AS web_url, '' AS reasons
FROM ({_ORDER_PAGES})
UNION ALL
SELECT CAST(o_custkey AS BIGINT), CAST(page_no AS BIGINT), CAST(2 * r + 2 AS BIGINT), 'pdf', NULL,
       'https://www.example.com/pdf/' || k || '.en.pdf?v=1', 'invalid_date'
FROM ({_ORDER_PAGES})
"""

ORACLES["q_dl_body"] = f"""
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(page_no AS BIGINT) AS page_no, CAST(r + 1 AS BIGINT) AS item_pos,
       'Order ' || k AS web_title, CAST(o_orderdate AS TIMESTAMP) AS published_at,
       'https://www.example.com/orders/' || k || '.en.html' AS web_url, '' AS reasons
FROM ({_ORDER_PAGES})
"""

ORACLES["q_nested_decode"] = """
SELECT p_partkey, CAST(1 AS BIGINT) AS n_related, 'R' || p_partkey AS first_related,
       CAST(least(p_size % 4, 2) AS BIGINT) AS n_children,
       CASE WHEN p_size % 4 > 0 THEN 'C' || p_partkey END AS first_child
FROM part
"""

ORACLES["q_publish_runs"] = f"""
SELECT CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS namespace, doc_id, title,
       CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'rejected' END AS status, CAST(len(reasons) AS BIGINT) AS n_reasons
FROM ({_DOC_CANDIDATES}) WHERE lang IS DISTINCT FROM 'en' OR doc_id % 2 = 0
"""

ORACLES["q_chunk_source"] = """
SELECT event_id AS record_id, CAST(event_id // 100 AS BIGINT) AS chunk_id, event_id, event_type FROM events
WHERE event_type IN ('purchase', 'error') AND event_id <= (SELECT max(event_id) // 2 FROM events)
"""

ORACLES["q_poll_pages"] = """
SELECT 'https://www.example.com/users/' || user_id AS listing_url,
       arg_max('Event ' || event_id || ' ' || event_type, ts) AS web_title, CAST(0 AS BIGINT) AS n_reasons
FROM events GROUP BY user_id
"""

ORACLES["q_poll_items"] = ORACLES["q_latest_per_link"]

ORACLES["q_landed_files"] = """
SELECT doc_id, doc_id % 2 = 0 AS found,
       CASE WHEN doc_id % 2 = 0 THEN strlen(body) + 4 END AS n_bytes,
       CASE WHEN doc_id % 2 = 0 THEN CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'text' END END AS kind,
       CASE WHEN doc_id % 2 = 0 THEN length(body) + 4 END AS n_chars,
       CASE WHEN doc_id % 2 = 0 THEN ' ' || chr(65533) || chr(65533) || ' ' END AS ending
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '%PDF-1.4 ' ELSE 'page ' END || coalesce(text, '') AS body
      FROM documents WHERE doc_id % 4 < 2)
"""

ORACLES["q_variant_props"] = """
SELECT event_id,
       CASE WHEN event_id % 5 IN (0, 1, 3) THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 5 = 1 THEN event_type END AS tag,
       CASE WHEN event_id % 5 = 1 THEN CAST(7 AS BIGINT) END AS n,
       CASE event_id % 5 WHEN 0 THEN 'object' WHEN 1 THEN 'object' WHEN 3 THEN 'array' WHEN 4 THEN 'string' END AS json_kind
FROM events
"""

ORACLES["q_feed_rejects"] = f"""
SELECT CASE WHEN bad THEN NULL ELSE url END AS web_url, CASE WHEN bad THEN NULL ELSE title END AS web_title,
       CASE WHEN bad THEN 'malformed_item'
            ELSE concat_ws(',', CASE WHEN title IS NULL THEN 'missing:title' END,
                                CASE WHEN title IS NOT NULL AND NOT length(title) BETWEEN 3 AND 500 THEN 'title_length' END) END AS reasons,
       CASE WHEN bad THEN page_id END AS malformed_page
FROM (SELECT page_id, url, {_title('html')} AS title, page_id % 7 = 3 AS bad FROM pages)
"""

ORACLES["q_bucketed_captures"] = """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, t.web_title
FROM customer LEFT JOIN (
  SELECT user_id, arg_max('Event ' || event_id || ' ' || event_type, ts) AS web_title FROM events GROUP BY user_id) t
  ON t.user_id = c_custkey
WHERE c_nationkey < 12
"""

ORACLES["q_field_types"] = """
SELECT event_id, CASE WHEN event_id % 7 > 1 THEN user_id END AS user_id,
       CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS ts, event_id % 3 = 0 AS no_value,
       concat_ws(',', CASE WHEN event_id % 7 = 1 THEN 'missing:user_id' END, CASE WHEN event_id % 7 = 0 THEN 'type:user_id' END,
                 CASE WHEN event_id % 5 = 0 THEN 'type:ts' END, CASE WHEN event_id % 3 = 0 THEN 'type:value' END) AS reasons
FROM events
"""

ORACLES["q_index_source"] = ORACLES["q_index_prune"]
