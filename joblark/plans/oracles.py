"""SQL that gives the same rows as each registered query.

The SQL derives the expected rows from the table columns alone; where a query
renders pages first, none of that markup appears here.
"""

from __future__ import annotations

from joblark.functions.dates import UNIT_SECONDS
from joblark.functions.text import WHITESPACE
from joblark.sources.sites import CHALLENGE_MARKERS, DISCONNECT_MARKERS

_WS = "'" + WHITESPACE + "'"
_BASE = 1704067200


def _strip(expr: str) -> str:
    return f"trim({expr}, {_WS})"


def _any(expr: str, needles: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({expr}), '{n}')" for n in needles) + ")"


_TITLE = _strip("string_split(text, chr(10))[1]")
_LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"


def _iso(number: str) -> str:
    return f"strftime(epoch_ms(({_BASE} + {number} * 60) * 1000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"


# A reference may lack its semicolon.
_UNESCAPE = "{0}"
for _name, _char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _UNESCAPE = f"regexp_replace({_UNESCAPE}, '&{_name}(?:;|\\b)', '{_char}', 'g')"

_ITVIEC = f"""
SELECT 'itviec_role-' || doc_id AS job_id, {_TITLE} AS title,
  CASE WHEN doc_id % 7 <> 0 THEN upper(source) ELSE '' END AS company,
  n_chars || ' USD' AS salary, lang AS locations, 'Hybrid' AS working_method,
  strftime(epoch_ms(({_BASE} + doc_id * 60 - (doc_id % 40) *
    CASE doc_id % 4 WHEN 0 THEN 86400 WHEN 1 THEN 604800 WHEN 2 THEN 2592000 ELSE 3600 END) * 1000),
    '%Y-%m-%d') AS posted_date,
  source || '|' || lang AS skills,
  array_to_string(list_concat(['Role'], {_LINES}), chr(10)) AS description,
  'itviec' AS source, 'https://itviec.com/it-jobs/role-' || doc_id AS url,
  {_iso('doc_id')} AS crawled_at, doc_id AS number
FROM documents WHERE doc_id % 11 <> 0
"""

_TURN_DATE = "'2024-' || lpad((conv_id % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((conv_id % 28 + 1)::VARCHAR, 2, '0')"
_CHALLENGED = f"(conv_id % 13 = 0 OR {_any('text', CHALLENGE_MARKERS)})"

_TOPDEV = f"""
SELECT 'topdev_' || (conv_id * 1000 + turn) AS job_id, {_TITLE} AS title,
  CASE WHEN conv_id % 2 = 0 THEN 'Co ' ELSE 'Firm ' END || conv_id AS company,
  CASE WHEN turn % 2 = 0 THEN conv_id || 'USD' ELSE 'MứcLương:' || conv_id || ' VND' END AS salary,
  'City ' || role AS locations, {_TURN_DATE} AS posted_date,
  array_to_string(list_sort(list_distinct(['go', role])), '|') AS skills,
  array_to_string(list_concat(CASE WHEN conv_id % 3 = 0 THEN []::VARCHAR[] ELSE ['About'] END, {_LINES}), chr(10))
    AS description,
  'topdev' AS source,
  'https://topdev.vn/detail-jobs/job-' || conv_id || '-' || (conv_id * 1000 + turn) AS url,
  {_iso('conv_id')} AS crawled_at, conv_id * 1000 + turn AS number
FROM conversations WHERE NOT {_CHALLENGED}
"""

_EVENT_KEYS = """
SELECT DISTINCT user_id || '-' || event_type AS job_id,
  CASE WHEN event_id % 20 <> 0 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS posted_date
FROM events WHERE event_id % 50 <> 0 AND ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}'
"""
_KNOWN = _EVENT_KEYS.format(lo="2024-01-16", hi="2024-01-23")
_CANDIDATES = "SELECT event_id, user_id || '-' || event_type AS job_id, ts FROM events"

_CODES = "[200, 204, 304, 404, 410, 451, 429, 500, 502, 503, 504, 403, 0]"
_LOG = f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'itviec' ELSE 'topdev' END AS source,
  'https://jobs.example/' || o_orderkey AS url, code BETWEEN 200 AND 299 AS is_valid, code AS status_code,
  CASE WHEN code BETWEEN 200 AND 299 THEN 'OK' ELSE o_orderpriority END AS reason,
  CASE WHEN code BETWEEN 200 AND 299 THEN '' WHEN code <> 0 THEN 'HTTPError'
       WHEN o_orderkey % 26 = 12 THEN 'TimeoutError' ELSE 'URLError' END AS error_type,
  CASE WHEN code BETWEEN 200 AND 299 THEN '' ELSE 'Traceback' || chr(10) || 'line' END AS tb_str
FROM (SELECT *, {_CODES}[o_orderkey % 13 + 1] AS code FROM orders)
"""
_ERRORS = f"""
SELECT source, error_type, '[' || status_code || '] ' || reason AS error_msg,
  'url_validator: ' || url AS context, tb_str AS traceback FROM ({_LOG}) WHERE NOT is_valid
"""

_RECORDS = f"""
SELECT 'itviec_' || doc_id AS job_id, {_TITLE} AS title, source AS company, '' AS salary, lang AS locations,
  CASE WHEN doc_id % 2 = 0 THEN 'Hybrid' END AS working_method,
  CASE WHEN doc_id % 3 = 0 THEN '30+ days ago'
       ELSE '2024-02-' || lpad((doc_id % 40)::VARCHAR, 2, '0') END AS posted_date,
  lang || '|' || source AS skills, text AS description, 'itviec' AS source,
  'https://jobs.example/' || doc_id AS url, {_iso('doc_id')} AS crawled_at, doc_id AS number
FROM documents
"""

_GRADED = f"""
SELECT doc_id, lang AS source, doc_id % 10 AS batch_no,
  doc_id % 4 = 0 OR n_chars < 600 OR {_TITLE} = '' AS bad FROM documents
"""


def _report(rows: str, by: str, name: str, fields: str) -> str:
    failed = f"'Quality check failed for ''' || {name} || ''': ' || bad || '/' || total || ' records (' || "
    failed += f"round_even(100.0 * bad / total, 0)::INT || '%) lack a critical field ({fields})'"
    passed = f"'[' || {name} || '] ' || (total - bad) || ' of ' || total || ' records have all critical fields'"
    return f"""
    SELECT {by}, total, bad, total - bad AS clean, bad / total AS ratio, bad / total <= 0.5 AS passed,
      CASE WHEN bad / total <= 0.5 THEN {passed} ELSE {failed} END AS message
    FROM (SELECT {by}, count(*) AS total, count(*) FILTER (bad) AS bad FROM ({rows}) GROUP BY {by})
    """


def _relative() -> str:
    words = [w for w, _ in UNIT_SECONDS]
    seconds = dict(UNIT_SECONDS)
    phrases = [f" {w}s ago" for w in words] + [f"\xa0{w.upper()} trước" for w in words] + ["", " moons ago", "+ days ago"]
    lengths = [seconds[w] for w in words] * 2
    quoted = "[" + ", ".join(f"'{p}'" for p in phrases) + "]"
    return f"""
    SELECT l_orderkey, l_linenumber, phrase,
      CASE WHEN pick <= {len(lengths)}
        THEN strftime(l_shipdate - to_seconds((l_quantity::INT) * ({lengths!r}[pick])), '%Y-%m-%d')
        ELSE phrase END AS posted_date
    FROM (SELECT *, 'Posted ' || (l_quantity::INT) || ({quoted}[pick]) AS phrase
          FROM (SELECT *, l_orderkey % {len(phrases)} + 1 AS pick FROM lineitem))
    """


def _saved(rows: str, skip: str = "FALSE") -> str:
    return f"SELECT job_id, title, company, posted_date, url FROM ({rows}) WHERE NOT ({skip}) AND title <> ''"


_SITE1_CARDS = "SELECT p_partkey // 20 + 1 AS page_no, p_partkey AS key FROM part"
_PAGES = "(SELECT max(p_partkey) // 20 + 1 FROM part)"
_NAMED = f"greatest(1, {_PAGES} * 2 // 3)"
_FRONTIER = f"""
SELECT 'itviec' AS source, 'part-' || key AS slug FROM ({_SITE1_CARDS}) WHERE page_no <= {_PAGES} * 3 // 4 AND page_no <= {{limit1}}
UNION ALL
SELECT 'topdev', 'part-x-' || key FROM ({_SITE1_CARDS}) WHERE page_no <= {{limit2}}
"""


def _site1_batches(where: str) -> str:
    """Documents as site-1 records of pages that pass the filters, with their batch."""
    return f"""
    SELECT b.batch_no, r.* FROM ({_ITVIEC}) r JOIN (
      SELECT doc_id AS number, (row_number() OVER (ORDER BY md5('https://itviec.com/it-jobs/role-' || doc_id)) - 1) // 5 + 1 AS batch_no
      FROM documents WHERE {where}) b USING (number)
    WHERE title <> ''"""


def _site1_saved(where: str) -> str:
    return f"""
    SELECT job_id, title, company, posted_date, url FROM ({_site1_batches(where)})
    QUALIFY avg((company = '')::INT) OVER (PARTITION BY batch_no) <= 0.5"""


_CHECKED_1 = _site1_batches("doc_id % 8 <> 3")
_CHECKED_2 = f"""
    SELECT b.batch_no, r.* FROM ({_TOPDEV}) r JOIN (
      SELECT conv_id * 1000 + turn AS number,
        row_number() OVER (ORDER BY md5('https://topdev.vn/detail-jobs/job-' || conv_id || '-' || (conv_id * 1000 + turn))) AS batch_no
      FROM conversations) b USING (number)
    WHERE title <> ''"""

def oracle_sql() -> dict[str, str]:
    return {
        "page_titles": f"""
            SELECT page_id, {_strip(_UNESCAPE.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS title
            FROM pages""",
        "page_slugs": """
            WITH links AS (
              SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS i
              FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)),
            slugs AS (
              SELECT page_id, i, trim(string_split(string_split(href, '?')[1], '/')[-1], '/') AS slug
              FROM links WHERE contains(href, '/')),
            firsts AS (SELECT page_id, slug, min(i) AS i FROM slugs WHERE slug <> '' GROUP BY ALL)
            SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS pos, slug FROM firsts""",
        "page_articles": f"""
            SELECT page_id, array_to_string(list_filter(list_transform(
              regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>'),
              lambda x: {_strip(_UNESCAPE.format('x'))}), lambda x: x <> ''), chr(10)) AS body
            FROM pages""",
        "page_footers": f"""
            SELECT page_id, {_strip(_UNESCAPE.format("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)"))} AS footer
            FROM pages""",
        "challenge_pages": f"""
            SELECT page_id, url FROM pages WHERE {_any('html', (*CHALLENGE_MARKERS, 'track(1'))}""",
        "headed_pages": """
            SELECT 'pages' AS kind, contains(html, '<h1>') AS headed, count(*) AS n FROM pages GROUP BY ALL
            UNION ALL SELECT 'itviec', doc_id % 11 <> 0, count(*) FROM documents GROUP BY ALL""",
        "url_pieces": """
            SELECT page_id, plain, last_piece, regexp_full_match(last_piece, '[0-9]+') AS is_number,
              regexp_extract(plain, '([0-9]+)/?$', 1) AS number,
              CASE WHEN starts_with(url, 'https://') THEN substring(url, 9) ELSE url END AS rest
            FROM (SELECT *, string_split(trim(plain, '/'), '/')[-1] AS last_piece
                  FROM (SELECT *, regexp_extract(url, '^[^?#]*') AS plain FROM pages))""",
        "listing_slugs_attribute": f"""
            SELECT page_no::INT AS page_no,
              (row_number() OVER (PARTITION BY page_no ORDER BY key) - 1)::INT AS pos, 'part-' || key AS slug
            FROM ({_SITE1_CARDS}) WHERE page_no <> {_PAGES} * 3 // 4 + 1""",
        "listing_slugs_link": f"""
            SELECT page_no::INT AS page_no,
              (row_number() OVER (PARTITION BY page_no ORDER BY key) - 1)::INT AS pos, 'part-x-' || key AS slug
            FROM ({_SITE1_CARDS})""",
        "listing_page_counts": f"""
            WITH p AS (SELECT DISTINCT page_no FROM ({_SITE1_CARDS}))
            SELECT 'itviec' AS source, page_no::INT AS page_no,
              CASE WHEN page_no = 1 THEN 1000000 ELSE page_no + 4 END AS pages FROM p
            UNION ALL
            SELECT 'topdev', page_no::INT, CASE WHEN page_no = 1 THEN {_NAMED} ELSE page_no + 2 END FROM p""",
        "frontier": _FRONTIER.format(limit1=1000000, limit2=_NAMED),
        "frontier_first_pages": _FRONTIER.format(limit1=3, limit2=3),
        "url_id_map": f"""
            SELECT source, slug,
              CASE source WHEN 'itviec' THEN 'https://itviec.com/it-jobs/'
                ELSE 'https://topdev.vn/detail-jobs/' END || slug AS url,
              CASE source WHEN 'itviec' THEN 'itviec_' || slug
                ELSE 'topdev_' || replace(slug, 'part-x-', '') END AS job_id
            FROM ({_FRONTIER.format(limit1=1000000, limit2=_NAMED)})""",
        "job_ids": """
            SELECT page_id, 'topdev_' || CASE WHEN page_id % 3 <> 0 THEN page_id::VARCHAR
              ELSE string_split(string_split(url, '?')[1], '//')[-1] || '-' || page_id || 'x' END AS job_id
            FROM pages""",
        "itviec_records": f"SELECT * EXCLUDE (number) FROM ({_ITVIEC})",
        "archived_records": f"SELECT * EXCLUDE (number) FROM ({_ITVIEC})",
        "streamed_archives": "SELECT page_id, url, length(html) AS n_chars, md5(html) AS html_md5 FROM pages",
        "topdev_records": f"SELECT * EXCLUDE (number) FROM ({_TOPDEV})",
        "relative_dates": _relative(),
        "dmy_dates": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'open'
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS posted_date FROM orders""",
        "key_dates": """
            SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN ''
              ELSE coalesce(strftime(try_cast(strftime(o_orderdate, '%Y-%m-') ||
                lpad((o_orderkey % 62 + 1)::VARCHAR, 2, '0') AS DATE), '%Y-%m-%d'), '') END AS key_date
            FROM orders""",
        "stripped_texts": f"""
            SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' ELSE {_strip('text')} END AS stripped,
              doc_id % 10 = 0 OR {_strip('text')} = '' AS blank FROM documents""",
        "decoded_texts": "SELECT doc_id, 'é€😀<b> ' || text || ' &unknown; & €' AS decoded FROM documents",
        "iso_times": """
            SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
              ELSE strftime(ts, '.%f') END || '+00:00' AS crawled_at FROM events""",
        "record_json": f"""
            SELECT doc_id, json_object('job_id', doc_id::VARCHAR, 'title', {_TITLE}, 'skills', [lang, source],
              'description', text, 'source', CASE WHEN doc_id % 5 <> 0 THEN source END)::VARCHAR AS line
            FROM documents""",
        "recent_keys": _EVENT_KEYS.format(lo="2024-01-11", hi="2100-01-01"),
        "new_ids": f"""
            SELECT event_id, job_id FROM ({_CANDIDATES})
            WHERE job_id NOT IN (SELECT job_id FROM ({_KNOWN}))""",
        "filtered_ids": f"""
            SELECT event_id, job_id FROM ({_CANDIDATES})
            WHERE job_id NOT IN (SELECT job_id FROM ({_KNOWN}))""",
        "first_run_ids": f"SELECT DISTINCT job_id FROM ({_CANDIDATES})",
        "new_records": f"""
            SELECT c.* FROM (SELECT event_id, job_id, CASE WHEN event_id % 10 <> 0
              THEN strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d') ELSE '' END AS posted_date FROM ({_CANDIDATES})) c
            ANTI JOIN ({_KNOWN}) k ON c.job_id = k.job_id AND c.posted_date = k.posted_date""",
        "skipped_count": f"""
            SELECT count(*) AS total, count(*) FILTER (NOT known) AS new, count(*) FILTER (known) AS skipped
            FROM (SELECT DISTINCT job_id, job_id IN (SELECT job_id FROM ({_KNOWN})) AS known
                  FROM ({_CANDIDATES}))""",
        "dedup_across_batches": """
            SELECT event_id, user_id, event_type, event_id // 500 AS batch_no FROM events
            QUALIFY event_id // 500 = min(event_id // 500) OVER (PARTITION BY user_id, event_type)""",
        "micro_batches": """
            SELECT event_type AS source, event_id::VARCHAR AS url,
              (row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR), event_id::VARCHAR) - 1) // 5 + 1 AS batch_no
            FROM events""",
        "batch_numbers": """
            WITH u AS (
              SELECT 'itviec' AS source, 'https://itviec.com/it-jobs/role-' || doc_id AS url, 5 AS size FROM documents
              UNION SELECT 'topdev', 'https://topdev.vn/detail-jobs/job-' || conv_id || '-' || (conv_id * 1000 + turn), 1 FROM conversations)
            SELECT source, url, (row_number() OVER (PARTITION BY source ORDER BY md5(url), url) - 1) // size + 1 AS batch_no FROM u""",
        "keys_of_failed_batches": """
            WITH r AS (SELECT event_id, event_id // 50 + 1 AS batch_no, user_id || '-' || event_type AS key,
              event_id % 17 = 0 AS rejected, (event_id // 50) % 2 = 1 AS passes FROM events)
            SELECT event_id, batch_no, CASE WHEN rejected THEN 'no_title'
              WHEN batch_no > min(batch_no) FILTER (passes AND NOT rejected) OVER (PARTITION BY key) THEN 'repeated_key'
              WHEN passes THEN 'saved' ELSE 'gate_failed' END AS outcome FROM r""",
        "new_url_map": """
            SELECT 'https://itviec.com/it-jobs/part-' || p_partkey AS url, 'itviec_part-' || p_partkey AS job_id
            FROM part WHERE p_partkey % 3 <> 0""",
        "triage": f"""
            SELECT 'topdev_' || (conv_id * 1000 + turn) AS job_id,
              CASE WHEN challenged THEN '' ELSE day END AS key_date,
              CASE WHEN challenged THEN 'challenge_page' WHEN title = '' THEN 'no_title'
                   WHEN conv_id % 5 = 0 AND conv_id % 10 <> 0 THEN 'known_record' END AS reject_reason
            FROM (SELECT *, {_CHALLENGED} AS challenged, {_TURN_DATE} AS day, {_TITLE} AS title FROM conversations)""",
        "run_progress": """
            SELECT source, batch_no, count(*) OVER (PARTITION BY source) AS total_batches, saved,
              (sum(saved) OVER (PARTITION BY source ORDER BY batch_no))::BIGINT AS total_saved
            FROM (SELECT event_type AS source, event_id // 50 + 1 AS batch_no,
                    count(*) FILTER (value > 10) AS saved FROM events GROUP BY ALL)""",
        "quality_report": _report(
            f"SELECT lang, {_strip('text')} = '' OR n_chars < 200 AS bad FROM documents", "lang", "lang", "text"),
        "quality_report_by_batch": _report(
            _GRADED, "source, batch_no", "source || '/' || batch_no", "title, company"),
        "quality_gate": f"""
            SELECT doc_id, source, batch_no FROM ({_GRADED})
            QUALIFY avg(bad::INT) OVER (PARTITION BY source, batch_no) <= 0.5""",
        "checked_urls": f"SELECT * EXCLUDE (source) FROM ({_LOG})",
        "url_partition": f"""
            SELECT 'valid' AS side, -1 AS status_code, '' AS severity, '' AS failure_class, count(*) AS n
            FROM ({_LOG}) WHERE is_valid
            UNION ALL
            SELECT 'failed', status_code,
              CASE WHEN status_code IN (429, 500, 502, 503, 504) THEN 'warning' ELSE 'error' END,
              CASE WHEN status_code IN (404, 410, 451) THEN 'permanent'
                   WHEN status_code IN (429, 500, 502, 503, 504) THEN 'transient' ELSE 'other' END, count(*)
            FROM ({_LOG}) WHERE NOT is_valid GROUP BY status_code""",
        "url_check_counts": f"""
            SELECT count(*) FILTER (is_valid) AS reachable, count(*) FILTER (NOT is_valid) AS failed,
              count(*) AS total FROM ({_LOG})""",
        "url_check_switch": f"SELECT source, url FROM ({_LOG}) WHERE is_valid OR source = 'topdev'",
        "error_records": _ERRORS,
        "error_append": _ERRORS,
        "error_classes": f"""
            SELECT doc_id, CASE WHEN doc_id % 6 = 0 OR doc_id % 10 = 1 OR {_any('text', DISCONNECT_MARKERS)}
              THEN 'disconnect' ELSE 'generic' END AS error_class FROM documents""",
        "jsonl_append": f"SELECT * EXCLUDE (number) FROM ({_RECORDS})",
        "jsonl_overwrite": f"""
            SELECT job_id, working_method, description FROM ({_RECORDS}) WHERE working_method = 'Hybrid'""",
        "silver_load": f"""
            SELECT job_id, title, company, salary, locations, working_method,
              try_cast(posted_date AS DATE)::VARCHAR AS posted_date, skills, source, url,
              {_BASE} + number * 60 AS crawled_seconds, TRUE AS ingested
            FROM ({_RECORDS})""",
        "batch_ingest": f"""
            {_saved(_ITVIEC, "number % 9 = 0 OR number % 7 = 0")} UNION ALL {_saved(_TOPDEV)}""",
        "listed_ingest": _site1_saved(
            "doc_id % 9 <> 0 AND doc_id // 20 + 1 <= (SELECT max(doc_id) // 20 + 1 FROM documents) * 3 // 4"),
        "checked_ingest": f"""
            SELECT 'itviec' AS source, count(*) AS n FROM ({_site1_saved("doc_id % 8 <> 3")})
            UNION ALL SELECT 'topdev', count(*) FROM ({_TOPDEV}) WHERE title <> ''
            UNION ALL SELECT 'error', count(*) FROM documents WHERE doc_id % 8 = 3""",
        "page_outcomes": f"""
            SELECT * FROM (
            SELECT 'itviec' AS source, 'saved' AS outcome, count(*) AS n FROM ({_site1_saved("doc_id % 8 <> 3")})
            UNION ALL SELECT 'itviec', 'gate_failed', (SELECT count(*) FROM ({_CHECKED_1})) - count(*) FROM ({_site1_saved("doc_id % 8 <> 3")})
            UNION ALL SELECT 'itviec', 'url_failed', count(*) FROM documents WHERE doc_id % 8 = 3
            UNION ALL SELECT 'itviec', 'no_heading', count(*) FROM documents WHERE doc_id % 8 <> 3 AND doc_id % 11 = 0
            UNION ALL SELECT 'itviec', 'no_title', count(*) FROM documents WHERE doc_id % 8 <> 3 AND doc_id % 11 <> 0 AND {_TITLE} = ''
            UNION ALL SELECT 'topdev', 'saved', count(*) FROM ({_TOPDEV}) WHERE title <> ''
            UNION ALL SELECT 'topdev', 'challenge_page', count(*) FROM conversations WHERE {_CHALLENGED}
            UNION ALL SELECT 'topdev', 'no_title', count(*) FROM ({_TOPDEV}) WHERE title = '') WHERE n > 0""",
        "gate_reports": f"""
            SELECT source, batch_no, total, bad, passed, message FROM ({_report(
                f"SELECT source, batch_no, company = '' AS bad FROM ({_CHECKED_1}) UNION ALL SELECT source, batch_no, company = '' FROM ({_CHECKED_2})",
                "source, batch_no", "source || '/' || batch_no", "title, company")})""",
        "stream_ingest": f"{_site1_saved('doc_id % 9 <> 0')} UNION ALL {_saved(_TOPDEV)}",
        "saved_so_far": f"""
            SELECT source, number % 3 + 1 AS batch_no, count(*) OVER (PARTITION BY source) AS total_batches, count(title) AS saved,
              (sum(count(title)) OVER (PARTITION BY source ORDER BY number % 3))::BIGINT AS total_saved
            FROM (SELECT source, number, CASE WHEN title <> '' THEN title END AS title FROM ({_TOPDEV})) GROUP BY source, number % 3""",
        "concurrent_ingest": _saved(_TOPDEV),
        "catalog_keys": f"""
            SELECT DISTINCT job_id, coalesce(try_cast(posted_date AS DATE)::VARCHAR, '') AS posted_date FROM ({_RECORDS})
            WHERE to_timestamp({_BASE} + number * 60) >= TIMESTAMPTZ '2023-12-21 00:00:00+00'""",
        "catalog_areas": f"""
            SELECT 'raws' AS area, source, count(*) AS n FROM ({_RECORDS}) GROUP BY source
            UNION ALL SELECT 'error', source, count(*) FROM ({_ERRORS}) GROUP BY source""",
        "stream_new_pairs": """
            WITH r AS (
              SELECT event_id, user_id || '-' || event_type AS job_id, CASE WHEN event_id % 3 = 0 THEN '2024-01-01' ELSE '' END AS posted_date,
                ts::DATE AS day, CASE WHEN day(ts) <= 8 THEN 1 WHEN day(ts) <= 16 THEN 2 ELSE 3 END AS batch FROM events),
            first AS (SELECT * FROM r WHERE batch = 1),
            known1 AS (SELECT job_id, posted_date, max(day) AS kept FROM first GROUP BY ALL),
            second AS (
              SELECT r.* FROM r LEFT JOIN known1 k USING (job_id, posted_date)
              WHERE batch = 2 AND (kept IS NULL OR day > kept + 10)),
            known2 AS (SELECT job_id, posted_date, max(day) AS kept FROM (FROM first UNION ALL FROM second) GROUP BY ALL),
            third AS (
              SELECT r.* FROM r LEFT JOIN known2 k USING (job_id, posted_date)
              WHERE batch = 3 AND (kept IS NULL OR day > kept + 10))
            SELECT event_id, job_id, posted_date FROM (FROM first UNION ALL FROM second UNION ALL FROM third)""",
        "failed_run": """
            SELECT 'itviec' AS source, 'ListingError' AS error_type,
              'no HTML for the first listing page of: itviec' AS error_msg, 'main' AS context, 'generic' AS error_class,
              0::BIGINT AS saved""",
    }
