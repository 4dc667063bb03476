"""DuckDB SQL that recomputes every registered query independently.

The driver runs these next to the Spark queries on the same parquet tables
(views ``events``, ``orders``, ``pages`` ...). They are written as plain SQL
with different algorithms where it matters (window ``row_number`` + join for
attribution instead of a one-pass ``max(struct)``), so agreement is evidence
rather than a copy of the same plan.

DuckDB differences handled here: ``url_decode`` keeps ``+`` (replace first),
list indexes are 1-based, lambdas use ``lambda x: ...``, ``TRY_CAST('1.5' AS
BIGINT)`` rounds (so integers are matched by regex first), JSON keeps nulls.
"""

from __future__ import annotations

from ..functions.text import WHITESPACE_CLASS
from ..schema import DEFAULT_BUCKET, DEFAULT_CONTENT_TYPE, DEFAULT_SITE, HIT_COLUMNS, SEARCH_PARAMS

RUN_DATE = "2026-03-06"
LANDING_SPLITS = 4  # parts of the visitors that a day's landing files are split by
SITE = DEFAULT_SITE

# --------------------------------------------------------------------------
# Expression builders (take and return SQL text)
# --------------------------------------------------------------------------


def strip(x: str) -> str:
    ws = WHITESPACE_CLASS
    return rf"regexp_replace({x}, '\A{ws}+|{ws}+\z', '', 'g')"


def decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def clean(u: str) -> str:
    return rf"regexp_replace({u}, '^[\x00-\x20]+|[\t\r\n]', '', 'g')"


def domain(u: str) -> str:
    host = f"lower(regexp_extract({clean(u)}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1))"
    return (f"(CASE WHEN {u} IS NULL OR {u} = '' THEN NULL "
            f"ELSE regexp_replace({host}, '^www[.]', '') END)")


def query(u: str) -> str:
    return f"regexp_extract({clean(u)}, '^[^?#]*[?]([^#]*)', 1)"


_NAME_PART = "split_part(p, '=', 1)"


def pairs(u: str) -> str:
    """list<struct(n, v)>: kept pairs, name decoded once, value raw."""
    return (f"list_transform(list_filter(string_split({query(u)}, '&'), "
            f"lambda p: strpos(p, '=') > 0 AND substr(p, strpos(p, '=') + 1) <> ''), "
            f"lambda p: {{'n': {decode(_NAME_PART)}, "
            f"'v': substr(p, strpos(p, '=') + 1)}})")


def raw_keyword(u: str) -> str:
    picks = ", ".join(f"list_filter({pairs(u)}, lambda x: x.n = '{p}')[1].v" for p in SEARCH_PARAMS)
    return f"(CASE WHEN {u} IS NULL OR {u} = '' THEN NULL ELSE {decode(f'coalesce({picks})')} END)"


def keyword(raw: str, case_sensitive: bool = False) -> str:
    kw = strip(decode(raw))
    return kw if case_sensitive else f"lower({kw})"


def revenue(pl: str) -> str:
    parts = f"string_split({pl}, ';')"
    qty = strip(f"{parts}[3]")
    price = strip(f"{parts}[4]")
    qty_v = f"(CASE WHEN regexp_full_match({qty}, '[+-]?[0-9]+') THEN TRY_CAST({qty} AS DECIMAL(13,0)) END)"
    price_v = (f"(CASE WHEN regexp_full_match({price}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
               f"THEN TRY_CAST({price} AS DECIMAL(24,10)) END)")
    return f"coalesce(CAST({qty_v} * {price_v} AS DECIMAL(38,10)), CAST(0 AS DECIMAL(38,10)))"


def price(pl: str) -> str:
    p = strip(f"string_split({pl}, ';')[4]")
    return (f"coalesce(CASE WHEN regexp_full_match({p}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({p} AS DOUBLE) END, 0.0)")


# --------------------------------------------------------------------------
# Input adapters (same rules as sources.hits / sources.files)
# --------------------------------------------------------------------------

HITS_CTE = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         TRY_CAST(regexp_extract(props, '"k"\s*:\s*(-?[0-9]+)', 1) AS BIGINT) AS k
  FROM events
),
hits AS (
  SELECT event_id AS hit_id, ts, '10.0.0.' || CAST(user_id AS VARCHAR) AS ip,
    CASE event_type WHEN 'purchase' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '12'
                    ELSE '' END AS event_list,
    CASE WHEN event_type = 'purchase'
           THEN 'Electronics;Item;' || CAST(1 + k % 3 AS VARCHAR) || ';' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ';'
         WHEN event_type = 'click' THEN 'Electronics;Item;1;;' END AS product_list,
    CASE WHEN event_type = 'view' THEN
           CASE WHEN k % 4 = 0 THEN 'http://www.google.com/search?hl=en&q=Key+' || CAST(k % 7 AS VARCHAR)
                WHEN k % 4 = 1 THEN 'http://www.bing.com/search?q=key%20' || CAST(k % 7 AS VARCHAR) || '&form=QBLH'
                WHEN k % 4 = 2 THEN 'http://search.yahoo.com/search?p=KEY+' || CAST(k % 7 AS VARCHAR) || '&toggle=1'
                ELSE 'http://www.esshopzilla.com/search/?k=Key' END
         WHEN event_type = 'error' THEN
           CASE WHEN k % 6 = 0 THEN 'https://www.google.com/search?q=C%2B%2B&hl=en'
                WHEN k % 6 = 1 THEN 'https://duckduckgo.com/?q=&p=x' || CAST(k % 5 AS VARCHAR)
                WHEN k % 6 = 2 THEN 'http://Search.Yahoo.com:8080/s?search=100%25+off#q=frag'
                WHEN k % 6 = 3 THEN '//m.example.org/find?keywords=Blue%2BRed'
                WHEN k % 6 = 4 THEN 'www.google.com/search?q=nohost'
                ELSE 'https://www.bing.com/search?p=a&q=b&q=c' END
    END AS referrer
  FROM ev
)"""


def enriched_cte(case_sensitive: bool = False) -> str:
    return f"""
e1 AS (
  SELECT *, {domain('referrer')} AS domain, {raw_keyword('referrer')} AS raw_kw,
         {revenue('product_list')} AS revenue,
         coalesce(event_list = '1', false) AS is_purchase
  FROM hits
),
e2 AS (SELECT *, {keyword('raw_kw', case_sensitive)} AS search_keyword FROM e1),
enriched AS (
  SELECT *,
    coalesce(referrer <> '' AND domain <> '{SITE}' AND raw_kw IS NOT NULL, false) AS is_search_referral_lax,
    coalesce(referrer <> '' AND domain <> '{SITE}' AND raw_kw IS NOT NULL
             AND domain <> '' AND search_keyword <> '', false) AS is_search_referral
  FROM e2
)"""


def touch_cte(name: str, flag: str, last: bool) -> str:
    d = "DESC" if last else "ASC"
    return f"""
{name} AS (
  SELECT ip, domain, keyword FROM (
    SELECT ip, domain, search_keyword AS keyword,
           row_number() OVER (PARTITION BY ip ORDER BY ts {d}, hit_id {d}, domain {d},
                              search_keyword {d}) AS rn
    FROM enriched WHERE {flag} AND ip IS NOT NULL) WHERE rn = 1
)"""


BUYS_CTE = """
buys AS (SELECT hit_id, ip, revenue FROM enriched
         WHERE is_purchase AND revenue > 0 AND ip IS NOT NULL),
buyer AS (SELECT ip, sum(revenue) AS revenue, count(*) AS n_purchases FROM buys GROUP BY ip)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def base(case_sensitive: bool = False) -> str:
    return with_(HITS_CTE, enriched_cte(case_sensitive), touch_cte("last_t", "is_search_referral", True),
                 touch_cte("first_t", "is_search_referral", False),
                 touch_cte("first_lax_t", "is_search_referral_lax", False), BUYS_CTE)


REPORT = """
report AS (
  SELECT t.domain, t.keyword, sum(b.revenue) AS revenue
  FROM last_t t JOIN buyer b USING (ip) GROUP BY t.domain, t.keyword
)"""


FILES_CTE = r"""
files AS (
  SELECT o_orderkey AS event_seq,
    'hits/year=' || CAST(year(o_orderdate) AS VARCHAR) || '/month=' || CAST(month(o_orderdate) AS VARCHAR)
      || '/' || CASE WHEN o_orderkey % 50 = 7 THEN ''
                     ELSE 'day=' || CAST(day(o_orderdate) AS VARCHAR) || '/' END
      || CASE WHEN o_orderkey % 50 = 11 THEN 'f' || CAST(o_orderkey % 500 AS VARCHAR) || '+copy%201.csv'
              ELSE 'f' || CAST(o_orderkey % 500 AS VARCHAR) || '.csv' END AS raw_key,
    CAST(floor(o_totalprice * 16384) AS BIGINT) AS file_size,
    o_orderdate AS file_ts,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'RECEIVED' WHEN 'P' THEN 'FAILED'
                       ELSE 'ERROR' END AS file_status
  FROM orders
)"""


def _part(key: str, name: str) -> tuple[str, str]:
    present = f"regexp_matches({key}, '(?:^|/){name}=')"
    value = f"regexp_extract({key}, '(?s).*(?:^|/){name}=([^/=]*)', 1)"
    return present, value


def zfill2(x: str) -> str:
    return (f"(CASE WHEN length({x}) >= 2 THEN {x} WHEN {x} IN ('+', '-') THEN {x} || '0' "
            f"ELSE lpad({x}, 2, '0') END)")


def file_date(key: str, run_date: str = RUN_DATE) -> str:
    yp, y = _part(key, "year")
    mp, m = _part(key, "month")
    dp, d = _part(key, "day")
    return (f"(CASE WHEN {yp} AND {y} <> '' AND {mp} AND {dp} "
            f"THEN {y} || '-' || {zfill2(m)} || '-' || {zfill2(d)} ELSE '{run_date}' END)")


def size_gb(b: str) -> str:
    """Half-even rounding of bytes / 2^30 to 2 places, in exact integer arithmetic."""
    num = f"(CAST({b} AS HUGEINT) * 100)"
    q = f"({num} // 1073741824)"
    r = f"({num} % 1073741824)"
    rounded = (f"(CASE WHEN 2 * {r} > 1073741824 THEN {q} + 1 "
               f"WHEN 2 * {r} = 1073741824 THEN {q} + ({q} % 2) ELSE {q} END)")
    return f"(CAST({rounded} AS DOUBLE) / 100)"


MANIFEST_CTE = f"""
manifest AS (
  SELECT event_seq, file_status, file_ts, {decode('raw_key')} AS file_key, file_size FROM files
),
manifest2 AS (
  SELECT event_seq, file_status, file_ts, file_key,
         regexp_extract(file_key, '([^/]*)$', 1) AS file_name,
         {file_date('file_key')} AS file_date, file_size,
         {size_gb('file_size')} AS file_size_gb,
         CASE WHEN file_size < 2147483648 THEN 'small' WHEN file_size >= 2147483648 THEN 'large' END
           AS size_class
  FROM manifest
)"""


def iso_utc(ts: str) -> str:
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({ts}) % 1000000 <> 0 "
            f"THEN '.' || lpad(CAST(microsecond({ts}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || 'Z')")


STATUS_CTE = f"""
status AS (
  SELECT event_seq, file_date, file_key, file_status, file_size, file_size_gb,
    CASE WHEN file_status = 'RECEIVED' THEN 'ARRIVAL'
         WHEN file_size < 2147483648 THEN 'SMALL_FILE' WHEN file_size >= 2147483648 THEN 'LARGE_FILE' END
      AS event_type,
    '{DEFAULT_BUCKET}' AS bucket, '{DEFAULT_CONTENT_TYPE}' AS content_type,
    {iso_utc('file_ts')} AS file_datetime, file_ts,
    CAST(NULL AS VARCHAR) AS error_message
  FROM manifest2
)"""


def _json_pairs(names: list[str]) -> str:
    return ", ".join(f"'{n}', {n if n != 'file_size_gb' else chr(39) * 2}" for n in names)


_PAYLOAD_FIELDS = ["file_date", "file_key", "bucket", "content_type", "event_type", "file_datetime",
                   "file_size_gb", "file_status"]
PAYLOAD = (f"CASE WHEN error_message IS NULL THEN CAST(json_object({_json_pairs(_PAYLOAD_FIELDS)}) AS VARCHAR) "
           f"ELSE CAST(json_object({_json_pairs(_PAYLOAD_FIELDS)}, 'error_message', error_message) AS VARCHAR) END")


RAW_EVENTS_CTE = f"""
raw_events AS (
  SELECT event_seq,
    CASE WHEN event_seq % 101 = 0 THEN NULL ELSE file_key END AS file_key,
    CASE WHEN event_seq % 103 = 0 THEN '' ELSE file_status END AS file_status,
    CASE WHEN event_seq % 107 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_seq % 109 = 0 THEN '' ELSE file_date END AS file_date
  FROM status
)"""

LOG_CTE = f"""
log AS (
  SELECT event_seq, 'hits/f' || CAST(event_seq % 500 AS VARCHAR) || '.csv' AS file_key, file_status,
         event_type, file_datetime, file_ts FROM status
)"""


# --------------------------------------------------------------------------
# The queries
# --------------------------------------------------------------------------

def _urls_cte() -> str:
    return with_(HITS_CTE, """
urls AS (
  SELECT 'hit' AS source, hit_id AS id, referrer AS url FROM hits WHERE referrer IS NOT NULL
  UNION ALL
  SELECT 'page' AS source, page_id AS id, url FROM pages WHERE url IS NOT NULL
)""")


def oracle_sql() -> dict[str, str]:
    b = base()
    report = with_(HITS_CTE, enriched_cte(), touch_cte("last_t", "is_search_referral", True),
                   BUYS_CTE, REPORT)
    files = with_(FILES_CTE, MANIFEST_CTE, STATUS_CTE)
    q: dict[str, str] = {}
    q["hits_count"] = f"{with_(HITS_CTE)} SELECT count(*) AS hits FROM hits"
    q["referrer_domain"] = (f"{_urls_cte()} SELECT source, id, url, {domain('url')} AS domain FROM urls")
    q["referrer_params"] = f"""{_urls_cte()}
, kv AS (SELECT source, id, url, {pairs('url')} AS kv FROM urls)
, ex AS (SELECT source, id, url, unnest(generate_series(1, len(kv))) AS pos, unnest(kv) AS p
         FROM kv WHERE len(kv) > 0)
SELECT source, id, url, pos, p.n AS name, {decode('p.v')} AS value FROM ex"""
    q["referrer_keyword"] = (f"{_urls_cte()} SELECT source, id, url, "
                             f"{keyword(raw_keyword('url'))} AS keyword FROM urls")
    q["line_revenue"] = (f"{with_(HITS_CTE)} SELECT hit_id, product_list, "
                         f"CAST({revenue('product_list')} AS DOUBLE) AS revenue FROM hits "
                         f"WHERE product_list IS NOT NULL")
    q["line_price"] = (f"{with_(HITS_CTE)} SELECT hit_id, product_list, "
                       f"CAST({price('product_list')} AS DOUBLE) AS price FROM hits "
                       f"WHERE product_list IS NOT NULL")
    q["is_search_referral"] = f"{b} SELECT hit_id, is_search_referral FROM enriched"
    q["is_search_referral_lax"] = f"{b} SELECT hit_id, is_search_referral_lax FROM enriched"
    q["is_purchase"] = f"{b} SELECT hit_id, is_purchase FROM enriched"
    q["enriched_hits"] = (f"{b} SELECT hit_id, ip, domain, search_keyword, CAST(revenue AS DOUBLE) AS revenue, "
                          f"is_search_referral, is_search_referral_lax, is_purchase FROM enriched")
    q["search_hits"] = (f"{b} SELECT hit_id, ip, domain, search_keyword FROM enriched "
                        f"WHERE is_search_referral")
    q["purchase_hits"] = f"{b} SELECT hit_id, ip, CAST(revenue AS DOUBLE) AS revenue FROM buys"
    q["last_touch"] = f"{b} SELECT ip, domain, keyword FROM last_t"
    q["first_touch"] = f"{b} SELECT ip, domain, keyword FROM first_t"
    q["search_sessions_any"] = (f"{b} SELECT DISTINCT ip FROM enriched "
                                f"WHERE is_search_referral_lax AND ip IS NOT NULL")
    q["purchase_sessions"] = (f"{b} SELECT ip, CAST(revenue AS DOUBLE) AS amount, count(*) AS n "
                              f"FROM buys GROUP BY ip, revenue")
    q["attribution_join"] = (f"{b} SELECT t.ip, t.domain, t.keyword, CAST(b.revenue AS DOUBLE) AS amount, "
                             f"count(*) AS n FROM last_t t JOIN buys b ON t.ip = b.ip "
                             f"GROUP BY t.ip, t.domain, t.keyword, b.revenue")
    q["attributed_purchases"] = (f"{b} SELECT b.hit_id, b.ip, t.domain, t.keyword, "
                                 f"CAST(b.revenue AS DOUBLE) AS revenue FROM buys b JOIN last_t t USING (ip)")
    q["visitor_sessions"] = f"""{b}
SELECT coalesce(t.ip, y.ip) AS ip, t.domain, t.keyword, CAST(y.revenue AS DOUBLE) AS revenue,
       coalesce(y.n_purchases, 0) AS n_purchases
FROM last_t t FULL OUTER JOIN buyer y ON t.ip = y.ip"""
    q["visitor_revenue"] = (f"{b} SELECT ip, CAST(revenue AS DOUBLE) AS revenue, n_purchases FROM buyer")
    q["keyword_revenue"] = f"{report} SELECT domain, keyword, CAST(revenue AS DOUBLE) AS revenue FROM report"
    report_cs = with_(HITS_CTE, enriched_cte(case_sensitive=True),
                      touch_cte("last_t", "is_search_referral", True), BUYS_CTE, REPORT)
    q["keyword_revenue_case_kept"] = (f"{report_cs} SELECT domain, keyword, CAST(revenue AS DOUBLE) "
                                      f"AS revenue FROM report")
    q["keyword_revenue_join"] = q["keyword_revenue"]
    q["keyword_revenue_lax"] = (f"{b} SELECT t.domain, t.keyword, CAST(sum(y.revenue) AS DOUBLE) AS revenue "
                                f"FROM first_lax_t t JOIN buyer y USING (ip) "
                                f"WHERE t.domain IS NOT NULL AND t.keyword IS NOT NULL "
                                f"GROUP BY t.domain, t.keyword")
    q["keyword_revenue_first"] = (f"{b} SELECT t.domain, t.keyword, CAST(sum(y.revenue) AS DOUBLE) AS revenue "
                                  f"FROM first_t t JOIN buyer y USING (ip) GROUP BY t.domain, t.keyword")
    q["session_counts"] = (f"{b} SELECT (SELECT count(*) FROM last_t) AS search_sessions, "
                           f"(SELECT count(*) FROM buyer) AS purchase_sessions, "
                           f"(SELECT count(*) FROM last_t JOIN buyer USING (ip)) AS attributed_sessions")
    q["report_summary"] = (f"{report} SELECT count(*) AS total_records, "
                           f"CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue, "
                           f"count(DISTINCT domain) AS unique_domains, "
                           f"count(DISTINCT keyword) AS unique_keywords FROM report")
    q["domain_revenue"] = (f"{report} SELECT domain, CAST(sum(revenue) AS DOUBLE) AS revenue "
                           f"FROM report GROUP BY domain")
    q["keyword_totals"] = (f"{report} SELECT keyword, CAST(sum(revenue) AS DOUBLE) AS revenue "
                           f"FROM report GROUP BY keyword")
    q["report_rollup"] = f"""{report}
SELECT 'domain' AS level, domain AS name, CAST(sum(revenue) AS DOUBLE) AS revenue FROM report GROUP BY domain
UNION ALL
SELECT 'keyword' AS level, keyword AS name, CAST(sum(revenue) AS DOUBLE) AS revenue FROM report GROUP BY keyword
UNION ALL
SELECT 'total' AS level, CAST(NULL AS VARCHAR) AS name, CAST(sum(revenue) AS DOUBLE) AS revenue FROM report"""
    q["top_domains"] = (f"{report} SELECT domain, CAST(sum(revenue) AS DOUBLE) AS revenue FROM report "
                        f"GROUP BY domain ORDER BY sum(revenue) DESC, domain LIMIT 5")
    q["top_keywords"] = (f"{report} SELECT keyword, CAST(sum(revenue) AS DOUBLE) AS revenue FROM report "
                         f"GROUP BY keyword ORDER BY sum(revenue) DESC, keyword LIMIT 5")
    q["report_text"] = (f'{report} SELECT domain AS "Search Engine Domain", keyword AS "Search Keyword", '
                        f'CAST(CAST(revenue AS DECIMAL(38,2)) AS VARCHAR) AS "Revenue" FROM report')
    q["report_partitioned"] = f"""{with_(HITS_CTE, enriched_cte())}
, own AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM enriched WHERE ip IS NOT NULL)
, touch AS (
  SELECT day, ip, domain, search_keyword AS keyword,
         row_number() OVER (PARTITION BY day, ip ORDER BY ts DESC, hit_id DESC) AS rn
  FROM own WHERE is_search_referral)
, spent AS (SELECT day, ip, sum(revenue) AS revenue FROM own WHERE is_purchase AND revenue > 0 GROUP BY day, ip)
, lines AS (
  SELECT DISTINCT day, ip, concat_ws(chr(9), 'Search Engine Domain', 'Search Keyword', 'Revenue') AS line FROM own
  UNION ALL
  SELECT day, ip, concat_ws(chr(9), domain, keyword, CAST(CAST(revenue AS DECIMAL(38,2)) AS VARCHAR))
  FROM touch JOIN spent USING (day, ip) WHERE rn = 1)
SELECT split_part(day, '-', 1) AS year, split_part(day, '-', 2) AS month, split_part(day, '-', 3) AS date,
       sha256('hits/' || day || '/' || ip) AS source_id, line FROM lines"""
    q["file_date_from_key"] = (f"{with_(FILES_CTE, MANIFEST_CTE)} SELECT event_seq, file_key, file_date "
                               f"FROM manifest2")
    q["file_manifest"] = (f"{with_(FILES_CTE, MANIFEST_CTE)} SELECT event_seq, file_key, file_name, "
                          f"file_date, file_size, file_size_gb, size_class FROM manifest2")
    q["status_events"] = (f"{files} SELECT event_seq, file_date, file_key, file_status, event_type, bucket, "
                          f"content_type, file_datetime, error_message, {PAYLOAD} AS payload FROM status")
    q["status_events_rejected"] = f"""{with_(FILES_CTE, MANIFEST_CTE, STATUS_CTE, RAW_EVENTS_CTE)}
SELECT event_seq, CASE
  WHEN file_key IS NULL OR file_key = '' THEN 'Missing required parameter: file_key'
  WHEN file_status IS NULL OR file_status = '' THEN 'Missing required parameter: file_status'
  WHEN event_type IS NULL OR event_type = '' THEN 'Missing required parameter: event_type'
  WHEN file_date IS NULL OR file_date = '' THEN 'Missing required parameter: file_date' END AS reject_reason
FROM raw_events
WHERE file_key IS NULL OR file_key = '' OR file_status IS NULL OR file_status = ''
   OR event_type IS NULL OR event_type = '' OR file_date IS NULL OR file_date = ''"""
    q["accepted_status_events"] = f"""{with_(FILES_CTE, MANIFEST_CTE, STATUS_CTE, RAW_EVENTS_CTE)}
SELECT event_seq, file_key, file_status, event_type, file_date FROM raw_events
WHERE file_key <> '' AND file_status <> '' AND event_type <> '' AND file_date <> ''"""
    q["file_event_log_checked"] = f"""{q["status_events_rejected"]}
UNION ALL SELECT event_seq, CAST(NULL AS VARCHAR) FROM raw_events
WHERE file_key <> '' AND file_status <> '' AND event_type <> '' AND file_date <> ''"""
    # Messages are built from the same columns, so what should be read is known without JSON.
    records = f"""{with_(FILES_CTE)}
, recs AS (
  SELECT event_seq, file_ts, raw_key, file_size, false AS second FROM files
  WHERE event_seq % 89 <> 0 AND event_seq % 97 <> 0
  UNION ALL
  SELECT event_seq, file_ts, raw_key || '.2.json', file_size + 1, true FROM files
  WHERE event_seq % 89 <> 0 AND event_seq % 97 <> 0 AND event_seq % 5 = 0)
, keyed AS (SELECT *, {decode('raw_key')} AS file_key FROM recs)"""
    q["arrival_notifications"] = f"""{records}
SELECT event_seq, file_key, {file_date('file_key')} AS file_date, file_size, {size_gb('file_size')} AS file_size_gb,
       CASE WHEN event_seq % 3 = 1 THEN 'landing-a' ELSE '{DEFAULT_BUCKET}' END AS bucket,
       CASE WHEN event_seq % 4 = 0 THEN 'text/plain' WHEN second THEN 'application/json' ELSE 'text/csv' END
         AS content_type,
       'RECEIVED' AS file_status, 'ARRIVAL' AS event_type,
       strftime(file_ts, '%Y-%m-%dT%H:%M:%S') || '.500000Z' AS file_datetime
FROM keyed"""
    q["arrival_notifications_rejected"] = f"""{with_(FILES_CTE)}
SELECT event_seq, CASE WHEN event_seq % 89 = 0 THEN 'no record' ELSE 'not JSON' END AS reject_reason
FROM files WHERE event_seq % 89 = 0 OR event_seq % 97 = 0"""
    q["completion_events"] = f"""{files}
, filled AS (
  SELECT event_seq, file_date, file_key, file_status, event_type, file_datetime,
         CASE WHEN event_seq % 3 = 1 THEN 'landing-a' ELSE bucket END AS bucket,
         CASE WHEN event_seq % 4 = 0 THEN 'text/plain' ELSE content_type END AS content_type,
         CASE WHEN file_status = 'FAILED' THEN 'code ' || CAST(event_seq AS VARCHAR) END AS error_message
  FROM status)
SELECT *, {PAYLOAD} AS payload FROM filled"""
    q["latest_file_status"] = f"""{with_(FILES_CTE, MANIFEST_CTE, STATUS_CTE, LOG_CTE)}
, ranked AS (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY file_ts DESC, event_seq DESC) AS rn,
                    count(*) OVER (PARTITION BY file_key) AS n_events FROM log)
SELECT file_key, file_status, event_type, file_datetime, n_events FROM ranked WHERE rn = 1"""
    # Queries that go through files: a blank field of a written hit reads back as null.
    q["hits_scan"] = f"""{with_(HITS_CTE)}
SELECT CAST(floor(epoch(h.ts)) AS BIGINT) AS hit_time_gmt, strftime(h.ts, '%Y-%m-%d %H:%M:%S') AS date_time,
       h.ip, nullif(h.event_list, '') AS event_list, e.event_type AS pagename, h.product_list, h.referrer
FROM hits h JOIN events e ON e.event_id = h.hit_id"""
    # A landing file: the header, and for each hit its fields with tabs between; blank text is "".
    header = len("\t".join(HIT_COLUMNS)) + 1
    q["file_listing"] = f"""{with_(HITS_CTE)}
, sized AS (
  SELECT strftime(h.ts, '%Y-%m-%d') AS day,
         CAST({header} + sum({len(HIT_COLUMNS)} + 19 + strlen(CAST(CAST(floor(epoch(h.ts)) AS BIGINT) AS VARCHAR))
              + strlen(coalesce(h.ip, '')) + CASE WHEN h.event_list = '' THEN 2 ELSE strlen(h.event_list) END
              + strlen(coalesce(e.event_type, '')) + strlen(coalesce(h.product_list, ''))
              + strlen(coalesce(h.referrer, ''))) AS BIGINT) AS file_size
  FROM hits h JOIN events e ON e.event_id = h.hit_id GROUP BY 1)
SELECT day, '{RUN_DATE}' AS file_date, file_size, {size_gb('file_size')} AS file_size_gb,
       CASE WHEN file_size < 2147483648 THEN 'small' ELSE 'large' END AS size_class, 'text/csv' AS content_type
FROM sized"""
    q["report_job"] = f"""{with_(HITS_CTE)}
SELECT strftime(ts, '%Y-%m-%d') AS day, '{RUN_DATE}' AS file_date, 'COMPLETE' AS file_status, 'SPARK' AS event_type,
       count(*) AS record_count, '{RUN_DATE}T12:05:00Z' AS file_datetime, CAST(2 AS BIGINT) AS n_events
FROM hits GROUP BY 1"""
    q["stream_file_events"] = f"""{with_(HITS_CTE)}
SELECT strftime(ts, '%Y-%m-%d') AS day, 'COMPLETE' AS file_status, count(*) AS hits,
       CAST(0 AS BIGINT) AS n_without_report FROM hits GROUP BY 1"""
    q["write_report"] = q["report_text"]
    q["file_event_log"] = (f"{files} SELECT event_seq, file_date, file_key, file_status, event_type, bucket, "
                           f"content_type, file_datetime, error_message FROM status")
    q["stream_keyword_revenue"] = f"""{with_(HITS_CTE, enriched_cte())}
, daily AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM enriched WHERE ip IS NOT NULL)
, touch AS (
  SELECT day, ip, domain, search_keyword AS keyword,
         row_number() OVER (PARTITION BY day, ip ORDER BY floor(epoch(ts)) DESC, domain DESC,
                            search_keyword DESC) AS rn
  FROM daily WHERE is_search_referral)
, spent AS (SELECT day, ip, sum(revenue) AS revenue FROM daily WHERE is_purchase AND revenue > 0
            GROUP BY day, ip)
SELECT day, domain, keyword, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM touch JOIN spent USING (day, ip) WHERE rn = 1 GROUP BY day, domain, keyword"""
    return q
