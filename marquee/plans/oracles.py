"""The same answers as `catalog`, in plain SQL over the same tables."""

from __future__ import annotations

# --- Shared parts ------------------------------------------------------------------------------

EVENTS = """
E AS (
  SELECT event_id, ts, value, 'src' || (user_id % 20) AS source_id,
    trim(regexp_replace(lower('  ' || upper(event_type) || ' \t Night '), '\\s+', ' ', 'g')) AS title_n,
    '  ' || upper(event_type) || ' \t Night ' AS title,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS start,
    strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' AS bucket,
    date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day,
    'venue ' || user_id AS venue, 'city ' || (user_id % 7) AS city
  FROM events),
K AS (
  SELECT *, sha1(title_n || '|' || bucket || '|' || venue || '|' || city || '|' || source_id)
      AS dedup_key,
    title_n || '|' || venue || '|' || city || '|' || source_id AS ident
  FROM E)"""


def greedy(rows: str, order: str) -> str:
    """Keep rows in arrival order: a walk over each identity with the list of kept days."""
    return f"""
F AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY {order}) AS copy FROM {rows}),
R AS (SELECT *, row_number() OVER (PARTITION BY ident ORDER BY {order}) AS r FROM F WHERE copy = 1),
G AS (
  SELECT ident, r, dedup_key, [day] AS kept, true AS keep FROM R WHERE r = 1
  UNION ALL
  SELECT R.ident, R.r, R.dedup_key,
    CASE WHEN list_contains(G.kept, R.day - 1) OR list_contains(G.kept, R.day + 1) THEN G.kept
         ELSE list_append(G.kept, R.day) END,
    NOT (list_contains(G.kept, R.day - 1) OR list_contains(G.kept, R.day + 1))
  FROM G JOIN R ON R.ident = G.ident AND R.r = G.r + 1),
KEPT AS (SELECT R.* FROM R JOIN G ON R.dedup_key = G.dedup_key WHERE G.keep)"""


CUSTOMERS = """
C AS (
  SELECT c_custkey,
    CASE c_custkey % 3 WHEN 0 THEN 'events' WHEN 1 THEN 'festivals' ELSE 'sports' END AS entity_type,
    'src' || (c_custkey % 5) AS source_id,
    CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS title,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS sport_type,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '2024-05-01T10:00:00+00:00' END AS start,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE '2024-05-01T12:00:00+00:00' END AS finish,
    CASE WHEN c_custkey % 23 = 0 THEN '' ELSE 'UTC' END AS timezone,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'hall ' || c_nationkey END AS venue_name,
    'city ' || c_nationkey AS city,
    CASE WHEN c_custkey % 13 = 0 THEN 'usa' ELSE 'US' END AS country,
    c_custkey % 6 = 0 AS no_slots,
    CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS price_text,
    c_custkey % 29 = 0 AS bad_images
  FROM customer),
V AS (
  SELECT *, list_filter([
      CASE WHEN dated AND start IS NULL THEN '$: ''start'' is a required property' END,
      CASE WHEN dated AND finish IS NULL THEN '$: ''end'' is a required property' END,
      CASE WHEN NOT dated AND sport_type IS NULL
        THEN '$: ''sport_type'' is a required property' END,
      CASE WHEN NOT dated AND no_slots THEN '$: ''time_slots'' is a required property' END,
      CASE WHEN venue_name IS NULL THEN '$: ''venue_name'' is a required property' END,
      CASE WHEN entity_type = 'events' AND no_slots
        THEN '$: ''time_slots'' is a required property' END,
      CASE WHEN title = '' THEN '$.title: '''' should be non-empty' END,
      CASE WHEN dated AND timezone = '' THEN '$.timezone: '''' should be non-empty' END,
      CASE WHEN country = 'usa' THEN '$.country: ''usa'' does not match ''^[A-Z]{2}$''' END,
      CASE WHEN bad_images THEN '$.images: value is not of type ''array''' END
    ], lambda x: x IS NOT NULL) AS reasons
  FROM (SELECT *, entity_type <> 'sports' AS dated FROM C))"""

ORDERS = """
O AS (
  SELECT o_orderkey, o_custkey, o_orderkey % 6 AS kind,
    strftime(o_orderdate, '%Y-%m-%d') AS day,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day,
    o_orderpriority, c_name, c_mktsegment, n_name, 'src' || (o_custkey % 50) AS source_id,
    CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price,
    CASE WHEN o_orderkey % 13 = 0 THEN 'USA' ELSE 'US' END AS country,
    CASE WHEN o_orderkey % 11 = 0 THEN 'sports' WHEN o_orderkey % 6 = 2 THEN 'festivals'
         WHEN o_orderkey % 6 = 3 THEN 'sports' ELSE 'events' END AS entity_type
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
J AS (
  SELECT * FROM O WHERE kind <> 4 AND entity_type =
    CASE kind WHEN 2 THEN 'festivals' WHEN 3 THEN 'sports' ELSE 'events' END)"""

# Listings of the order pages after normalising: JSON-LD (origin 0) and list items (origin 1).
LISTINGS = (
    ORDERS
    + """,
L AS (
  SELECT o_orderkey, 0 AS origin, entity_type, source_id, 'Show ' || o_orderpriority AS title,
    CASE WHEN kind = 3 THEN c_mktsegment END AS sport_type,
    CASE WHEN kind <> 5 THEN day || 'T18:00:00-05:00' END AS start,
    CASE WHEN kind <> 5 THEN day || 'T20:00:00-05:00' END AS finish,
    CASE WHEN kind <> 5 THEN CAST(day AS DATE) END AS held_on,
    c_name AS venue_name, c_mktsegment || ' St' AS address, n_name AS city, country,
    CASE WHEN kind <> 5 THEN price END AS price_text,
    'https://shows.example.com/' AS url, true AS has_slots
  FROM J
  UNION ALL
  SELECT o_orderkey, 1, entity_type, source_id, 'Show' || o_orderpriority, NULL,
    next_day || 'T18:00:00-05:00', next_day || 'T20:00:00-05:00', CAST(next_day AS DATE),
    c_name, c_mktsegment || ' St', n_name, country, 'from ' || price, NULL, false
  FROM O),
P AS (
  SELECT *, country = 'USA' OR (entity_type = 'sports' AND sport_type IS NULL)
    OR (entity_type <> 'sports' AND start IS NULL) AS bad,
    CASE WHEN entity_type <> 'sports' THEN start END AS pruned_start
  FROM L),
A AS (
  SELECT *, o_orderkey * 2 + origin AS seq,
    lower(title) || '|' || coalesce(substr(pruned_start, 1, 10) || 'T00:00:00-05:00',
      '1970-01-01T00:00:00+00:00') || '|' || lower(venue_name) || '|' || lower(city) || '|'
      || source_id AS dedup_key,
    lower(title) || '|' || (pruned_start IS NULL) || '|' || lower(venue_name) || '|' || lower(city)
      || '|' || source_id AS ident,
    CASE WHEN pruned_start IS NULL THEN 0 ELSE date_diff('day', DATE '1970-01-01', held_on) END AS day
  FROM P WHERE NOT bad)"""
)

REGISTRY = """
S AS (
  SELECT s_suppkey AS row_no, 'src' || s_suppkey AS source_id,
    'https://h' || s_suppkey || '.example.com/' AS base_url,
    CASE s_suppkey % 5 WHEN 0 THEN 'events' WHEN 1 THEN 'festivals' WHEN 2 THEN 'sports'
      WHEN 3 THEN 'events' ELSE 'music' END AS type,
    s_suppkey % 7 = 0 AS bad_country, s_suppkey % 11 = 0 AS bad_freq,
    s_suppkey % 13 = 0 AS zero_qps, s_suppkey % 13 <> 0 AND s_suppkey % 17 = 0 AS text_qps,
    s_suppkey % 13 <> 0 AND s_suppkey % 17 <> 0 AND s_suppkey % 19 = 0 AS no_qps,
    s_suppkey % 3 <> 0 AS enabled, 'rules/' || s_nationkey || '.yaml' AS rule_path
  FROM supplier),
RP AS (SELECT DISTINCT 'rules/' || n_nationkey || '.yaml' AS path FROM nation WHERE n_regionkey <> 3),
B AS (
  SELECT *, array_to_string(list_filter([
      CASE WHEN type = 'music' THEN 'type: not one of events, festivals, sports' END,
      CASE WHEN bad_country THEN 'country: not two capital letters' END,
      CASE WHEN bad_freq THEN 'crawl_freq: not one of daily, weekly, monthly' END,
      CASE WHEN text_qps THEN 'max_qps: not a number' END,
      CASE WHEN zero_qps THEN 'max_qps: not greater than 0' END,
      CASE WHEN enabled AND rule_path NOT IN (SELECT path FROM RP)
        THEN 'css_rules_path: no such rule: ' || rule_path END
    ], lambda x: x IS NOT NULL), '; ') AS errors
  FROM S)"""

STATE = """
KNOWN AS (
  SELECT url, CASE WHEN page_id % 2 = 0 THEN 'e' || (page_id % 5) ELSE '' END AS etag,
    'day 1' AS last_modified, '100' AS last_seen
  FROM pages WHERE url LIKE '%/en/%' OR url LIKE '%/fr/%'),
REPLY AS (
  SELECT page_id, url, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'e' || (page_id % 5) END AS etag,
    CASE WHEN page_id % 3 = 0 THEN '' ELSE 'day ' || (page_id % 2) END AS last_modified,
    CASE WHEN page_id % 10 = 9 THEN 304 ELSE 200 END AS status
  FROM pages),
SEEN AS (
  SELECT p.*, k.etag AS old_etag, k.last_modified AS old_modified, k.url IS NOT NULL AS known,
    p.status = 304 OR coalesce(
      nullif(p.etag, '') = nullif(k.etag, ''),
      nullif(p.last_modified, '') = nullif(k.last_modified, ''), false) AS unchanged
  FROM REPLY p LEFT JOIN KNOWN k ON p.url = k.url)"""

# Unicode digits and white space, as the library counts them.
_DIGIT = "\\p{Nd}"
_SPACE = (
    "\\t-\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
    "\\x{205f}\\x{3000}"
)

MENU_LINKS = """
N AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+://[^/]+)/', 1) AS site,
    regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1) AS hrefs
  FROM pages),
M AS (
  SELECT page_id, url,
    list_transform((list_concat([hrefs[1]], hrefs))[1:3], lambda h: site || h) AS links
  FROM N WHERE len(hrefs) > 0)"""

_BATCHES = (
    EVENTS
    + """,
X AS (
  SELECT *, CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS price_text,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'u' || event_id END AS url,
    '[{"start":"' || start || '","end":"' || start || '"}]' AS time_slots_json,
    CASE WHEN event_id % 2 = 0 THEN '["' || source_id || '"]' ELSE '[]' END AS taxonomy_json
  FROM K)
SELECT 'events' AS entity_type, dedup_key, arg_min(title, event_id) AS title,
  arg_min(source_id, event_id) AS source_id,
  arg_max(start, event_id) AS start, arg_max(price_text, event_id) AS price_text,
  arg_max(value, event_id) AS price_value,
  CASE WHEN max(event_id) % 3 = 0 THEN NULL ELSE 'u' || max(event_id) END AS url,
  arg_min(time_slots_json, event_id) AS time_slots_json,
  arg_max(taxonomy_json, event_id) AS taxonomy_json, '[]' AS emails_json
FROM X GROUP BY dedup_key"""
)

# Every fiftieth event has no date; its key is that of the first day of 1970 and compares with itself.
_SOME_UNDATED = EVENTS.replace(
    "strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' AS bucket",
    "CASE WHEN event_id % 50 = 0 THEN '1970-01-01' ELSE strftime(ts, '%Y-%m-%d') END"
    " || 'T00:00:00+00:00' AS bucket",
).replace(
    "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day",
    "CASE WHEN event_id % 50 = 0 THEN 0 ELSE date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) END AS day",
)

_KEPT_EVENTS = f"WITH RECURSIVE {EVENTS},{greedy('K', 'event_id')}"
_KEPT_LISTINGS = f"WITH RECURSIVE {LISTINGS},{greedy('A', 'seq')}"

_ORDER_COUNTERS = f"""{_KEPT_LISTINGS}
SELECT u.counter, CAST(u.value AS BIGINT) AS value FROM (
  SELECT 'pages_fetched' AS counter, (SELECT count(*) FROM O) AS value
  UNION ALL SELECT 'http_2xx', (SELECT count(*) FROM O)
  UNION ALL SELECT 'http_3xx', 0 UNION ALL SELECT 'http_4xx', 0 UNION ALL SELECT 'http_5xx', 0
  UNION ALL SELECT 'retries', 0 UNION ALL SELECT 'unchanged_skips', 0
  UNION ALL SELECT 'parse_failures', 0 UNION ALL SELECT 'entities_updated', 0
  UNION ALL SELECT 'validates_failed', (SELECT count(*) FROM P WHERE bad)
  UNION ALL SELECT 'quarantine_rows', (SELECT count(*) FROM P WHERE bad)
  UNION ALL SELECT 'entities_new', (SELECT count(*) FROM KEPT)
  UNION ALL SELECT 'duplicates', (SELECT count(*) FROM A) - (SELECT count(*) FROM KEPT)) u"""

ORACLES: dict[str, str] = {
    "entity_key": f"WITH {EVENTS} SELECT event_id, dedup_key, bucket, title_n AS title FROM K",
    "near_keys": f"""WITH {EVENTS}
SELECT event_id,
  sha1(title_n || '|' || strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00+00:00|' || venue
    || '|' || city || '|' || source_id) AS key_before,
  sha1(title_n || '|' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00+00:00|' || venue
    || '|' || city || '|' || source_id) AS key_after
FROM K""",
    "exact_dedup": f"""WITH {EVENTS}
SELECT min(event_id) AS event_id, dedup_key FROM K GROUP BY dedup_key""",
    "near_dedup": f"{_KEPT_EVENTS} SELECT event_id, dedup_key FROM KEPT",
    "near_dedup_any_order": f"""WITH RECURSIVE {EVENTS},
Q AS (SELECT *, (event_id * 7919 + 13) % 1000003 AS seq FROM K),{greedy("Q", "seq, event_id")}
SELECT event_id, dedup_key FROM KEPT""",
    "near_dedup_incremental": f"{_KEPT_EVENTS} SELECT event_id FROM KEPT",
    "duplicate_counts": f"""{_KEPT_EVENTS},
T AS (SELECT source_id, count(*) AS rows_seen FROM K GROUP BY source_id),
W AS (SELECT source_id, count(*) AS rows_new FROM KEPT GROUP BY source_id)
SELECT T.source_id, rows_seen, coalesce(rows_new, 0) AS rows_new,
  rows_seen - coalesce(rows_new, 0) AS duplicates
FROM T LEFT JOIN W ON T.source_id = W.source_id""",
    "contacts_emails": """
SELECT doc_id, array_to_string(found, ',') AS emails, CAST(len(found) AS BIGINT) AS n FROM (
  SELECT doc_id, list_sort(list_distinct(list_transform(
    regexp_extract_all(text, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}'), lambda x: lower(x)))) AS found
  FROM documents)""",
    "contacts_phones": f"""
SELECT doc_id, array_to_string(found, ',') AS phones, CAST(len(found) AS BIGINT) AS n FROM (
  SELECT doc_id, list_sort(list_distinct(list_transform(
    regexp_extract_all(text, '[+{_DIGIT}][{_DIGIT}\\-().{_SPACE}]{{4,}}'),
    lambda x: regexp_replace(x, '[^+{_DIGIT}]', '', 'g')))) AS found
  FROM documents)""",
    "price_value": f"""
SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '({_DIGIT}+)(?:[.,]({_DIGIT}{{2}}))?', 1), '') AS DOUBLE)
  + coalesce(TRY_CAST(nullif(regexp_extract(text, '({_DIGIT}+)(?:[.,]({_DIGIT}{{2}}))?', 2), '') AS DOUBLE), 0)
    / 100 AS price_value
FROM documents""",
    "taxonomy": """
SELECT doc_id, array_to_string(list_filter([
    CASE WHEN contains(lower(text), 'jazz') THEN 'music' END,
    CASE WHEN contains(lower(text), 'art') THEN 'art' END,
    CASE WHEN contains(lower(text), 'football') THEN 'football' END,
    CASE WHEN contains(lower(text), 'running') THEN 'running' END
  ], lambda x: x IS NOT NULL), ',') AS labels
FROM documents""",
    "taxonomy_map": """
SELECT p_partkey, array_to_string(list_filter([
    CASE WHEN contains(p_name, 'ring') THEN 'jewellery' END,
    CASE WHEN contains(p_name, 'bolt') OR contains(p_name, 'widget') THEN 'hardware' END,
    lower(p_type)], lambda x: x IS NOT NULL), ',') AS labels
FROM part""",
    "datetime_norm": """
WITH D AS (
  SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS d,
    CASE o_orderkey % 7 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Kolkata'
      WHEN 2 THEN 'Europe/Berlin' WHEN 3 THEN 'UTC-04:00' WHEN 4 THEN 'Nowhere/Else'
      WHEN 5 THEN '' END AS hint,
    o_orderkey % 5 AS form
  FROM orders),
T AS (
  SELECT o_orderkey, hint, form,
    CASE form WHEN 0 THEN d WHEN 1 THEN d + INTERVAL '9 hours 30 minutes'
      WHEN 2 THEN d + INTERVAL '23 hours 15 minutes 10 seconds 250 milliseconds'
      WHEN 3 THEN d + INTERVAL '22 hours' ELSE d + INTERVAL '1 hours 30 minutes' END AS s,
    CASE form WHEN 3 THEN 0 WHEN 4 THEN 19800 END AS s_off,
    d + INTERVAL 1 DAY AS e, CAST(NULL AS INTEGER) AS e_off,
    CASE WHEN hint IS NOT NULL THEN hint WHEN form = 4 THEN 'UTC+05:30' ELSE 'UTC' END AS zone
  FROM D),
U AS (
  SELECT o_orderkey, zone, form, 'start' AS part, s AS local, s_off AS off, coalesce(hint, '') AS z FROM T
  UNION ALL SELECT o_orderkey, zone, form, 'finish', e, e_off, zone FROM T),
I AS (
  SELECT *, CASE WHEN z LIKE '%/%' AND z <> 'Nowhere/Else' THEN z END AS named,
    CASE z WHEN 'UTC-04:00' THEN -14400 WHEN 'UTC+05:30' THEN 19800 WHEN 'UTC' THEN 0 END AS fixed
  FROM U),
W AS (
  SELECT *,
    CASE WHEN off IS NOT NULL THEN epoch(local) - off
      WHEN named IS NOT NULL THEN epoch(timezone(named, local))
      ELSE epoch(local) - coalesce(fixed, 0) END AS instant
  FROM I),
Z AS (
  SELECT *,
    CASE WHEN named IS NOT NULL AND off IS NOT NULL
        THEN timezone(named, to_timestamp(instant))
      WHEN fixed IS NOT NULL AND off IS NOT NULL
        THEN local + to_seconds(CAST(fixed - off AS BIGINT))
      ELSE local END AS shown
  FROM W),
Y AS (SELECT *, CAST(round(epoch(shown) - instant) AS BIGINT) AS secs FROM Z),
TXT AS (
  SELECT o_orderkey, zone, part,
    strftime(shown, '%Y-%m-%dT%H:%M:%S') || CASE WHEN form = 2 AND part = 'start' THEN '.250000' ELSE '' END
      || CASE WHEN secs < 0 THEN '-' ELSE '+' END
      || lpad(CAST(abs(secs) // 3600 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(abs(secs) % 3600 // 60 AS VARCHAR), 2, '0') AS iso
  FROM Y)
SELECT o_orderkey, max(CASE WHEN part = 'start' THEN iso END) AS start,
  max(CASE WHEN part = 'finish' THEN iso END) AS finish, max(zone) AS timezone,
  CAST(0 AS BIGINT) AS slots, CAST(0 AS BIGINT) AS errors
FROM TXT GROUP BY o_orderkey""",
    "slots": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN l_linestatus
    ELSE l_returnflag END AS slot_start,
  CASE l_linenumber % 3 WHEN 0 THEN l_returnflag || '|x' WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
    ELSE l_returnflag END AS slot_end
FROM lineitem""",
    "since_until": """
SELECT event_id, 'src' || (user_id % 20) AS source_id FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 02:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "validate_rows": f"""WITH {CUSTOMERS}
SELECT c_custkey, CAST(len(reasons) AS BIGINT) AS n, array_to_string(reasons, '; ') AS reasons FROM V""",
    "accepted_rows": f"""WITH {CUSTOMERS}
SELECT c_custkey, entity_type, title, CASE WHEN NOT dated THEN sport_type END AS sport_type,
  CASE WHEN dated THEN start END AS start, timezone
FROM V WHERE len(reasons) = 0""",
    "reject_reasons": f"""WITH {CUSTOMERS},
R AS (SELECT unnest(reasons) AS reason FROM V)
SELECT reason, count(*) AS rejects FROM R GROUP BY reason""",
    "inspect_rejects": f"""WITH {CUSTOMERS},
R AS (SELECT unnest(reasons) AS reason FROM V WHERE source_id = 'src1' AND c_custkey % 20 <= 7)
SELECT reason, count(*) AS rejects FROM R GROUP BY reason""",
    "csv_columns": f"""WITH {CUSTOMERS},
OK AS (SELECT *, CASE WHEN NOT dated THEN sport_type END AS sport,
  CASE WHEN dated THEN start END AS begins, CASE WHEN dated THEN finish END AS ends
  FROM V WHERE len(reasons) = 0),
W AS (
  SELECT entity_type, unnest(['source_id', 'title', 'sport_type', 'start', 'end', 'timezone',
      'venue_name', 'address', 'city', 'country', 'time_slots', 'price_text', 'price_value', 'url',
      'emails', 'phones', 'images', 'taxonomy']) AS "column",
    unnest([n, n, count_sport, count_start, count_end, n, n, n, n, n, count_slots, n, n, n, n, n, n, n])
      AS filled
  FROM (SELECT entity_type, count(*) AS n, count(sport) AS count_sport,
      count(begins) AS count_start, count(ends) AS count_end,
      count(*) FILTER (WHERE NOT no_slots) AS count_slots
    FROM OK GROUP BY entity_type))
SELECT entity_type, "column", filled FROM W WHERE filled > 0""",
    "jsonld_extract": f"""WITH {ORDERS}
SELECT o_orderkey, entity_type, 'Show ' || o_orderpriority AS title,
  CASE WHEN entity_type = 'sports' THEN c_mktsegment END AS sport_type,
  CASE WHEN kind <> 5 THEN day || 'T18:00:00-05:00' END AS start,
  CASE WHEN kind <> 5 THEN day || 'T20:00:00-05:00' END AS finish,
  c_name AS venue_name, c_mktsegment || ' St' AS address, n_name AS city, country,
  CASE WHEN kind <> 5 THEN price END AS price_text, 'https://shows.example.com/' AS url,
  'https://img.example.com/' || o_orderkey AS images,
  CASE WHEN kind <> 5 THEN day || 'T18:00:00-05:00/' || day || 'T20:00:00-05:00'
    ELSE day || 'T21:00:00-05:00/' || day || 'T22:00:00-05:00' END AS slots
FROM J""",
    "rule_extract": """
WITH N AS (
  SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1) AS nav FROM pages),
A AS (
  SELECT page_id, regexp_extract_all(nav, '<a href="([^"]*)"', 1) AS hrefs,
    regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1) AS names FROM N),
U AS (
  SELECT page_id, unnest(hrefs) AS url, unnest(names) AS title,
    unnest(range(len(hrefs))) AS item FROM A)
SELECT page_id, CAST(item AS BIGINT) AS item, nullif(trim(title), '') AS title,
  nullif(trim(url), '') AS url, 'UTC' AS timezone
FROM U""",
    "page_title": """
SELECT page_id, nullif(trim(replace(replace(replace(replace(
  regexp_extract(html, '<h1>(.*?)</h1>', 1), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'),
  '&amp;', '&')), '') AS title
FROM pages""",
    "extract_both": f"""WITH {LISTINGS}
SELECT entity_type, CAST(origin AS BIGINT) AS origin, count(*) AS entities,
  count(DISTINCT title) AS titles
FROM L GROUP BY entity_type, origin""",
    "link_frontier": f"""WITH {MENU_LINKS},
U AS (SELECT page_id, unnest(links) AS url, unnest(range(1, len(links) + 1)) AS page_idx FROM M)
SELECT page_id, CAST(page_idx AS BIGINT) AS page_idx, url FROM U""",
    "urlset_hash": f"""WITH {MENU_LINKS}
SELECT page_id, sha1(array_to_string(list_sort(list_concat([url], links)), '|')) AS urls_hash FROM M""",
    "rule_expressions": """
SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN '.' || replace(p_name, ' ', ' .') WHEN 1 THEN '.' || p_type
    WHEN 2 THEN 'img.' || p_type WHEN 3 THEN 'a > b' ELSE 'time.' || p_size END AS selector,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'href' WHEN 2 THEN 'src' WHEN 3 THEN p_type
    ELSE 'datetime' END AS attr,
  p_partkey % 6 IN (2, 5) AS multi, p_partkey % 6 IN (4, 5) AS text_fallback
FROM part""",
    "snapshots": """
WITH T AS (SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id * 7) AS t FROM pages)
SELECT page_id, sha256(url) AS url_hash, strftime(t, '%Y%m%dT%H%M%S') AS snapshot,
  strftime(t, '%Y-%m-%d') AS fetch_date
FROM T""",
    "latest_state": """
SELECT url, CASE WHEN page_id % 2 = 0 THEN 'e' || (page_id % 5) ELSE '' END AS etag,
  'day 1' AS last_modified, '100' AS last_seen
FROM pages""",
    "changed_pages": f"WITH {STATE} SELECT page_id, url FROM SEEN WHERE NOT unchanged",
    "next_state": f"""WITH {STATE}
SELECT url,
  coalesce(nullif(etag, ''), CASE WHEN unchanged THEN nullif(old_etag, '') END, '') AS etag,
  coalesce(nullif(last_modified, ''), CASE WHEN unchanged THEN old_modified END, '') AS last_modified,
  '200' AS last_seen
FROM SEEN""",
    "conditional_headers": f"""WITH {STATE}
SELECT url, nullif(old_etag, '') AS if_none_match, old_modified AS if_modified_since FROM SEEN""",
    "resume": """
WITH T AS (SELECT page_id, url, regexp_extract(url, '://([^/]+)', 1) AS host FROM pages)
SELECT page_id, url FROM T WHERE NOT (url LIKE '%/en/%' AND length(host) % 4 <> 0)""",
    "robots_filter": """
WITH U AS (
  SELECT page_id, url, length(regexp_extract(url, '://([^/?#]+)', 1)) % 3 AS kind,
    regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path
  FROM pages),
RULES(kind, rule_no, prefix, allow) AS (
  VALUES (0, 1, '/fr', false), (0, 2, '/en/1', false), (0, 3, '/en', true), (0, 4, '/e', false),
    (1, 1, '/de/', true), (1, 2, '/', false)),
V AS (
  SELECT page_id, url, arg_min(allow, rule_no) AS allow
  FROM U LEFT JOIN RULES ON U.kind = RULES.kind AND starts_with(path, prefix)
  GROUP BY page_id, url)
SELECT page_id, url FROM V WHERE coalesce(allow, true)""",
    "url_explain": """
WITH B AS (
  SELECT base_url, min(row_no) AS row_no FROM (
    SELECT regexp_extract(url, '^([a-z]+://[^/]+/)', 1) AS base_url, 2 * page_id + 1 AS row_no FROM pages
    UNION ALL
    SELECT regexp_extract(url, '^([a-z]+://[^/]+/[a-z]+)', 1), 2 * page_id FROM pages)
  GROUP BY base_url),
U AS (SELECT url FROM pages UNION ALL SELECT 'x' || url FROM pages),
M AS (SELECT url, min(row_no) AS row_no FROM U LEFT JOIN B ON starts_with(url, base_url) GROUP BY url)
SELECT url, row_no IS NOT NULL AS matched, 's' || row_no AS source_id,
  CASE WHEN row_no IS NOT NULL THEN 'r.yaml' END AS rules_path,
  CASE WHEN row_no IS NOT NULL THEN true END AS robots_ok
FROM M""",
    "upsert_gold": f"WITH {_BATCHES}",
    "gold_table": f"WITH {_BATCHES}",
    "merge_promote": """
WITH V AS (
  SELECT user_id, event_id, CASE WHEN value < 50 THEN '' ELSE event_type END AS title,
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS tags,
    CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price
  FROM events),
ENDS AS (SELECT user_id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY user_id),
P AS (
  SELECT o.user_id, o.title AS t0, o.tags AS g0, o.price AS p0, n.title AS t1, n.tags AS g1,
    n.price AS p1
  FROM ENDS JOIN V o ON o.event_id = a JOIN V n ON n.event_id = b)
SELECT user_id, CASE WHEN t1 = '' THEN t0 ELSE t1 END AS title,
  CASE WHEN g1 = '' THEN g0 ELSE g1 END AS tags, coalesce(p1, p0) AS price,
  (t1 <> '' AND t1 <> t0) OR (g1 <> '' AND g1 <> g0)
    OR (p1 IS NOT NULL AND p1 IS DISTINCT FROM p0) AS mutated
FROM P""",
    "registry_validate": f"""WITH {REGISTRY}
SELECT source_id, errors = '' AS ok,
  CASE WHEN errors <> '' THEN errors WHEN enabled THEN 'ok' ELSE 'disabled' END AS detail
FROM B""",
    "registry_report": f"""WITH {REGISTRY},
T AS (
  SELECT CASE WHEN errors <> '' THEN 'FAIL' WHEN enabled THEN 'OK' ELSE 'DISABLED' END AS status,
    CASE WHEN errors <> '' THEN errors WHEN enabled THEN '' ELSE 'disabled' END AS detail
  FROM B)
SELECT status, count(*) AS sources, count(DISTINCT detail) AS details FROM T GROUP BY status""",
    "select_sources": f"""WITH {REGISTRY}
SELECT row_no, source_id, type AS entity_type, base_url AS url, rule_path,
  CASE WHEN zero_qps THEN 0.0::DOUBLE WHEN text_qps THEN NULL WHEN no_qps THEN 1.0::DOUBLE
    ELSE 2.5::DOUBLE END AS max_qps
FROM S WHERE enabled AND type = 'events' ORDER BY row_no LIMIT 25""",
    "status_latest": f"""WITH {REGISTRY},
T AS (
  SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%d') || 'T000000' AS month,
    'src' || (o_custkey % 400) AS source_id, count(*) AS rows_new,
    count(*) FILTER (WHERE o_orderstatus = 'O') AS rows_updated,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS rejects
  FROM orders GROUP BY 1, 2),
L AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY month DESC) AS rn FROM T)
SELECT S.source_id, coalesce(rows_new, 0) AS rows_new, coalesce(rows_updated, 0) AS rows_updated,
  coalesce(rejects, 0) AS rejects, 'run-' || month AS last_run
FROM S LEFT JOIN L ON S.source_id = L.source_id AND L.rn = 1""",
    "source_stats": """
SELECT 'src' || (user_id % 20) AS source_id, count(*) FILTER (WHERE event_type = 'click') AS rows_new,
  count(*) FILTER (WHERE event_type = 'view') AS rows_updated,
  count(*) FILTER (WHERE event_type = 'error') AS rejects
FROM events GROUP BY 1""",
    "counts_by_type": f"""WITH {CUSTOMERS}
SELECT entity_type, count(*) AS rows FROM C GROUP BY entity_type""",
    "counters": """
WITH D(counter) AS (VALUES ('pages_fetched'), ('http_2xx'), ('http_3xx'), ('http_4xx'), ('http_5xx'),
  ('retries'), ('unchanged_skips'), ('parse_failures'), ('validates_failed'), ('entities_new'),
  ('entities_updated'), ('quarantine_rows'), ('duplicates'), ('run_duration_ms'), ('robots_disallow')),
T AS (
  SELECT CASE event_type WHEN 'click' THEN 'entities_new' WHEN 'view' THEN 'duplicates'
      WHEN 'error' THEN 'validates_failed' WHEN 'signup' THEN 'retries' ELSE 'robots_disallow' END
      AS counter, count(*) AS value
  FROM events GROUP BY 1)
SELECT D.counter, coalesce(T.value, 0) AS value FROM D LEFT JOIN T ON D.counter = T.counter""",
    "http_classes": """
SELECT 'http_' || ((100 + event_id * 37 % 500) // 100) || 'xx' AS counter, count(*) AS value
FROM events GROUP BY 1""",
    "run_partition": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS run_date FROM orders",
    "listing_pipeline": f"""{_KEPT_LISTINGS}
SELECT source_id, count(*) FILTER (WHERE what = 'new') AS rows_new, CAST(0 AS BIGINT) AS rows_updated,
  count(*) FILTER (WHERE what = 'rejected') AS rejects
FROM (SELECT source_id, 'new' AS what FROM KEPT
      UNION ALL SELECT source_id, 'rejected' FROM P WHERE bad)
GROUP BY source_id""",
    "full_run": _ORDER_COUNTERS,
    "full_run_silver": f"""{_KEPT_LISTINGS}
SELECT entity_type, source_id, title, CASE WHEN entity_type = 'sports' THEN sport_type END AS sport_type,
  pruned_start AS start, CASE WHEN entity_type = 'sports' AND start IS NULL THEN NULL
    ELSE 'UTC-05:00' END AS timezone,
  venue_name, price_text, CAST(replace(price_text, 'from ', '') AS DOUBLE) AS price_value, url
FROM KEPT""",
    "silver_sink": f"""WITH {EVENTS}
SELECT title, start, source_id, 'US' AS country, 'events' AS entity_type, 'run-20240131' AS run_id FROM E""",
    "csv_sink": f"""WITH {CUSTOMERS}
SELECT entity_type, title, CASE WHEN entity_type <> 'sports' THEN start END AS start, city, price_text,
  '["c' || c_custkey || '@example.com"]' AS emails, '["x.jpg"]' AS images,
  CASE WHEN no_slots THEN NULL ELSE '[{{"start":"2024-05-01","end":"2024-05-02"}}]' END AS time_slots
FROM V WHERE len(reasons) = 0""",
    "quarantine_sink": f"""WITH {CUSTOMERS}
SELECT source_id, title, start, country, array_to_string(reasons, '; ') AS reasons
FROM V WHERE len(reasons) > 0""",
    "bronze_sink": """
SELECT sha256(url) AS url_hash,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id * 7), '%Y%m%dT%H%M%S') AS snapshot,
  sha256(html) AS html_hash, CAST(page_id AS VARCHAR) AS page_id
FROM pages""",
    "stream_near_dedup": f"{_KEPT_EVENTS} SELECT event_id, dedup_key FROM KEPT",
    "stream_stateful_dedup": f"""WITH RECURSIVE {_SOME_UNDATED},{greedy("K", "event_id % 3, event_id")}
SELECT dedup_key, source_id FROM KEPT""",
}
