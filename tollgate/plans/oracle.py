"""SQL twins of the registered queries, for an independent engine (DuckDB).

``REQUESTS`` reproduces ``tollgate.sources.requests.requests_from_events`` in
plain SQL over the ``events`` view; every oracle starts from it.
"""

from __future__ import annotations

from tollgate.sources import dimensions as dim
from tollgate.sources.requests import ASSET_URLS, FORM_CONTENT_TYPE, HOST


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_match_sql(col: str, patterns: list[str]) -> str:
    if not patterns:
        return "FALSE"
    alt = "|".join(f"(?:{p})" for p in patterns)
    return f"regexp_full_match({col}, {sql_str(alt)})"


REQUESTS = f"""
requests_base AS (
  SELECT event_id, date_trunc('second', ts) AS ts, user_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'query'
              WHEN 'purchase' THEN 'book' WHEN 'signup' THEN 'pay' ELSE 'asset' END AS step,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
requests_pre AS (
  SELECT *,
    'C' || CAST(k % 6 AS VARCHAR) AS dep,
    'C' || CAST((k + user_id) % 6 AS VARCHAR) AS arr,
    (k % 3 = 0) AS intl,
    (k % 2 = 1) AS round_trip,
    strftime(CAST(ts AS DATE) + CAST(k % 20 AS INTEGER), '%Y-%m-%d') AS d1,
    strftime(CAST(ts AS DATE) + CAST(k % 20 + 3 AS INTEGER), '%Y-%m-%d') AS d2,
    strftime(CAST(ts AS DATE) + CAST(k % 20 AS INTEGER), '%Y%m%d') AS fdate,
    'S' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 5 AS VARCHAR) AS session_id,
    CASE WHEN step IN ('book', 'pay') THEN 'POST' ELSE 'GET' END AS request_method
  FROM requests_base
),
requests_url AS (
  SELECT *,
    'c1=' || dep || '&c2=' || arr || '&d1=' || d1 AS qs,
    CASE step
      WHEN 'view' THEN '/shop/modules/main/flightSelect.html?k=' || CAST(k AS VARCHAR)
      WHEN 'query' THEN (CASE WHEN intl THEN '/shop/query/jaxb/inter/query.ao?'
                              ELSE '/shop/query/jaxb/direct/query.ao?' END)
                        || 'c1=' || dep || '&c2=' || arr || '&d1=' || d1
      WHEN 'book' THEN CASE WHEN intl THEN '/shop/book/inter/order.ao' ELSE '/shop/book/direct/order.ao' END
      WHEN 'pay' THEN '/shop/pay/submit.ao'
      ELSE [{", ".join(sql_str(u) for u in ASSET_URLS)}][k % 4 + 1]
    END AS url
  FROM requests_pre
),
requests AS (
  SELECT event_id, ts, user_id, step, k, dep, arr,
    CASE WHEN intl THEN 'International' ELSE 'National' END AS flight_type,
    CASE WHEN user_id % 50 = 49
         THEN '10.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR)
         ELSE '10.' || CAST(user_id % 8 AS VARCHAR) || '.' || CAST(user_id % 32 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR)
    END AS remote_addr,
    '192.168.72.' || CAST(event_id % 3 + 120 AS VARCHAR) AS server_addr,
    session_id,
    'UA' || CAST((user_id + event_id % 3) % 7 AS VARCHAR) AS user_agent,
    request_method, url,
    request_method || ' ' || url || ' HTTP/1.1' AS request,
    CASE WHEN step IN ('book', 'pay') THEN {sql_str(FORM_CONTENT_TYPE)} ELSE 'text/html' END AS content_type,
    CASE step
      WHEN 'book' THEN 'json=%7B%22depcity%22%3A%22' || dep || '%22%2C%22arrcity%22%3A%22' || arr
                       || '%22%2C%22flightdate%22%3A%22' || fdate
                       || '%22%2C%22adultnum%22%3A%22' || CAST(k % 3 + 1 AS VARCHAR) || '%22%7D'
      WHEN 'pay' THEN 'orderNo=' || CAST(event_id AS VARCHAR)
      ELSE '' END AS request_body,
    {sql_str(HOST + '/shop/flightSelect.html?t=S&')} || qs
      || CASE WHEN round_trip THEN '&d2=' || d2 ELSE '' END AS http_referer,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS time_iso8601,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' AS time_local,
    'JSESSIONID=' || session_id || '; userId4logCookie=138' || lpad(CAST(user_id AS VARCHAR), 8, '0')
      || '; lv=' || CAST(epoch_ms(ts) AS VARCHAR) AS http_cookie,
    (event_id * 7) % 50 AS active_user_num,
    'CZ' || CAST(k % 50 AS VARCHAR) AS flight_no, CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'C' END AS cabin,
    CAST(ts AS DATE) + CAST(k % 20 AS INTEGER) AS flight_date
  FROM requests_url
)"""

CRITICAL = any_match_sql("url", dim.CRITICAL_PAGE_RULES)


def with_requests(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([REQUESTS, *extra_ctes])
    return f"WITH {ctes}\n{body}"


def _windowed(select_base: str, window_ms, slide_ms) -> str:
    """CTE text giving ``win`` = base rows with their window start ``ws`` (ms)."""
    if window_ms is None:
        return f"base AS ({select_base}),\nwin AS (SELECT *, CAST(NULL AS BIGINT) AS ws FROM base)"
    n = -(-window_ms // slide_ms)
    return (f"base AS ({select_base}),\n"
            f"win AS (SELECT b.*, (b.t // {slide_ms} - r.j) * {slide_ms} AS ws "
            f"FROM base b, range(0, {n}) r(j) WHERE (b.t // {slide_ms} - r.j) * {slide_ms} + {window_ms} > b.t)")


def _wcols(window_ms) -> str:
    if window_ms is None:
        return "CAST(NULL AS VARCHAR) AS window_start, CAST(NULL AS VARCHAR) AS window_end"
    return (f"strftime(epoch_ms(ws), '%Y-%m-%d %H:%M:%S') AS window_start, "
            f"strftime(epoch_ms(ws + {window_ms}), '%Y-%m-%d %H:%M:%S') AS window_end")


METRICS_BASE = f"""SELECT remote_addr AS ip, epoch_ms(ts) AS t, {CRITICAL} AS crit,
  coalesce(user_agent, '') AS ua, session_id AS sid,
  coalesce(dep, '') || '->' || coalesce(arr, '') AS rt FROM requests"""


def metrics_ctes(window_ms, slide_ms, gap_ms) -> str:
    return f"""{_windowed(METRICS_BASE, window_ms, slide_ms)},
counts AS (
  SELECT ws, ip, count(*) AS access_count, count(*) FILTER (WHERE crit) AS critical_count,
         count(DISTINCT ua) AS user_agent_count, count(DISTINCT sid) AS cookie_count,
         count(DISTINCT rt) AS route_count
  FROM win GROUP BY ws, ip),
gaps AS (
  SELECT ws, ip, t - lag(t) OVER (PARTITION BY ws, ip ORDER BY t) AS gap FROM win WHERE crit),
g AS (
  SELECT ws, ip, CASE WHEN count(*) = 1 THEN -1 ELSE min(gap) END AS min_interval_ms,
         count(*) FILTER (WHERE gap < {gap_ms}) AS close_interval_count
  FROM gaps GROUP BY ws, ip),
wide AS (
  SELECT c.ws, c.ip, access_count, critical_count, user_agent_count, cookie_count, route_count,
         min_interval_ms, close_interval_count
  FROM counts c LEFT JOIN g ON c.ip = g.ip AND c.ws IS NOT DISTINCT FROM g.ws)"""


def metrics_sql(window_ms, slide_ms, gap_ms) -> str:
    return with_requests(f"""SELECT {_wcols(window_ms)}, ip, access_count, critical_count,
  user_agent_count, cookie_count, route_count, min_interval_ms, close_interval_count
FROM wide""", metrics_ctes(window_ms, slide_ms, gap_ms))


METRIC_NAMES = [("access_count", "ip_access"), ("critical_count", "critical_access"),
                ("user_agent_count", "user_agent_distinct"), ("cookie_count", "cookie_distinct"),
                ("route_count", "route_distinct"), ("min_interval_ms", "critical_min_interval"),
                ("close_interval_count", "critical_close_intervals")]


def metrics_long_sql(window_ms, slide_ms, gap_ms) -> str:
    parts = [f"SELECT {_wcols(window_ms)}, '{name}' AS metric, ip AS key, "
             f"CAST({col} AS BIGINT) AS value FROM wide WHERE {col} IS NOT NULL"
             for col, name in METRIC_NAMES]
    return with_requests("\nUNION ALL\n".join(parts), metrics_ctes(window_ms, slide_ms, gap_ms))


def ip_block_sql(window_ms, slide_ms) -> str:
    base = ("SELECT split_part(remote_addr, '.', 1) || '.' || split_part(remote_addr, '.', 2) AS ip_block, "
            "epoch_ms(ts) AS t FROM requests "
            "WHERE len(string_split(regexp_replace(remote_addr, '[.]+$', ''), '.')) = 4")
    return with_requests(f"SELECT {_wcols(window_ms)}, ip_block, count(*) AS access_count "
                         f"FROM win GROUP BY ws, ip_block", _windowed(base, window_ms, slide_ms))


# ---- step 3 oracles ----------------------------------------------------------
from tollgate.functions.redact import ID_CARD_PATTERN, PHONE_PATTERN  # noqa: E402
from tollgate.operators.tags import DATE_IN_TEXT  # noqa: E402


def redact_sql(col: str, pattern: str) -> str:
    return (f"list_reduce(list_prepend({col}, regexp_extract_all({col}, {sql_str(pattern)})), "
            f"lambda acc, m: replace(acc, m, upper(md5(m))))")


_F = ["time_local", "request", "request_method", "content_type", "request_body", "http_referer",
      "remote_addr", "user_agent", "time_iso8601", "server_addr", "http_cookie"]

RAW_LINE_INGEST = with_requests("""
SELECT event_id, p[7] AS remote_addr, p[2] AS request, p[9] AS time_iso8601,
       TRY_CAST(trim(p[12]) AS BIGINT) AS active_user_num,
       TRY_CAST(trim(p[12]) AS BIGINT) IS NOT NULL AS accepted
FROM (SELECT event_id, value, string_split(value, '#CS#') AS p FROM lines)
WHERE len(string_split(regexp_replace(regexp_replace(value, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'),
                                      '(#CS#)+$', ''), '#CS#')) >= 12""",
    f"""lines AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 13 THEN concat_ws('#CS#', {", ".join(_F)})
         ELSE concat_ws('#CS#', {", ".join(_F)},
              CASE WHEN event_id % 89 = 7 THEN '' WHEN event_id % 83 = 5 THEN 'n/a'
                   ELSE CAST(active_user_num AS VARCHAR) END) END AS value
  FROM requests)""")


def _cookie(col: str, key: str) -> str:
    return (f"coalesce(nullif(regexp_extract({col}, '(?:^|;)\\s*{key}=([^;=]*)', 1), ''), 'NULL')")


def _param(col: str, key: str) -> str:
    return f"regexp_extract({col}, '[?&]{key}=([^&=]*)', 1)"


def _classify() -> tuple[str, str]:
    ft = "CASE " + " ".join(f"WHEN regexp_full_match(url, {sql_str(p)}) THEN '{f}'"
                             for p, f, _ in dim.CLASSIFY_RULES) + " ELSE 'Other' END"
    bt = "CASE " + " ".join(f"WHEN regexp_full_match(url, {sql_str(p)}) THEN '{b}'"
                             for p, _, b in dim.CLASSIFY_RULES) + " ELSE 'Other' END"
    return ft, bt


def _rule_choice(behavior: str) -> str:
    whens = []
    for r in reversed(dim.PARSE_RULES):
        rid, _, _, beh, match, method = r[:6]
        if beh != behavior:
            continue
        whens.append(f"WHEN behavior_type = '{beh}' AND lower(request_method) = '{method.lower()}' "
                     f"AND regexp_full_match(url, {sql_str(match)}) THEN {rid}")
    return "CASE " + " ".join(whens) + " END"


_FT, _BT = _classify()
_BLACK = ", ".join(sql_str(ip) for ip in sorted(set(dim.BLACK_IPS)))
_BOOK_RULE_FLIGHT = "CASE brule " + " ".join(
    f"WHEN {r[0]} THEN {0 if r[2] == 'National' else 1}" for r in dim.PARSE_RULES if r[3] == "Book") + " END"

PREPROCESSED = with_requests("""
SELECT event_id, url, flight_type, behavior_type, travel_type, high_freq_ip, session_id, user_id,
  redacted_cookie,
  CASE WHEN qrule IS NOT NULL THEN qdep END AS q_dep_city,
  CASE WHEN qrule IS NOT NULL THEN qarr END AS q_arr_city,
  CASE WHEN qrule IS NOT NULL THEN qdate END AS q_flight_date,
  CASE WHEN qrule IS NOT NULL THEN qadult END AS q_adult_num,
  CASE WHEN qrule IS NOT NULL THEN CASE travel_type WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END END
    AS q_travel_type,
  CASE WHEN qrule IS NOT NULL THEN CASE flight_type WHEN 'National' THEN 0 WHEN 'International' THEN 1 ELSE -1 END END
    AS q_flight_type,
  CASE WHEN brule IS NOT NULL THEN coalesce(json_extract_string(bjson, '$.depcity'), '') END AS b_dep_city,
  CASE WHEN brule IS NOT NULL THEN coalesce(json_extract_string(bjson, '$.arrcity'), '') END AS b_arr_city,
  CASE WHEN brule IS NOT NULL THEN coalesce(json_extract_string(bjson, '$.flightdate'), '') END AS b_flight_date,
  CAST(NULL AS VARCHAR) AS b_contact_phone,
  CASE WHEN brule IS NOT NULL THEN """ + _BOOK_RULE_FLIGHT + """ END AS b_flight_type,
  coalesce(nullif(CASE WHEN qrule IS NOT NULL THEN qdep END, ''),
           nullif(CASE WHEN brule IS NOT NULL THEN json_extract_string(bjson, '$.depcity') END, '')) AS core_dep_city,
  coalesce(nullif(CASE WHEN qrule IS NOT NULL THEN qarr END, ''),
           nullif(CASE WHEN brule IS NOT NULL THEN json_extract_string(bjson, '$.arrcity') END, '')) AS core_arr_city,
  coalesce(nullif(CASE WHEN qrule IS NOT NULL THEN qdate END, ''),
           nullif(CASE WHEN brule IS NOT NULL THEN json_extract_string(bjson, '$.flightdate') END, '')) AS core_flight_date
FROM tagged2""",
    f"""msgs AS (
  SELECT * EXCLUDE (user_id, flight_type, session_id, step, k, dep, arr),
         split_part(request, ' ', 2) AS url,
         {redact_sql(redact_sql("http_cookie", PHONE_PATTERN), ID_CARD_PATTERN)} AS redacted_cookie
  FROM requests
  WHERE NOT {any_match_sql("request", dim.URL_FILTER_RULES)}),
tagged AS (
  SELECT *, {_FT} AS flight_type, {_BT} AS behavior_type,
    CASE len(regexp_extract_all(http_referer, {sql_str(DATE_IN_TEXT)}))
      WHEN 1 THEN 'OneWay' WHEN 2 THEN 'RoundTrip' ELSE 'Unknown' END AS travel_type,
    remote_addr IN ({_BLACK}) AS high_freq_ip,
    {_cookie("redacted_cookie", "JSESSIONID")} AS session_id,
    {_cookie("redacted_cookie", "userId4logCookie")} AS user_id,
    {_param("url", "c1")} AS qdep, {_param("url", "c2")} AS qarr,
    {_param("url", "d1")} AS qdate, {_param("url", "at")} AS qadult,
    regexp_replace(url_decode(regexp_extract(request_body, '(?:^|&)json=([^&=]*)', 1)), '^\\[(.*)\\]$', '\\1') AS bjson
  FROM msgs),
tagged2 AS (
  SELECT *, {_rule_choice("Query")} AS qrule, {_rule_choice("Book")} AS brule FROM tagged)""")

def _md5_up(e: str) -> str:
    return f"upper(md5({e}))"


# Every field of the message formats, computed from the values they were made of.
_Q = "v IN (0, 1, 2, 3, 4)"
_B = "v IN (5, 6, 7)"
PREPROCESSED_FORMATS = with_requests(f"""
SELECT event_id, CASE WHEN v IN (0, 1, 2, 3, 4, 8) THEN 'Query' ELSE 'Book' END AS behavior_type, v IN (8, 9) AS parse_failed,
  'S%41 A' AS session_id,
  epoch_ms(ts) - CASE WHEN event_id % 4 IN (1, 3) THEN 28800000 ELSE 0 END + CASE WHEN event_id % 4 = 1 THEN 123 ELSE 0 END AS time_ms,
  CASE WHEN {_Q} THEN false END AS q_is_empty,
  CASE WHEN v = 0 THEN dep WHEN {_Q} THEN city END AS q_dep_city, CASE WHEN {_Q} THEN arr END AS q_arr_city,
  CASE WHEN {_Q} THEN d END AS q_flight_date, CASE WHEN {_Q} THEN n END AS q_adult_num,
  CASE WHEN v = 1 THEN 'u00e9 x' WHEN {_Q} THEN '' END AS q_child_num,
  CASE WHEN v = 3 THEN 1 WHEN {_Q} THEN CASE len(regexp_extract_all(http_referer, {sql_str(DATE_IN_TEXT)}))
    WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE -1 END END AS q_travel_type,
  CASE WHEN {_B} THEN 'U' || event_id END AS b_user_id, CASE WHEN {_B} THEN 'N' || n END AS b_contact_name,
  CASE WHEN {_B} THEN {_md5_up("'138' || lpad(CAST(event_id % 1000 AS VARCHAR), 8, '0')")} END AS b_contact_phone,
  CASE WHEN v = 6 THEN array_to_string(list_transform(people, lambda i: 'L' || n), ',')
       WHEN {_B} THEN array_to_string(list_transform(people, lambda i: 'F' || i || 'L' || n), ',') END AS b_psg_name,
  CASE WHEN {_B} THEN array_to_string(list_transform(people, lambda i: 'ADT'), ',') END AS b_psg_type,
  CASE WHEN {_B} THEN array_to_string(list_transform(people, lambda i: 'NI'), ',') END AS b_id_type,
  CASE WHEN {_B} THEN array_to_string(list_transform(people, lambda i: {_md5_up("'ID' || i")}), ',') END AS b_id_card,
  CASE WHEN {_B} THEN city END AS b_dep_city, CASE WHEN {_B} THEN arr END AS b_arr_city, CASE WHEN {_B} THEN d END AS b_flight_date,
  CASE WHEN {_B} THEN 'CZ' || n END AS b_flight_no, CASE WHEN {_B} THEN 'Y' END AS b_cabin,
  CASE WHEN v = 0 THEN dep WHEN v < 8 THEN city END AS core_dep_city
FROM (SELECT *, event_id % 10 AS v, CAST(k % 3 + 1 AS VARCHAR) AS n, dep || 'é广' AS city, strftime(ts, '%Y-%m-%d') AS d,
             range(1, k % 3 + 2) AS people FROM requests)""")


def rule_match_many_sql(n: int) -> str:
    """Session S<user>-<x> fully matches rule i if i is the user or the user without the last digit."""
    return with_requests(f"""
SELECT event_id, session_id, CASE WHEN hit IS NULL THEN 'Other' ELSE 'F' || (hit % 7) END AS flight_type,
       CASE WHEN hit IS NULL THEN 'Other' ELSE 'B' || hit END AS behavior_type
FROM (SELECT event_id, session_id, CASE WHEN user_id >= 10 AND user_id // 10 < {n} THEN user_id // 10
                                        WHEN user_id < {n} THEN user_id END AS hit FROM requests)""")


REDACT_DOCUMENTS = f"""
SELECT doc_id, len(regexp_extract_all(text, {sql_str(PHONE_PATTERN)})) AS phone_matches,
       {redact_sql("text", PHONE_PATTERN)} AS redacted_text
FROM documents"""


# Identity numbers of 18 and 15 digits, with check letter, twice, and too short ones.
_ID_TEXT = """CASE c_custkey % 5 WHEN 0 THEN 'id=' || lpad(c_custkey::VARCHAR, 18, '3') || ';'
    WHEN 1 THEN 'card ' || lpad(c_custkey::VARCHAR, 17, '4') || 'X, ' || lpad(c_custkey::VARCHAR, 17, '5') || 'x'
    WHEN 2 THEN lpad(c_custkey::VARCHAR, 15, '6') || ' ' || lpad(c_custkey::VARCHAR, 15, '7')
    WHEN 3 THEN 'short ' || lpad(c_custkey::VARCHAR, 14, '8') ELSE 'none' END"""
REDACT_IDENTITY = f"""
SELECT c_custkey, {redact_sql("text", ID_CARD_PATTERN)} AS redacted_text
FROM (SELECT c_custkey, {_ID_TEXT} AS text FROM customer)"""

# What is empty is written as NULL and read as that text.
RECORD_ROUND_TRIP = f"""
SELECT event_id, url, flight_type, behavior_type, travel_type, high_freq_ip,
       {", ".join(f"coalesce(nullif({c}, ''), 'NULL') AS {c}" for c in ("session_id", "user_id", "core_dep_city", "core_arr_city", "core_flight_date"))},
       q_dep_city, q_adult_num, q_travel_type, b_dep_city, b_flight_type
FROM ({PREPROCESSED}) WHERE behavior_type IN ('Query', 'Book')"""

# Complete lines with a number (the rules by which lines are damaged), as records of queries and bookings.
STREAM_RECORDS = f"""
SELECT url AS request, flight_type, behavior_type, travel_type, high_freq_ip, session_id, user_id, core_dep_city AS dep_city,
       core_arr_city AS arr_city, core_flight_date AS flight_date, count(*) AS records
FROM ({PREPROCESSED})
WHERE behavior_type IN ('Query', 'Book') AND NOT (event_id % 97 = 13 OR event_id % 89 = 7 OR event_id % 83 = 5)
GROUP BY ALL"""


def stream_metrics_sql(window_ms: int, slide_ms: int, pane_ms: int, gap_ms: int) -> str:
    """The windows that end where the last closed pane ends, or before."""
    ends = f"(epoch_ms(ts) // {pane_ms} + 1) * {pane_ms}"
    upto = with_requests(f"SELECT max({ends}) FROM requests WHERE {ends} <= (SELECT max(epoch_ms(ts)) FROM requests)")
    return f"SELECT * FROM ({metrics_sql(window_ms, slide_ms, gap_ms)}) WHERE epoch_ms(CAST(window_end AS TIMESTAMP)) <= ({upto})"


XML_TRAVEL_TYPES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'OneWay' WHEN o_orderkey % 4 = 1 THEN 'RoundTrip' ELSE 'Unknown' END AS travel_type
FROM orders"""


# ---- step 6 oracles ----------------------------------------------------------

BOOKINGS = """
bookings AS (
  SELECT o_orderkey AS order_key, 
    CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds((o_orderkey * 7919) % 86400) AS book_ts,
    CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
      + to_seconds((o_orderkey * 7919) % 86400 + (o_orderkey % 3) * 86400 + (o_orderkey % 5) * 1200) AS pay_ts,
    o_orderstatus AS status,
    '10.' || CAST(o_custkey % 8 AS VARCHAR) AS ip_block,
    CAST(o_custkey AS VARCHAR) AS buyer_id,
    coalesce(c_name, '') AS contact_name,
    upper(md5('139' || lpad(CAST(CASE WHEN o_custkey % 10 = 0 THEN o_custkey % 50 ELSE o_custkey END
                                AS VARCHAR), 8, '0'))) AS contact_phone,
    'P' || CAST(o_orderkey % 500 AS VARCHAR) AS passenger
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
bevents AS (
  SELECT order_key, ip_block, buyer_id, contact_name, contact_phone, passenger, book_ts AS ts, 'book' AS step FROM bookings
  UNION ALL
  SELECT order_key, ip_block, buyer_id, contact_name, contact_phone, passenger, pay_ts, 'pay' FROM bookings WHERE status = 'F'
  UNION ALL
  SELECT order_key, ip_block, buyer_id, contact_name, contact_phone, passenger, book_ts, 'cancel' FROM bookings WHERE status = 'P'),
bkeys AS (
  SELECT ts, step, order_key, k.key_kind, k.key FROM bevents,
  UNNEST([{'key_kind': 'ip_block', 'key': ip_block}, {'key_kind': 'buyer', 'key': buyer_id},
          {'key_kind': 'contact_name', 'key': contact_name}, {'key_kind': 'contact_phone', 'key': contact_phone},
          {'key_kind': 'passenger', 'key': passenger},
          {'key_kind': 'contact', 'key': contact_name || '|' || contact_phone}]) AS u(k))"""


def _wstart(ts: str, window_ms) -> str:
    if window_ms is None:
        return "CAST(NULL AS BIGINT)"
    return f"(epoch_ms({ts}) // {window_ms}) * {window_ms}"


def booking_metrics_sql(window_ms) -> str:
    return f"""WITH {BOOKINGS},
w AS (SELECT *, {_wstart("ts", window_ms)} AS ws FROM bkeys)
SELECT {_wcols(window_ms)}, key_kind, key,
  count(*) FILTER (WHERE step = 'book') AS bookings,
  count(*) FILTER (WHERE step = 'pay') AS payments,
  count(*) FILTER (WHERE step = 'cancel') AS cancellations
FROM w GROUP BY ws, key_kind, key"""


def unpaid_sql(window_ms) -> str:
    cond = "" if window_ms is None else (
        f" AND epoch_ms(p.ts) >= b.ws AND epoch_ms(p.ts) < b.ws + {window_ms}")
    return f"""WITH {BOOKINGS},
b AS (SELECT *, {_wstart("ts", window_ms)} AS ws FROM bkeys WHERE step = 'book'),
p AS (SELECT DISTINCT order_key, ts FROM bevents WHERE step = 'pay')
SELECT {_wcols(window_ms)}, key_kind, key, count(*) AS unpaid
FROM b WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.order_key = b.order_key{cond})
GROUP BY ws, key_kind, key"""


# ---- step 5 oracles ----------------------------------------------------------

def _values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return sql_str(v)
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(c.split()[0] for c in cols.split(", "))
    return f"(VALUES {body}) AS t({names})"


def _scoring_ctes(window_ms: int = 86_400_000, rule_type: int = 2) -> str:
    DAY = window_ms
    ip_long = "\nUNION ALL\n".join(
        [f"SELECT ws, '{name}' AS metric, ip AS key, CAST({col} AS BIGINT) AS value, CAST(NULL AS DOUBLE) AS arg1 "
         f"FROM wide WHERE {col} IS NOT NULL" for col, name in METRIC_NAMES if col != "close_interval_count"]
        + [f"SELECT ws, 'critical_close_intervals', ip, count(*) FILTER (WHERE gap < {g}), CAST({g} AS DOUBLE) "
           f"FROM gaps GROUP BY ws, ip" for g in dim.close_gaps(rule_type)])
    return f"""{metrics_ctes(DAY, DAY, 0)},
{BOOKINGS.strip()},
blk AS (
  SELECT (epoch_ms(ts) // {DAY}) * {DAY} AS ws, 'ip_block_access' AS metric,
         split_part(remote_addr, '.', 1) || '.' || split_part(remote_addr, '.', 2) AS key,
         count(*) AS value
  FROM requests WHERE len(string_split(regexp_replace(remote_addr, '[.]+$', ''), '.')) = 4
  GROUP BY 1, 3),
bw AS (SELECT *, (epoch_ms(ts) // {DAY}) * {DAY} AS ws FROM bkeys),
cat AS (
  SELECT ws, step_name || '_by_' || key_kind AS metric, key, n AS value FROM (
    SELECT ws, key_kind, key, CASE step WHEN 'book' THEN 'bookings' WHEN 'pay' THEN 'payments'
                                       ELSE 'cancellations' END AS step_name, count(*) AS n
    FROM bw GROUP BY ALL)
  UNION ALL
  SELECT ws, 'unpaid_by_' || key_kind, key, count(*) FROM bw b
  WHERE step = 'book' AND NOT EXISTS (SELECT 1 FROM bevents p WHERE p.step = 'pay'
        AND p.order_key = b.order_key AND epoch_ms(p.ts) >= b.ws AND epoch_ms(p.ts) < b.ws + {DAY})
  GROUP BY ws, key_kind, key),
mlong AS ({ip_long}
  UNION ALL SELECT *, NULL FROM blk UNION ALL SELECT *, NULL FROM cat),
rules AS (SELECT r.*, m.metric, m.cmp FROM (SELECT * FROM {_values(dim.SCORE_RULES, dim.SCORE_RULE_SCHEMA)}) r
          JOIN (SELECT * FROM {_values(dim.MAINTENANCE, dim.MAINTENANCE_SCHEMA)}) m ON r.rule_name = m.rule_name),
flows AS (SELECT f.*, s.crawler_threshold, s.occ_threshold FROM (SELECT * FROM {_values(dim.FLOWS, dim.FLOW_SCHEMA)}) f
          JOIN (SELECT * FROM {_values(dim.STRATEGIES, dim.STRATEGY_SCHEMA)}) s ON f.flow_id = s.flow_id),
fr AS (SELECT r.*, f.flow_name FROM rules r JOIN flows f ON r.flow_id = f.flow_id
       WHERE r.status = 0 AND f.status = 0 AND r.rule_type = {rule_type}),
ev AS (
  SELECT m.ws, fr.flow_id, fr.flow_name, fr.rule_id, fr.crawler_type, m.key,
    CASE fr.cmp WHEN '<' THEN m.value >= 0 AND m.value < fr.arg0
                WHEN '>' THEN m.value > fr.arg0
                WHEN '<=' THEN m.value >= 0 AND m.value <= fr.arg0
                ELSE m.value >= fr.arg0 END AS hit, fr.score
  FROM mlong m JOIN fr ON m.metric = fr.metric AND (m.arg1 IS NULL OR m.arg1 = fr.arg1)),
fs AS (
  SELECT ws, flow_id, flow_name, crawler_type, key,
         CAST(sum(CASE WHEN hit THEN score ELSE 0 END) AS BIGINT) AS score,
         coalesce(list_sort(list(rule_id) FILTER (WHERE hit)), []) AS hit_rules
  FROM ev GROUP BY ALL),
dec AS (
  SELECT fs.*, epoch_ms(fs.ws + {DAY}) AS wend FROM fs JOIN flows f ON fs.flow_id = f.flow_id
  WHERE f.status = 0
    AND fs.score > CASE WHEN fs.crawler_type = 0 THEN f.crawler_threshold ELSE f.occ_threshold END),
bl AS (
  SELECT ws + {DAY} + 3600000 AS key_exp_time, key,
         to_json({{'flow_id': flow_id, 'crawler_type': crawler_type, 'score': score,
                   'hit_rules': hit_rules}}) AS value
  FROM dec)"""


DAY = 86_400_000
FLOW_SCORES = with_requests(f"""SELECT {_wcols(DAY)}, flow_id, flow_name, crawler_type, key, score, hit_rules
FROM fs""", _scoring_ctes())
BLACKLIST = with_requests("SELECT key_exp_time, key, CAST(value AS VARCHAR) AS value FROM bl", _scoring_ctes())
RESTORE = with_requests("""
SELECT key, key_exp_time, CAST(value AS VARCHAR) AS value,
       key_exp_time - epoch_ms(TIMESTAMP '2024-01-20 00:00:00') AS ttl_ms
FROM bl WHERE (key, key_exp_time) IN (SELECT (key, max(key_exp_time)) FROM bl GROUP BY key)
  AND key_exp_time - epoch_ms(TIMESTAMP '2024-01-20 00:00:00') >= 1000""", _scoring_ctes())
# Keys that are live already, for the restore from storage.
LIVE_PREFIX = "10.4."
RESTORE_HOURS = with_requests(f"""
SELECT key, key_exp_time, CAST(value AS VARCHAR) AS value,
       key_exp_time - epoch_ms(TIMESTAMP '2024-01-24 00:10:00') AS ttl_ms
FROM (SELECT *, max(key_exp_time) OVER (PARTITION BY key) AS latest FROM (
        SELECT *, key_exp_time - 3600000 AS written FROM bl)
      WHERE written >= epoch_ms(TIMESTAMP '2024-01-23 23:00:00') AND written < epoch_ms(TIMESTAMP '2024-01-24 01:00:00'))
WHERE key_exp_time = latest AND key NOT LIKE '{LIVE_PREFIX}%'
  AND key_exp_time - epoch_ms(TIMESTAMP '2024-01-24 00:10:00') >= 1000""", _scoring_ctes())
FLOW_SCORES_TIER = {t: with_requests(f"""SELECT {_wcols(w)}, flow_id, flow_name, crawler_type, key, score, hit_rules
FROM fs""", _scoring_ctes(w, t)) for t, w in ((0, 300_000), (1, 3_600_000))}
HISTOGRAM = with_requests(f"""SELECT {_wcols(DAY)}, metric, value, count(*) AS key_count
FROM mlong GROUP BY ws, metric, value""", _scoring_ctes())


# ---- step 7 oracles ----------------------------------------------------------

def _dash_ctes() -> str:
    return _scoring_ctes() + f""",
sc AS (SELECT DISTINCT key FROM dec WHERE crawler_type = 0),
ho AS (SELECT DISTINCT key FROM dec WHERE crawler_type = 1),
ag AS (SELECT DISTINCT buyer_id FROM bookings WHERE contact_phone IN (
         SELECT contact_phone FROM bookings GROUP BY 1 HAVING count(DISTINCT buyer_id) >= 2)),
creq0 AS (
  SELECT r.*, CAST(r.ts AS DATE) AS day,
    r.remote_addr IN (SELECT key FROM sc) AS is_scraper,
    CAST(r.user_id AS VARCHAR) IN (SELECT key FROM ho) AS is_hoarding,
    CAST(r.user_id AS VARCHAR) IN (SELECT buyer_id FROM ag) AS is_agent,
    CASE len(regexp_extract_all(r.http_referer, {sql_str(DATE_IN_TEXT)}))
      WHEN 1 THEN 'OneWay' WHEN 2 THEN 'RoundTrip' ELSE 'Unknown' END AS travel_type
  FROM requests r),
creq AS (
  SELECT *, CASE WHEN is_scraper THEN 'query' WHEN is_hoarding THEN 'hoarding'
                 WHEN is_agent THEN 'agent' ELSE 'normal' END AS user_class FROM creq0)"""


_FUNNEL = """count(DISTINCT CASE WHEN step = 'query' THEN session_id END) AS query_sessions,
  count(DISTINCT CASE WHEN step = 'book' THEN session_id END) AS book_sessions,
  count(DISTINCT CASE WHEN step = 'pay' THEN session_id END) AS pay_sessions"""


def _rates(inner: str) -> str:
    return f"""SELECT *, round(CAST(book_sessions AS DOUBLE) / nullif(query_sessions, 0), 6) AS book_rate,
  round(CAST(pay_sessions AS DOUBLE) / nullif(query_sessions, 0), 6) AS pay_rate FROM ({inner})"""


def _dash(body: str) -> str:
    return with_requests(body, _dash_ctes())


DASH_FUNNEL_DAILY = _dash(_rates(f"SELECT day, flight_type, {_FUNNEL} FROM creq GROUP BY day, flight_type"))
DASH_FUNNEL_BY_CLASS = _dash(_rates(f"""
  SELECT day, CASE WHEN GROUPING(user_class) = 1 THEN 'all' ELSE user_class END AS user_class, {_FUNNEL}
  FROM creq GROUP BY ROLLUP (day, user_class) HAVING day IS NOT NULL"""))
DASH_FUNNEL_SCOPE = _dash(_rates(f"""
  SELECT day, 'all' AS scope, {_FUNNEL} FROM creq GROUP BY day
  UNION ALL
  SELECT day, 'no_scrapers', {_FUNNEL} FROM creq WHERE NOT is_scraper GROUP BY day"""))
DASH_SCRAPER_TRAVEL_FREQUENCY = _dash("""
SELECT day, travel_type, count(*) FILTER (WHERE flight_type = 'National') AS national,
       count(*) FILTER (WHERE flight_type = 'International') AS international
FROM creq WHERE is_scraper AND step = 'query' AND travel_type IN ('OneWay', 'RoundTrip')
GROUP BY day, travel_type""")
DASH_SCRAPER_ROUTE_RANKING = _dash("""
SELECT dep, arr, count(*) AS queries FROM creq WHERE is_scraper AND step = 'query' GROUP BY dep, arr""")
DASH_HOARDING_FLIGHT_RANKING = _dash("""
SELECT dep, arr, flight_no, cabin, flight_date, count(*) AS unpaid_bookings FROM creq b
WHERE step = 'book' AND NOT EXISTS (SELECT 1 FROM creq p WHERE p.step = 'pay' AND p.user_id = b.user_id AND p.day = b.day)
GROUP BY ALL""")
DASH_CUSTOMER_TYPE_DAILY = _dash("""
SELECT CAST(s.day AS DATE) AS day, CAST(t.customer_type AS INTEGER) AS customer_type, nullif(n.users, 0) AS users
FROM (SELECT unnest(generate_series((SELECT min(day) FROM creq), (SELECT max(day) FROM creq), INTERVAL 1 DAY)) AS day) s
CROSS JOIN (VALUES (0), (1), (2)) t(customer_type)
LEFT JOIN (SELECT day, c, count(DISTINCT user_id) FILTER (c = 0 OR is_agent = (c = 2)) AS users
           FROM creq, (VALUES (0), (1), (2)) v(c) GROUP BY day, c) n ON n.day = CAST(s.day AS DATE) AND n.c = t.customer_type""")
DASH_LOOK_TO_BOOK = _dash("""
SELECT *, round(CAST(queries AS DOUBLE) / nullif(bookings, 0), 6) AS look_to_book FROM (
  SELECT day, CASE WHEN GROUPING(user_class) = 1 THEN 'all' ELSE user_class END AS user_class,
         count(*) FILTER (WHERE step = 'query') AS queries, count(*) FILTER (WHERE step = 'book') AS bookings
  FROM creq GROUP BY ROLLUP (day, user_class) HAVING day IS NOT NULL)""")
DASH_USER_CLASS_COUNTS = _dash("""
SELECT day, count(DISTINCT CASE WHEN user_class = 'normal' THEN user_id END) AS normal,
  count(DISTINCT CASE WHEN user_class = 'query' THEN user_id END) AS query,
  count(DISTINCT CASE WHEN user_class = 'hoarding' THEN user_id END) AS hoarding,
  count(DISTINCT CASE WHEN user_class = 'agent' THEN user_id END) AS agent
FROM creq GROUP BY day""")
DASH_TRAFFIC_SHARE = _dash("""
SELECT day, count(*) AS total_requests, count(*) FILTER (WHERE is_scraper) AS scraper_requests,
  round(CAST(count(*) FILTER (WHERE is_scraper) AS DOUBLE) / count(*), 6) AS scraper_share
FROM creq GROUP BY day""")
DASH_SCRAPER_DAILY_CUMULATIVE = _dash("""
SELECT d.day, d.ips, d.scraper_ips,
  CAST(sum(coalesce(f.n, 0)) OVER (ORDER BY d.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS cumulative_scrapers
FROM (SELECT day, count(DISTINCT remote_addr) AS ips,
             count(DISTINCT CASE WHEN is_scraper THEN remote_addr END) AS scraper_ips FROM creq GROUP BY day) d
LEFT JOIN (SELECT day, count(*) AS n FROM (SELECT remote_addr, min(day) AS day FROM creq WHERE is_scraper
           GROUP BY remote_addr) GROUP BY day) f ON d.day = f.day""")
DASH_LINK_TRAFFIC_HOURLY = _dash("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, server_addr,
  count(*) AS requests,
  CAST(sum(count(*)) OVER (PARTITION BY date_trunc('hour', ts)) AS BIGINT) AS total_requests
FROM creq GROUP BY date_trunc('hour', ts), server_addr""")
DASH_COLLECTION_STATS = _dash("""
SELECT server_addr, CAST(arg_max(active_user_num, (ts, active_user_num)) AS BIGINT) AS active_connections,
  count(*) FILTER (WHERE day = DATE '2024-01-20' - 1) AS rows_day_minus_1,
  count(*) FILTER (WHERE day = DATE '2024-01-20' - 2) AS rows_day_minus_2,
  count(*) FILTER (WHERE day = DATE '2024-01-20' - 3) AS rows_day_minus_3
FROM creq GROUP BY server_addr""")
DASH_SCRAPER_TRAFFIC_SPINE = _dash("""
SELECT CAST(s.day AS DATE) AS day, t.scraper_requests FROM (
  SELECT unnest(generate_series((SELECT min(day) FROM creq WHERE is_scraper),
                                (SELECT max(day) FROM creq WHERE is_scraper), INTERVAL 1 DAY)) AS day) s
LEFT JOIN (SELECT day, count(*) AS scraper_requests FROM creq WHERE is_scraper GROUP BY day) t
  ON CAST(s.day AS DATE) = t.day""")


LINK_STATS = with_requests("""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       server_addr, count(*) AS request_count,
       CAST(arg_max(active_user_num, (ts, active_user_num)) AS BIGINT) AS active_user_num
FROM requests GROUP BY date_trunc('hour', ts), server_addr""")


# ---- step 9 oracles: the accuracy tables over a threshold rule ---------------------------

def _threshold_rows(at_least: int) -> str:
    return with_requests(f"""
SELECT w.ws, w.ip, CASE WHEN w.critical_count >= {at_least} THEN 1.0 ELSE 0.0 END AS prediction,
       CASE WHEN EXISTS (SELECT 1 FROM dec d WHERE d.crawler_type = 0 AND d.ws = w.ws AND d.key = w.ip) THEN 1.0 ELSE 0.0 END AS label
FROM wide w""", _scoring_ctes())


def threshold_accuracy_sql(at_least: int) -> str:
    return f"""SELECT 'threshold' AS model, CAST(epoch_ms(ws) AS DATE) AS day,
  round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS rows
FROM ({_threshold_rows(at_least)}) GROUP BY ws"""


def threshold_fit_sql(at_least: int) -> str:
    return f"""SELECT 'threshold' AS model, ip,
  round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS fit_rate, count(*) AS windows
FROM ({_threshold_rows(at_least)}) GROUP BY ip"""
