"""SQL counterparts of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
RUN_AT = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF = "DATE '2024-01-30'"

E = """
e AS (SELECT event_id, ts, user_id, event_type, value,
  cast(json_extract_string(props, '$.k') AS int) AS k FROM events)"""

EXCEPTION = """CASE WHEN event_type <> 'error' THEN NULL WHEN k % 10 = 0 THEN 'not-json{'
    WHEN k % 10 = 1 THEN '{"message":"x"}'
    ELSE '{"errorCode":"E' || (k % 5) || '"}' END"""
CODE = """CASE WHEN event_type <> 'error' OR k % 10 = 1 THEN NULL WHEN k % 10 = 0 THEN 'PARSE_ERROR'
    ELSE 'E' || (k % 5) END"""
ATTEMPTS = """CASE k % 3 WHEN 1 THEN '[{"attemptId":1,"type":"Data"}]'
    WHEN 2 THEN '[{"attemptId":1,"type":"Data"},{"attemptId":2,"type":"Query"}]' END"""
SECONDS = "date_diff('microsecond', start_time, end_time) / 1000000.0::double"

B = f"""{E},
b AS (SELECT event_id, user_id, k, 'r-' || lpad(event_id::varchar, 9, '0') AS request_id,
  'ds-' || user_id AS dataset_id, 'dataset ' || user_id AS dataset_name,
  'ws-' || (user_id % 5) AS workspace_id, 'workspace ' || (user_id % 5) AS workspace_name,
  CASE WHEN k % 4 = 0 THEN 'ViaApi' WHEN k % 4 = 1 THEN 'OnDemand' ELSE 'Scheduled' END AS refresh_type,
  CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Unknown' ELSE 'Completed' END AS status,
  ts AS start_time,
  CASE WHEN event_type <> 'signup'
    THEN ts + to_microseconds(cast(round(value * 1000000) AS bigint)) END AS end_time,
  {EXCEPTION} AS service_exception_json, {CODE} AS error_code,
  {ATTEMPTS} AS refresh_attempts_json, k % 3 AS attempt_count, user_id % 3 = 0 AS is_critical,
  cast(ts AS date) AS ingestion_date FROM e)"""

REFRESH_COLUMNS = """request_id, dataset_id, dataset_name, workspace_id, workspace_name, refresh_type, status,
  start_time, end_time, duration_seconds, service_exception_json, error_code, refresh_attempts_json,
  attempt_count, is_critical, ingestion_timestamp, ingestion_date"""

R = f"""{B},
r AS (SELECT request_id, dataset_id, dataset_name, workspace_id, workspace_name, refresh_type, status,
  start_time, end_time, {SECONDS} AS duration_seconds, service_exception_json, error_code,
  refresh_attempts_json, attempt_count, is_critical,
  cast(ingestion_date AS timestamp) AS ingestion_timestamp, ingestion_date FROM b)"""

# The batch to merge, already reduced to one row per request.
S = f"""{R},
s2 AS (SELECT 'r-' || lpad((event_id * 2)::varchar, 9, '0') AS request_id, dataset_id, dataset_name,
  workspace_id, workspace_name, refresh_type,
  CASE k % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN NULL ELSE status END AS status,
  start_time, end_time, service_exception_json, error_code, refresh_attempts_json, attempt_count,
  is_critical, {RUN_AT} AS ingestion_timestamp FROM b
  UNION ALL
  SELECT 'r-' || lpad((event_id * 2)::varchar, 9, '0'), dataset_id, dataset_name, workspace_id,
  workspace_name, refresh_type, 'Unknown', start_time, NULL, service_exception_json, error_code,
  refresh_attempts_json, attempt_count, is_critical, {RUN_AT} - INTERVAL 1 DAY FROM b),
s AS (SELECT *, {SECONDS} AS duration_seconds, DATE '2024-01-31' AS ingestion_date FROM s2
  QUALIFY row_number() OVER (PARTITION BY request_id
    ORDER BY coalesce(status = 'Unknown', true), ingestion_timestamp DESC) = 1)"""

_UPDATES = [
    "status", "end_time", "duration_seconds", "service_exception_json", "error_code",
    "refresh_attempts_json", "attempt_count", "ingestion_timestamp",
]


def _merge_columns() -> str:
    columns = []
    for name in [c.strip() for c in REFRESH_COLUMNS.split(",")]:
        kept = f"CASE WHEN r.request_id IS NOT NULL THEN r.{name} ELSE s.{name} END"
        if name in _UPDATES:
            updated = "r.request_id IS NOT NULL AND s.request_id IS NOT NULL AND s.status <> 'Unknown'"
            kept = f"CASE WHEN {updated} THEN s.{name} ELSE {kept} END"
        columns.append(f"{kept} AS {name}")
    return ", ".join(columns)


MERGED_REFRESH = f"WITH {S} SELECT {_merge_columns()} FROM r FULL OUTER JOIN s ON r.request_id = s.request_id"

A = f"""{E},
a AS (SELECT 'e-' || event_id AS event_id, ts AS creation_time, cast(ts AS date) AS creation_date,
  CASE event_type WHEN 'view' THEN 'ViewReport' WHEN 'click' THEN 'ViewDashboard'
    WHEN 'purchase' THEN 'CreateReport' WHEN 'signup' THEN 'EditReport' ELSE 'DeleteReport' END AS activity,
  CASE WHEN user_id % 29 <> 0 THEN 'user' || user_id || '@example.com' END AS user_id,
  'ws-' || (user_id % 5) AS workspace_id, 'workspace ' || (user_id % 5) AS workspace_name,
  'rpt-' || k AS report_id, CASE WHEN k % 11 <> 0 THEN 'report ' || k END AS report_name FROM e)"""

ACTIVITY_COLUMNS = (
    "event_id, creation_time, creation_date, activity, user_id, workspace_id, workspace_name, "
    "report_id, report_name"
)

ACTIVITY_ROWS = f"""WITH {A}
SELECT a.event_id, creation_time, creation_date, activity, a.user_id, NULL::varchar AS user_key,
  workspace_id, workspace_name, report_id, report_name, NULL::varchar AS report_type,
  NULL::varchar AS dataset_id, NULL::varchar AS dataset_name, NULL::varchar AS capacity_id,
  NULL::varchar AS consumption_method, NULL::varchar AS distribution_method,
  NULL::varchar AS item_name, NULL::varchar AS object_id,
  CASE WHEN e.k % 2 = 0 THEN 'Succeeded' ELSE 'Failed' END AS result_status,
  {RUN_AT} AS ingestion_timestamp, DATE '2024-01-31' AS ingestion_date
FROM a JOIN e ON a.event_id = 'e-' || e.event_id"""

P = f"""{E},
p AS (SELECT 'p-' || event_id AS probe_id, 'ws-' || (user_id % 5) AS workspace_id,
  'workspace ' || (user_id % 5) AS workspace_name, 'ds-' || user_id AS dataset_id,
  'dataset ' || user_id AS dataset_name, event_type AS query_label,
  CASE WHEN k % 10 = 0 THEN 'Failed' ELSE 'Success' END AS status,
  CASE WHEN k % 10 <> 0 THEN value END AS duration_ms, CASE WHEN k % 10 <> 0 THEN k END AS row_count,
  CASE WHEN k % 10 = 0 THEN 'HTTP 403' END AS error_message, user_id % 3 = 0 AS is_critical,
  ts AS probe_timestamp, cast(ts AS date) AS probe_date FROM e)"""

ROWS = "CASE WHEN k % 7 <= 3 THEN 0 ELSE k END"
TRIP_MS = "cast(round(value * 1000) AS bigint) / 1000.0::double"

L = f"""{E},
l AS (SELECT event_type || '/' || user_id AS endpoint,
  CASE event_type WHEN 'view' THEN 'dataset' WHEN 'click' THEN 'workspace' ELSE 'activity' END AS kind,
  'ds-' || user_id AS dataset_id, cast(ts AS date) AS day, event_id AS seq,
  CASE k WHEN 99 THEN 429 WHEN 98 THEN 403 WHEN 97 THEN 500 WHEN 96 THEN NULL
    WHEN 95 THEN 404 WHEN 94 THEN 401 ELSE 200 END AS status,
  value AS latency_ms, 'body ' || k AS body, CASE WHEN k = 96 THEN 'timed out' END AS error,
  CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method,
  CASE WHEN event_id % 2 = 0 THEN (event_id % 600)::varchar
    ELSE 'Wed, 31 Jan 2024 00:00:00 GMT' END AS wait FROM e)"""

OUTCOME = """CASE WHEN error IS NOT NULL OR status IS NULL THEN 'failed' WHEN status < 400 THEN 'ok'
  WHEN kind IN ('dataset', 'workspace') AND status IN (403, 404) THEN 'skip_empty'
  WHEN kind = 'activity' AND status IN (401, 403) THEN 'denied_empty'
  WHEN kind = 'activity' AND status = 429 THEN 'throttled' ELSE 'failed' END"""

QUOTA = """CASE WHEN status = 429 THEN 'RateLimit-Remaining=0;Retry-After=' || wait || ';x-ms-throttle-scope=tenant'
  ELSE 'X-RateLimit-Limit=200' END"""

STOPS = "(status >= 400 OR error IS NOT NULL)"

# Quotient of two non-negative integers, rounded to the nearest, ties to even.
HALF_EVEN = """({0} // {1} + CASE WHEN 2 * ({0} % {1}) > {1}
  OR (2 * ({0} % {1}) = {1} AND ({0} // {1}) % 2 = 1) THEN 1 ELSE 0 END)"""

BURST = f"""{L},
n AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY seq) AS i FROM l),
f AS (SELECT endpoint, min(i) AS stop_i FROM n WHERE {STOPS} GROUP BY endpoint),
t AS (SELECT n.*, {HALF_EVEN.format('cast(round(latency_ms * 100) AS bigint)', '10')} AS tenths FROM n LEFT JOIN f USING (endpoint) WHERE stop_i IS NULL OR i <= stop_i),
z AS (SELECT endpoint, count(*) FILTER (WHERE error IS NULL) AS requests_made,
  max(i) AS last_i,
  min(tenths) FILTER (WHERE error IS NULL) / 10.0::double AS min_latency_ms,
  max(tenths) FILTER (WHERE error IS NULL) / 10.0::double AS max_latency_ms,
  sum(tenths) FILTER (WHERE error IS NULL)::bigint AS total
  FROM t GROUP BY endpoint),
y AS (SELECT z.*, {HALF_EVEN.format('total', 'requests_made')} / 10.0::double AS avg_latency_ms, t.status, t.error, t.body, t.wait, coalesce(t.status = 429, false) AS throttled
  FROM z JOIN t ON z.endpoint = t.endpoint AND z.last_i = t.i)"""

STATS_ERROR = """CASE WHEN y.error IS NOT NULL THEN 'request #' || (requests_made + 1) || ' raised: ' || y.error
  WHEN y.status IN (401, 403) THEN 'HTTP ' || y.status ||
    ' - authenticated but not authorized for this endpoint (check tenant setting / workspace access).'
  WHEN y.status >= 400 AND NOT throttled THEN 'HTTP ' || y.status || ': ' || y.body END"""

COUNTS = """SELECT endpoint, string_agg(status || '=' || c, ';' ORDER BY status) AS status_counts
  FROM (SELECT endpoint, status, count(*) AS c FROM {0} WHERE status IS NOT NULL AND error IS NULL
    GROUP BY endpoint, status) GROUP BY endpoint"""

U = "u AS (SELECT DISTINCT user_id FROM events)"

REGISTRY = """(SELECT 'ds-' || user_id AS dataset_id, 'dataset ' || user_id AS dataset_name,
  'ws-' || (user_id % 5) AS workspace_id, 'workspace ' || (user_id % 5) AS workspace_name,
  user_id % 3 = 0 AS is_critical FROM (SELECT DISTINCT user_id FROM events))"""

X = f"""{U},
x AS (SELECT user_id * 2 + version AS pos, 'w-' || (user_id // 50) AS workspace_id,
  'workspace ' || (user_id // 50) AS workspace_name, 'ds-' || user_id AS dataset_id,
  'explicit ' || user_id || ' v' || version AS dataset_name,
  CASE WHEN user_id % 3 = 0 THEN true END AS is_critical,
  CASE WHEN user_id % 4 <> 0 THEN false WHEN user_id % 12 = 0 THEN true END AS is_active
  FROM u, (VALUES (0), (1)) v(version)),
w AS (SELECT DISTINCT user_id // 50 AS pos FROM u),
i AS (SELECT user_id // 50 + shift AS wpos, user_id AS item_pos, user_id,
  CASE WHEN user_id % 31 <> 30 THEN 'ds-' || user_id END AS id,
  CASE WHEN user_id % 7 <> 0 THEN 'found ' || user_id ELSE 'Unknown' END AS name
  FROM u, (VALUES (0), (1)) v(shift) WHERE shift = 0 OR user_id % 5 = 0),
d AS (SELECT id AS dataset_id, name AS dataset_name, 'w-' || pos AS workspace_id,
  'workspace ' || pos AS workspace_name, pos % 2 = 0 AS is_critical, pos, item_pos
  FROM i JOIN w ON i.wpos = w.pos
  WHERE pos % 7 <> 6 AND id IS NOT NULL AND NOT (user_id % 10 = 3 AND user_id // 50 = pos))"""

COMPLETED = "status = 'Completed'"

NAME_ALERT = """'{0}' AS alert_type, dataset_name, workspace_name"""

FAILURES = f"""SELECT CASE WHEN is_critical THEN 'critical' ELSE 'warning' END AS severity,
  {NAME_ALERT.format('refresh_failure')},
  'Refresh failed with error: ' || coalesce(error_code, 'Unknown') AS message, {RUN_AT} AS alert_time,
  error_code, service_exception_json AS service_exception,
  CASE WHEN epoch_us(start_time) % 1000000 = 0 THEN strftime(start_time, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') END AS start_time
  FROM r WHERE status = 'Failed' AND ingestion_date = {AS_OF}"""

ANOMALIES = f"""SELECT 'warning' AS severity, {NAME_ALERT.format('duration_anomaly')},
  'Refresh took ' || cast(round_even(duration_seconds, 0) AS bigint) || 's (' ||
    cast(round_even(duration_seconds / m, 1) AS decimal(20,1)) || 'x the 7-day rolling avg of ' ||
    cast(round_even(m, 0) AS bigint) || 's).' AS message, {RUN_AT} AS alert_time,
  round(duration_seconds, 6) AS duration_seconds, round(m, 6) AS rolling_avg_seconds,
  round(duration_seconds / m, 2) AS ratio
  FROM (SELECT *, avg(duration_seconds) OVER (PARTITION BY dataset_id ORDER BY start_time, request_id
      ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS m
    FROM r WHERE {COMPLETED} AND duration_seconds IS NOT NULL AND start_time >= {AS_OF} - INTERVAL 8 DAY)
  WHERE ingestion_date = {AS_OF} AND m IS NOT NULL AND duration_seconds > 1.5 * m"""

STALE = f"""SELECT 'critical' AS severity, {NAME_ALERT.format('stale_data')},
  'No successful refresh in ' || h || ' hours (SLA threshold: 26h). Last success: ' || t || '.' AS message,
  {RUN_AT} AS alert_time, h::varchar AS hours_since_refresh, t AS last_successful_refresh
  FROM (SELECT *, date_sub('hour', last, {RUN_AT}) AS h,
      CASE WHEN epoch_us(last) % 1000000 = 0 THEN strftime(last, '%Y-%m-%d %H:%M:%S')
        ELSE strftime(last, '%Y-%m-%d %H:%M:%S.%f') END AS t
    FROM (SELECT dataset_id, dataset_name, workspace_name, max(end_time) AS last FROM r
      WHERE {COMPLETED} AND is_critical GROUP BY ALL)) WHERE h > 26"""

ALL_ALERTS = " UNION ALL ".join(
    f"SELECT severity, alert_type, dataset_name, workspace_name, message, alert_time FROM ({part})"
    for part in (FAILURES, ANOMALIES, STALE)
)

VIEWS = f"activity = 'ViewReport' AND creation_date >= {AS_OF} - INTERVAL 30 DAY AND report_name IS NOT NULL"

MOST_VIEWED = f"""WITH {A} SELECT report_name, workspace_name, count(*) AS views,
  count(DISTINCT user_id) AS distinct_users FROM a WHERE {VIEWS}
  GROUP BY report_name, workspace_name ORDER BY views DESC, report_name, workspace_name"""


def _minutes(expression: str) -> str:
    return f"round({expression} / 60.0, 1)"


def _card() -> str:
    def fact(title: str, value: str) -> str:
        return f"""'{{"title":"{title}","value":"' || {value} || '"}}'"""

    facts = " || ',' || ".join(
        [
            fact("Severity", "upper(severity)"),
            fact("Dataset", "dataset_name"),
            fact("Workspace", "workspace_name"),
            fact("Time (UTC)", "'2024-01-31T00:00:00+00:00'"),
        ]
    )
    return (
        """'{"type":"message","attachments":[{"contentType":"application/vnd.microsoft.card.adaptive","""
        """"contentUrl":null,"content":{"$schema":"http://adaptivecards.io/schemas/adaptive-card.json","""
        """"type":"AdaptiveCard","version":"1.4","body":[{"type":"TextBlock","size":"Large","weight":"Bolder","""
        """"text":"Refresh Alert — Refresh Failure","style":"heading","color":"' ||
        CASE severity WHEN 'critical' THEN 'attention' ELSE 'warning' END ||
        '"},{"type":"FactSet","facts":[' || """
        + facts
        + """ || ']},{"type":"TextBlock","text":"' || message || '","wrap":true}]}}]}'"""
    )


RAW_START = f"strftime(start_time, {ISO})"
RAW_END = f"strftime(end_time, {ISO})"

PROBE_ERROR = "repeat('x', 400 + k * 2)"

MARKS_BEFORE = """SELECT dataset_id, max(start_time) AS watermark FROM r
  WHERE is_critical {0} GROUP BY dataset_id"""

MERGED_EVENTS = f"""WITH {A} SELECT {ACTIVITY_COLUMNS} FROM a UNION ALL
    SELECT 'e-' || n AS event_id, {ACTIVITY_COLUMNS.split(', ', 1)[1]}
    FROM (SELECT *, cast(substr(event_id, 3) AS bigint) * 2 AS n FROM a) WHERE n > (SELECT max(event_id) FROM events)"""

ORACLES = {
    "src_refresh_envelope": f"""WITH {B} SELECT workspace_id, dataset_id, request_id AS "requestId",
        refresh_type AS "refreshType", {RAW_START} AS "startTime", {RAW_END} AS "endTime", status,
        service_exception_json AS "serviceExceptionJson", refresh_attempts_json AS "refreshAttempts" FROM b""",
    "src_top_n_per_dataset": f"""WITH {B} SELECT dataset_id, request_id AS "requestId", {RAW_START} AS "startTime"
        FROM b QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY start_time DESC, request_id) <= 60""",
    "src_dataset_listing": f"""WITH {X} SELECT 'w-' || wpos AS workspace_id, id, name, true AS is_refreshable FROM i""",
    "src_workspace_listing": f"""WITH {U} SELECT 'g-' || user_id AS id, 'group ' || user_id AS name FROM u""",
    "src_activity_pages": """WITH g AS (SELECT event_id, cast(ts AS date) AS fetch_day, event_id // 50 AS page_no FROM events),
        m AS (SELECT fetch_day, max(page_no) AS last_page FROM g GROUP BY fetch_day),
        c AS (SELECT g.fetch_day, min(page_no) AS stop FROM g JOIN m ON g.fetch_day = m.fetch_day
          WHERE page_no = last_page OR page_no % 7 = 6 GROUP BY g.fetch_day)
        SELECT g.fetch_day, 'e-' || event_id AS event_id FROM g JOIN c ON g.fetch_day = c.fetch_day WHERE page_no <= stop""",
    "src_activity_pages_streamed": """WITH g AS (SELECT event_id, cast(ts AS date) AS fetch_day, event_id // 50 AS page_no FROM events),
        m AS (SELECT fetch_day, max(page_no) AS last_page FROM g GROUP BY fetch_day),
        c AS (SELECT g.fetch_day, min(page_no) AS stop FROM g JOIN m ON g.fetch_day = m.fetch_day
          WHERE page_no = last_page OR page_no % 7 = 6 GROUP BY g.fetch_day)
        SELECT g.fetch_day AS creation_date, 'e-' || event_id AS event_id FROM g JOIN c ON g.fetch_day = c.fetch_day WHERE page_no <= stop""",
    "src_probe_payload_rows": f"WITH {E} SELECT event_id, {ROWS} AS row_count FROM e",
    "src_config_registry": f"""WITH {X} SELECT workspace_id, workspace_name, dataset_id, dataset_name, is_critical,
        is_active FROM x""",
    "src_typed_rows": f"""WITH {B} SELECT request_id, dataset_id, workspace_id, start_time, end_time,
        CASE WHEN k % 9 <> 0 THEN k END AS attempt_count, is_critical, NULL::double AS duration_seconds FROM b""",
    "src_table_scan": f"WITH {R} SELECT {REFRESH_COLUMNS} FROM r",
    "src_csv_history": "SELECT 'e-' || event_id AS event_id FROM events",
    "triage_fetch_status": f"WITH {L} SELECT seq, kind, status, {OUTCOME} AS outcome FROM l",
    "triage_retryable": f"""WITH {L} SELECT seq,
        coalesce(status IN (429, 500, 502, 503, 504), false) AND method = 'GET' AS retryable FROM l""",
    "triage_rate_headers": f"WITH {L} SELECT seq, {QUOTA} AS quota_headers FROM l",
    "triage_retry_after": f"""WITH {L} SELECT seq,
        CASE WHEN status = 429 THEN try_cast(wait AS int) END AS retry_after_seconds FROM l""",
    "triage_throttle_cutoff": f"""WITH {L} SELECT seq, day FROM l
        WHERE day < coalesce((SELECT min(day) FROM l WHERE status = 429 AND day >= DATE '2024-01-17'), DATE '9999-12-31')""",
    "triage_take_while": f"""WITH {L} SELECT endpoint, seq, status FROM l
        QUALIFY coalesce(max(CASE WHEN {STOPS} THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0""",
    "triage_endpoint_stats": f"""WITH {BURST} SELECT endpoint, requests_made, throttled,
        CASE WHEN throttled THEN requests_made END AS first_429_at_request,
        CASE WHEN throttled THEN y.wait END AS retry_after_seconds,
        CASE WHEN throttled THEN 'RateLimit-Remaining=0;Retry-After=' || y.wait || ';x-ms-throttle-scope=tenant'
          WHEN requests_made > 0 THEN 'X-RateLimit-Limit=200' ELSE '' END AS rate_limit_headers,
        min_latency_ms, max_latency_ms, avg_latency_ms, {STATS_ERROR} AS error FROM y""",
    "triage_status_counts": f"WITH {L} {COUNTS.format('l')}",
    "triage_run_stats": f"""WITH {R},
        g AS (SELECT dataset_id FROM {REGISTRY}),
        c AS (SELECT dataset_id, count(*) AS n FROM r WHERE start_time >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY dataset_id),
        l AS (SELECT 'ds-' || user_id AS dataset_id, cast(ts AS date) AS day, event_type,
          CASE k WHEN 99 THEN 429 WHEN 98 THEN 403 WHEN 97 THEN 500 WHEN 95 THEN 404 WHEN 94 THEN 401
            WHEN 96 THEN NULL ELSE 200 END AS status FROM e),
        f AS (SELECT DISTINCT dataset_id FROM l WHERE day = {AS_OF} AND (status IS NULL OR status = 500
          OR (status = 429 AND event_type IN ('view', 'click')) OR (status = 401 AND event_type IN ('view', 'click'))
          OR (status = 404 AND event_type NOT IN ('view', 'click'))))
        SELECT count(*) FILTER (WHERE f.dataset_id IS NULL AND n > 0) AS datasets_processed,
          count(*) FILTER (WHERE f.dataset_id IS NULL AND n IS NULL) AS datasets_skipped,
          count(f.dataset_id) AS datasets_failed
        FROM g LEFT JOIN c USING (dataset_id) LEFT JOIN f ON g.dataset_id = f.dataset_id""",
    "triage_day_counts": f"""WITH {A}, kept AS (SELECT * FROM a WHERE activity IN ('ViewReport', 'EditReport')),
        fresh AS (SELECT * FROM kept WHERE event_id NOT IN (SELECT 'e-' || (event_id * 2) FROM events))
        SELECT creation_date AS fetch_day, count(*) AS n_raw,
          count(*) FILTER (WHERE activity IN ('ViewReport', 'EditReport')) AS n_kept,
          count(*) FILTER (WHERE event_id IN (SELECT event_id FROM fresh)) AS n_new
        FROM a GROUP BY creation_date""",
    "tr_duration_seconds": f"""WITH {R} SELECT request_id AS "requestId", duration_seconds FROM r""",
    "tr_error_code": f"""WITH {R} SELECT request_id AS "requestId", error_code FROM r""",
    "tr_refresh_records": f"""WITH {R} SELECT {REFRESH_COLUMNS.replace(
        'ingestion_timestamp, ingestion_date', f"{RUN_AT} AS ingestion_timestamp, DATE '2024-01-31' AS ingestion_date")} FROM r""",
    "tr_attempts": f"""WITH {B} SELECT request_id AS "requestId", refresh_attempts_json, attempt_count FROM b""",
    "tr_coalesce_casing": f"WITH {A} SELECT event_id AS id, workspace_id, workspace_name FROM a",
    "tr_activity_date": f"""WITH {E} SELECT event_id, CASE k % 13 WHEN 0 THEN NULL
        WHEN 2 THEN cast(ts - INTERVAL 2 HOUR AS date) ELSE cast(ts AS date) END AS creation_date FROM e""",
    "tr_activity_events": ACTIVITY_ROWS,
    "tr_ingestion_stamp": f"""WITH {B} SELECT request_id AS "requestId", {RUN_AT} AS ingestion_timestamp,
        DATE '2024-01-31' AS ingestion_date FROM b""",
    "tr_probe_record": f"""WITH {E} SELECT
        sha256('ws-' || (user_id % 5) || '|ds-' || user_id || '|' || event_type || '|' || epoch_us(ts)) AS probe_id,
        'ws-' || (user_id % 5) AS workspace_id, 'workspace ' || (user_id % 5) AS workspace_name,
        'ds-' || user_id AS dataset_id, 'dataset ' || user_id AS dataset_name, event_type AS query_label,
        CASE WHEN k % 10 <= 1 THEN 'Failed' ELSE 'Success' END AS status,
        CASE WHEN k % 10 > 1 THEN {TRIP_MS} END AS duration_ms, CASE WHEN k % 10 > 1 THEN {ROWS} END AS row_count,
        CASE k % 10 WHEN 0 THEN 'HTTP 403' WHEN 1 THEN {PROBE_ERROR} END AS error_message,
        user_id % 3 = 0 AS is_critical, ts AS probe_timestamp, cast(ts AS date) AS probe_date FROM e""",
    "tr_probe_duration_ms": f"WITH {E} SELECT event_id, {TRIP_MS} AS duration_ms FROM e",
    "tr_day_bounds": """SELECT day, strftime(day, '%Y-%m-%d') || 'T00:00:00' AS start_bound,
        strftime(day, '%Y-%m-%d') || 'T23:59:59' AS end_bound FROM (SELECT DISTINCT cast(ts AS date) AS day FROM events)""",
    "tr_month_bucket": "SELECT event_id, 'activity_events_' || strftime(ts, '%Y_%m') AS file_key FROM events",
    "tr_alert_card": f"""WITH {R} SELECT dataset_name, message, start_time, {_card()} AS card FROM ({FAILURES})""",
    "flt_watermark": f"""WITH {R}, m AS ({MARKS_BEFORE.format("AND start_time < TIMESTAMP '2024-01-20 00:00:00'")})
        SELECT b.dataset_id, request_id AS "requestId", CASE k % 17 WHEN 0 THEN NULL WHEN 1 THEN ''
          WHEN 2 THEN 'soon' ELSE {RAW_START} END AS "startTime"
        FROM b LEFT JOIN m USING (dataset_id) WHERE k % 17 <= 2 OR watermark IS NULL OR start_time > watermark""",
    "flt_require_id": f"""WITH {B} SELECT event_id, request_id AS "requestId" FROM b WHERE k % 10 > 1""",
    "flt_tracked_activities": f"""WITH {A} SELECT event_id, activity FROM a
        WHERE right(event_id, 1) <> '0' AND activity IN ('ViewReport', 'EditReport')""",
    "flt_active": f"WITH {X} SELECT dataset_id, dataset_name, is_active FROM x WHERE coalesce(is_active, true)",
    "flt_exclude_list": f"WITH {X} SELECT dataset_id, dataset_name, workspace_id, is_critical FROM d",
    "join_registry_resolve": f"""WITH {X}, c AS (
        SELECT dataset_id, dataset_name, workspace_id, workspace_name, coalesce(is_critical, false) AS is_critical,
          0 AS source, -pos AS p1, 0 AS p2 FROM x WHERE coalesce(is_active, true)
        UNION ALL SELECT dataset_id, dataset_name, workspace_id, workspace_name, is_critical, 1, pos, item_pos FROM d)
        SELECT dataset_id, dataset_name, workspace_id, workspace_name, is_critical, true AS is_active FROM c
        QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY source, p1, p2) = 1""",
    "join_registry_enrich": f"""WITH {B} SELECT request_id AS "requestId", dataset_id, dataset_name, workspace_id,
        workspace_name, is_critical FROM b""",
    "join_watermark_lookup": f"""WITH {R}, m AS ({MARKS_BEFORE.format('')})
        SELECT request_id AS "requestId", r.dataset_id, watermark FROM r LEFT JOIN m USING (dataset_id)""",
    "join_latest_semi": f"""WITH {R} SELECT dataset_id, request_id, start_time, status FROM r
        WHERE (dataset_id, start_time) IN (SELECT (dataset_id, max(start_time)) FROM r GROUP BY dataset_id)""",
    "join_week_self": f"""WITH {R}, w AS (SELECT dataset_name, start_time >= {AS_OF} - INTERVAL 7 DAY AS recent,
          avg(duration_seconds) AS m FROM r WHERE {COMPLETED} AND start_time >= {AS_OF} - INTERVAL 14 DAY GROUP BY ALL)
        SELECT dataset_name, round(prev.m, 6) AS last_week_mean, round(cur.m, 6) AS this_week_mean
        FROM w cur JOIN w prev USING (dataset_name) WHERE cur.recent AND NOT prev.recent""",
    "join_interval_overlap": f"""WITH {R} SELECT a.request_id AS a_id, b.request_id AS b_id,
        a.dataset_id AS a_dataset, b.dataset_id AS b_dataset
        FROM r a JOIN r b ON a.request_id < b.request_id AND a.start_time < b.end_time AND b.start_time < a.end_time
        WHERE a.status = 'Completed' AND b.status = 'Completed'""",
    "join_anti_known_ids": f"""WITH {A} SELECT {ACTIVITY_COLUMNS} FROM a
        WHERE event_id NOT IN (SELECT 'e-' || (event_id * 2) FROM events)""",
    "merge_refresh": MERGED_REFRESH,
    "merge_events": MERGED_EVENTS,
    "agg_watermarks": f"""WITH {R} SELECT dataset_id, max(start_time) AS watermark FROM r GROUP BY dataset_id""",
    "agg_watermarks_kept": f"SELECT dataset_id, max(start_time) AS watermark FROM ({MERGED_REFRESH}) GROUP BY dataset_id",
    "agg_max_activity_date_listed": "SELECT max(cast(ts AS date)) AS max_date FROM events",
    "agg_max_activity_date": "SELECT max(cast(ts AS date)) AS max_date FROM events",
    "agg_dedup_events": f"""WITH {A} SELECT 'e-' || n AS event_id, {ACTIVITY_COLUMNS.split(', ', 1)[1]}
        FROM (SELECT *, cast(substr(event_id, 3) AS bigint) // 3 AS n FROM a)
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY creation_time, creation_date, activity) = 1""",
    "agg_midpoint_watermark": f"""WITH {R} SELECT dataset_id, start_time AS watermark FROM (
        SELECT dataset_id, start_time, row_number() OVER (PARTITION BY dataset_id ORDER BY start_time) - 1 AS i,
          count(*) OVER (PARTITION BY dataset_id) AS n FROM r) WHERE i = n // 2""",
    "agg_probe_summary": f"""WITH {P} SELECT count(*) FILTER (WHERE status = 'Success') AS succeeded,
        count(*) FILTER (WHERE status <> 'Success') AS failed FROM p""",
    "agg_file_summary": """SELECT 'activity_events_' || strftime(ts, '%Y_%m') AS file_key, count(*) AS n_rows,
        true AS has_size FROM events GROUP BY ALL""",
    "rpt_latest_status": f"""WITH {R} SELECT dataset_name, workspace_name, status, refresh_type, start_time, end_time,
        {_minutes('duration_seconds')} AS duration_minutes, error_code FROM r
        WHERE (dataset_id, start_time) IN (SELECT (dataset_id, max(start_time)) FROM r GROUP BY dataset_id)
        ORDER BY is_critical DESC, dataset_name""",
    "rpt_daily_status_counts": f"""WITH {R} SELECT ingestion_date, status, count(*) AS refresh_count FROM r
        WHERE ingestion_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY ingestion_date, status
        ORDER BY ingestion_date DESC, status""",
    "rpt_avg_duration": f"""WITH {R} SELECT dataset_name, workspace_name, count(*) AS completed_refreshes,
        {_minutes('avg(duration_seconds)')} AS avg_duration_minutes,
        {_minutes('max(duration_seconds)')} AS max_duration_minutes,
        {_minutes('min(duration_seconds)')} AS min_duration_minutes FROM r
        WHERE {COMPLETED} AND start_time >= {AS_OF} - INTERVAL 7 DAY
        GROUP BY dataset_name, workspace_name ORDER BY avg_duration_minutes DESC""",
    "rpt_duration_trend": f"""WITH {R} SELECT cast(start_time AS date) AS refresh_date,
        {_minutes('avg(duration_seconds)')} AS avg_duration_minutes, count(*) AS refresh_count FROM r
        WHERE dataset_name = 'dataset 7' AND {COMPLETED} AND start_time >= {AS_OF} - INTERVAL 30 DAY
        GROUP BY refresh_date ORDER BY refresh_date""",
    "rpt_failures": f"""WITH {R} SELECT dataset_name, workspace_name, start_time, error_code, service_exception_json,
        is_critical FROM r WHERE status = 'Failed' AND start_time >= {AS_OF} - INTERVAL 7 DAY
        ORDER BY is_critical DESC, start_time DESC""",
    "rpt_freshness": f"""WITH {R} SELECT dataset_name, workspace_name, is_critical,
        max(end_time) AS last_successful_refresh,
        round((epoch({RUN_AT})::bigint - floor(epoch(max(end_time)))) / 3600.0::double, 1) AS hours_since_refresh
        FROM r WHERE {COMPLETED} GROUP BY dataset_name, workspace_name, is_critical
        ORDER BY is_critical DESC, hours_since_refresh DESC""",
    "rpt_week_over_week": f"""WITH {R}, w AS (SELECT dataset_name, start_time >= {AS_OF} - INTERVAL 7 DAY AS recent,
          avg(duration_seconds) AS m FROM r WHERE {COMPLETED} AND start_time >= {AS_OF} - INTERVAL 14 DAY GROUP BY ALL)
        SELECT dataset_name, {_minutes('prev.m')} AS last_week_avg_min, {_minutes('cur.m')} AS this_week_avg_min,
          round((cur.m - prev.m) / nullif(prev.m, 0) * 100, 1) AS pct_change
        FROM w cur JOIN w prev USING (dataset_name)
        WHERE cur.recent AND NOT prev.recent AND cur.m > prev.m ORDER BY pct_change DESC""",
    "rpt_overlap": f"""WITH {R} SELECT a.dataset_name AS dataset_a, b.dataset_name AS dataset_b,
        a.start_time AS a_start, a.end_time AS a_end, b.start_time AS b_start, b.end_time AS b_end
        FROM r a JOIN r b ON a.request_id < b.request_id AND a.start_time < b.end_time AND b.start_time < a.end_time
        WHERE a.status = 'Completed' AND b.status = 'Completed' AND a.start_time >= {AS_OF} - INTERVAL 1 DAY
        ORDER BY a.start_time""",
    "rpt_most_viewed": MOST_VIEWED,
    "rpt_most_viewed_top10": f"{MOST_VIEWED} LIMIT 10",
    "rpt_least_viewed": f"""WITH {A} SELECT report_name, workspace_name, count(*) AS views,
        max(creation_date) AS last_viewed FROM a WHERE {VIEWS} GROUP BY report_name, workspace_name
        ORDER BY views, report_name, workspace_name LIMIT 25""",
    "rpt_daily_views": f"""WITH {A} SELECT creation_date, count(*) AS views, count(DISTINCT user_id) AS distinct_users
        FROM a WHERE activity = 'ViewReport' GROUP BY creation_date ORDER BY creation_date""",
    "rpt_top_users": f"""WITH {A} SELECT user_id, count(*) AS total_activities,
        count(DISTINCT report_id) AS distinct_reports FROM a
        WHERE creation_date >= {AS_OF} - INTERVAL 30 DAY AND user_id IS NOT NULL
        GROUP BY user_id ORDER BY total_activities DESC, user_id LIMIT 25""",
    "alert_failures": f"WITH {R} {FAILURES}",
    "alert_duration_anomaly": f"WITH {R} {ANOMALIES}",
    "alert_stale": f"WITH {R} {STALE}",
    "alert_union": f"WITH {R} {ALL_ALERTS}",
    "alert_route": f"""WITH {R} SELECT CASE severity WHEN 'critical' THEN 'CRITICAL' ELSE 'WARNING' END AS log_level,
        CASE severity WHEN 'critical' THEN 'log+card' ELSE 'log' END AS channel,
        '[' || upper(severity) || '] ' || alert_type || ' | ' || workspace_name || '/' || dataset_name || ': ' || message AS line
        FROM ({ALL_ALERTS})""",
    "inc_dates_to_fetch": """SELECT cast(d AS date) AS day FROM (SELECT unnest(generate_series(
        greatest(max(cast(ts AS date)), DATE '2024-01-08')::timestamp, TIMESTAMP '2024-02-04', INTERVAL 1 DAY)) AS d FROM events)""",
    "inc_limit_backfill": "SELECT DISTINCT cast(ts AS date) AS day FROM events ORDER BY day LIMIT 7",
    "inc_late_day_reload": f"""WITH {A}, t AS (SELECT *, creation_date >= DATE '2024-01-25' AND right(event_id, 1) = '7' AS late FROM a)
        SELECT {ACTIVITY_COLUMNS} FROM t WHERE NOT late OR creation_date >= (SELECT max(creation_date) FROM t WHERE NOT late)""",
    "inc_csv_range": """SELECT cast(d AS date) AS day, d < TIMESTAMP '2024-01-02' AS past_retention, coalesce(n, 0) AS n_events
        FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-20', TIMESTAMP '2024-01-29', INTERVAL 1 DAY)) AS d)
        LEFT JOIN (SELECT cast(ts AS date) AS day, count(*) AS n FROM events GROUP BY ALL) c ON c.day = cast(d AS date)""",
    "sink_create_table": ACTIVITY_ROWS,
    "sink_append": f"""WITH {P} SELECT * FROM p""",
    "sink_merge_commit": MERGED_REFRESH,
    "sink_merge_bucketed": MERGED_REFRESH,
    "sink_merge_indexed": MERGED_EVENTS,
    "sink_csv_monthly": f"""WITH {A} SELECT event_id, activity, user_id, 'a "' || report_name || '",' || chr(10) || 'b' AS report_name,
        strftime(creation_date, '%Y-%m-%d') AS creation_date,
        'activity_events_' || strftime(creation_date, '%Y_%m') AS file_key FROM a""",
    "sink_json_report": f"""WITH {BURST}, sc AS ({COUNTS.format('t')})
        SELECT y.endpoint, requests_made, CASE WHEN throttled THEN requests_made END AS first_429_at_request,
          avg_latency_ms, coalesce(status_counts, '') AS status_counts, 'all' AS max_requests FROM y LEFT JOIN sc ON y.endpoint = sc.endpoint""",
    "sink_alerts": f"""WITH {R} SELECT *, cast(alert_time AS date) AS alert_date FROM ({ALL_ALERTS})""",
}

# The same questions answered from roll-ups.
for _name in ("rpt_daily_views", "rpt_most_viewed", "rpt_top_users"):
    ORACLES[f"{_name}_rolled"] = ORACLES[_name]
